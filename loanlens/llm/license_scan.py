"""Licence scan: a trained paragraph classifier over sparse word n-grams, confirmed by templates.

A multinomial logistic regression over the word unigrams, bigrams and trigrams of licence notices tells the
licence families and an unknown class apart. Its training rows are variants of the templates below (whole,
cut, and set among words of the corpus) and a bounded sample of ordinary corpus paragraphs as unknown. The
threshold a family's probability has to reach is calibrated on held-back variants and paragraphs. A paragraph
predicted as a family is confirmed where it shares enough n-grams with one of the family's templates.

Only n-grams of the templates are features. Paragraphs are looked up by anchor words first: template words without
any of which the fitted weights cannot reach a family's threshold, so that changes no prediction. Everything is
DataFrame operations and Spark ML.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanlens.llm.common import Scratch, few, keyed_rows
from loanlens.session import ensure_checkpoint_dir

UNKNOWN_DOCUMENTS = 2_000      # documented bound of the documents whose ordinary paragraphs are sampled
UNKNOWN_PARAGRAPHS = 4_000     # and of the paragraphs
WINDOW, STRIDE = 48, 24        # words; longer paragraphs are scanned in overlapping windows
CONFIRM = 0.6                  # share of a template's n-grams that a window has to hold
#: Between paragraphs: one or more lines without a letter or digit.
BLANK = r"\R[^\p{L}\p{N}]*\R"
# Notices in their usual wording.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0"],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU GPL v2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.", "This text is available under the Creative Commons Attribution-ShareAlike License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0."],
    "public-domain": [
        "This work is in the public domain.", "Dedicated to the public domain under CC0 1.0.", "No rights reserved. CC0 1.0 Universal."],
    "proprietary": [
        "All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without written permission.",
        "Proprietary and confidential. Unauthorized copying is prohibited."],
}
STOP = "the a an of to and or in is are be by as at this that it any for from with on you not may can under use work file no part text"


def tokens(text: Column) -> Column:
    """Lower-cased words of letters and digits; version points and hyphens stay inside a word."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.\-]+|[.\-]+(?![\p{L}\p{N}])", " "), " +"), lambda w: w != "")


def ngrams(words: str) -> Column:
    """Distinct word unigrams, bigrams and trigrams of an array column that touch a word other than a stop word."""
    stop = "array(" + ", ".join(f"'{w}'" for w in STOP.split()) + ")"
    some = lambda n: (f"if(size({words}) < {n}, cast(array() as array<string>), transform(sequence(1, size({words}) - {n - 1}), "  # noqa: E731
                      f"i -> concat_ws(' ', slice({words}, i, {n}))))")
    one = f"filter({words}, w -> not array_contains({stop}, w))"
    touching = lambda n: f"filter({some(n)}, g -> size(array_except(split(g, ' '), {stop})) > 0)"
    return F.expr(f"array_distinct(concat({one}, {touching(2)}, {touching(3)}))")


def paragraphs(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """(id, row, block, at, whole, words): paragraphs of (id, row, text) with an anchor word, and the lines of those that have several.

    Paragraphs are lines up to a blank one (without a letter or digit). ``block`` numbers a document's paragraphs, ``at``
    a paragraph's lines, and ``whole`` marks the joined lines of a paragraph of several. A paragraph's words are those of
    its lines, so a paragraph without an anchor word holds no line with one and is left before its lines are cut.
    """
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\r\n"), F.lit("\n"))  # else BLANK finds two line ends in one
    blocks = docs.select("id", "row", F.posexplode(F.split(text, BLANK)).alias("block", "paragraph"))
    blocks = blocks.withColumn("every", tokens(F.col("paragraph"))).filter(F.arrays_overlap("every", F.array(*[F.lit(w) for w in anchors])))
    lines = blocks.withColumn("lines", F.filter(F.split("paragraph", r"\R"), lambda line: line != ""))
    pieces = lines.select("id", "row", "block", "every", F.size("lines").alias("n"), F.posexplode(
        F.expr("if(size(lines) > 1, concat(lines, array(paragraph)), lines)")).alias("at", "piece"))
    whole = (F.col("at") == F.col("n"))
    return pieces.select("id", "row", "block", "at", whole.alias("whole"),
                         F.when(whole | (F.col("n") == 1), F.col("every")).otherwise(tokens(F.col("piece"))).alias("words"))


def windows(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words`` cut into windows of WINDOW words that overlap by half; ``from_word`` is the first word's place."""
    starts = F.expr(f"if(size(words) <= {WINDOW}, array(1), sequence(1, greatest(1, size(words) - {WINDOW - STRIDE}), {STRIDE}))")
    return rows.withColumn("from_word", F.explode(starts)).withColumn("words", F.expr(f"slice(words, from_word, {WINDOW})"))


class LicenseScanner:
    """Fitted pipeline, family names, calibrated thresholds, template n-grams, and the words and n-grams a notice needs."""

    def __init__(self, model, families: list[str], thresholds: dict[str, float], templates: DataFrame, anchors: list[str], grams: list[str]):
        self.model, self.families, self.thresholds = model, families, thresholds
        self.templates, self.anchors, self.grams = templates, anchors, grams

    def scan(self, rows: DataFrame, scratch: Scratch) -> DataFrame:
        """Windows of (.., words) that the classifier takes for a licence notice: family, probability, likeness, confirmed.

        The few windows that need scoring are written with their n-grams, which the scoring expressions read many times.
        """
        anchors = F.array(*[F.lit(w) for w in self.anchors])
        found = windows(rows.filter(F.arrays_overlap("words", anchors))).filter(F.arrays_overlap("words", anchors))
        joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
        needles = F.array(*[F.lit(f" {g} ") for g in self.grams])
        found = found.filter(F.exists(F.array(joined), lambda text: F.exists(needles, lambda g: F.contains(text, g))))    # joins the words once
        found = scratch.save(found.withColumn("grams", ngrams("words")), "windows")
        scored = self.model.transform(found).withColumn("p", vector_to_array("probability"))
        named = F.array(*[F.lit(f) for f in self.families])
        scored = scored.withColumn("probability", F.array_max(F.expr("slice(p, 2, size(p) - 1)"))).withColumn(
            "family", named[F.expr("cast(array_position(slice(p, 2, size(p) - 1), probability) - 1 as int)")])
        limit = F.create_map(*[F.lit(x) for kv in self.thresholds.items() for x in kv])
        scored = scored.filter(F.col("probability") >= limit[F.col("family")]).drop("features", "rawPrediction", "prediction", "p")
        shared = "size(array_intersect(grams, t))"
        best = F.expr(f"array_max(transform(templates, t -> greatest({shared} / greatest(size(t), 1), 0.0)))")
        return scored.join(F.broadcast(self.templates), "family").withColumn("likeness", best).withColumn(
            "confirmed", F.col("likeness") >= CONFIRM).drop("templates", "grams")


def calibrated(held: DataFrame, families: list[str]) -> dict[str, float]:
    """The probability from which each family is believed, from held-back rows (family, or '' for unknown; p by class, unknown first).

    It lies half-way between the highest probability that an unknown row has for the family and the lowest one of its own
    variants; above the unknown rows where the two overlap; and never below 0.5.
    """
    tops = held.agg(*[F.max(F.when(F.col("family") == "", F.col("p")[i + 1])).alias(f"u{i}") for i in range(len(families))],
                    *[F.min(F.when(F.col("family") == f, F.col("p")[i + 1])).alias(f"v{i}") for i, f in enumerate(families)]).first()
    out = {}
    for i, f in enumerate(families):
        unknown, own = tops[f"u{i}"] or 0.0, tops[f"v{i}"]
        out[f] = float(max(0.5, (unknown + own) / 2 if own is not None and own > unknown else min(0.99, unknown + 0.01)))
    return out


def needed(weights, intercepts, vocabulary: list[str], thresholds: list[float], by_frequency: list[str], words: bool) -> list[str]:
    """Words (or n-grams) without any of which no window reaches a family's threshold.

    A family's probability reaches its threshold t only where its logit exceeds the unknown class's by log(t / (1 - t)).
    The others, taken from the commonest on, cannot add up to that for any family: n-grams by their own weights, words by
    those of all n-grams of them and stop words. ``weights`` and ``intercepts`` have the unknown class first.
    """
    stop = set(STOP.split())
    gain = np.maximum(weights[1:] - weights[:1], 0.0)
    need = np.log(np.array(thresholds) / (1 - np.array(thresholds))) - (intercepts[1:] - intercepts[0])
    parts = [set(g.split(" ")) - stop if words else {g} for g in vocabulary]
    spare: set[str] = set()
    for x in by_frequency:
        tried = spare | {x}
        if (gain[:, [p <= tried for p in parts]].sum(axis=1) < need).all():
            spare = tried
    return [x for x in by_frequency if x not in spare]


def fit_scanner(docs: DataFrame) -> LicenseScanner:
    """Train on template variants and a bounded sample of the paragraphs of (id, row, text) that hold an anchor word."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    families = sorted(TEMPLATES)
    notice = spark.createDataFrame([(f, i, t) for f in families for i, t in enumerate(TEMPLATES[f])], "family string, nr int, text string").select(
        "family", "nr", tokens(F.col("text")).alias("words")).withColumn("grams", ngrams("words")).checkpoint()
    vocabulary = sorted(r[0] for r in notice.select(F.explode("grams")).distinct().collect())
    anchors = [w for w in vocabulary if " " not in w]
    # ordinary paragraphs with an anchor word but no licence trigram: a bounded sample in hash order
    some = docs.filter("id is not null").select("id", F.xxhash64("id").alias("place")).orderBy("place", "id").limit(UNKNOWN_DOCUMENTS).select("id")
    plain = paragraphs(docs.join(F.broadcast(some), "id", "left_semi"), anchors).filter(F.arrays_overlap("words", F.array(*[F.lit(w) for w in anchors])))
    tri = F.array(*[F.lit(g) for g in vocabulary if g.count(" ") == 2])
    plain = windows(plain).withColumn("grams", ngrams("words")).filter(~F.arrays_overlap("grams", tri))
    plain = plain.select(F.lit("").alias("family"), "words", "grams", F.xxhash64("words").alias("place")).orderBy("place").limit(UNKNOWN_PARAGRAPHS)
    # variants: whole, without the first or last words, set between words of the corpus, and stop words alone as unknown
    filler = "transform(sequence(1, {n}), i -> concat('filler', i))"
    forms = ["words", "slice(words, 2, size(words))", "slice(words, 1, size(words) - 1)", "slice(words, 1, cast(ceil(size(words) * 0.7) as int))",
             f"concat({filler.format(n=8)}, words)", f"concat(words, {filler.format(n=12)})", f"concat({filler.format(n=6)}, words, {filler.format(n=6)})"]
    variants = notice.select("family", F.explode(F.array(*[F.expr(f) for f in forms])).alias("words"), F.col("nr")).filter("size(words) > 2")
    lone = notice.select(F.lit("").alias("family"), F.explode("words").alias("w")).select("family", F.array("w").alias("words"))
    rows = variants.select("family", "words").unionByName(lone).withColumn("grams", ngrams("words")).withColumn("place", F.xxhash64("words"))
    rows = rows.unionByName(plain).checkpoint()
    names = F.array(*[F.lit(f) for f in families])
    rows = rows.withColumn("label", F.when(F.col("family") == "", 0).otherwise(F.array_position(names, F.col("family"))).cast("double"))
    train, held = rows.filter("place % 4 <> 0"), rows.filter("place % 4 = 0")
    count = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True)
    fit = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", regParam=1e-3, elasticNetParam=0.5, maxIter=100)
    model = Pipeline(stages=[count, fit]).fit(train)
    thresholds = calibrated(model.transform(held).select("family", vector_to_array("probability").alias("p")), families)
    # what is scored at all: paragraphs and windows with an anchor word, and of those the windows with a needed n-gram
    ordinary = rows.filter("family = ''").select(F.explode(F.array_intersect("grams", F.array(*[F.lit(g) for g in vocabulary]))).alias("g"))
    seen = {r["g"]: r["count"] for r in ordinary.groupBy("g").count().collect()}        # at most the vocabulary
    last = model.stages[-1]
    fitted = last.coefficientMatrix.toArray(), last.interceptVector.toArray(), vocabulary, [thresholds[f] for f in families]
    common = lambda g: (-seen.get(g, 0), g)
    anchors = needed(*fitted, sorted(anchors, key=common), words=True)
    grams = needed(*fitted, sorted(vocabulary, key=common), words=False)
    templates = notice.groupBy("family").agg(F.collect_list("grams").alias("templates")).checkpoint()
    return LicenseScanner(model, families, thresholds, templates, anchors, grams)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: LicenseScanner | None = None) -> DataFrame:
    """One row per input row: id, ``n_paragraphs``, ``n_licensed``, ``family``, ``probability``, ``likeness``, ``confirmed``.

    Windows run over every line and over the joined lines of every paragraph (up to a blank line). ``n_paragraphs`` counts
    the lines that are not empty, ``n_licensed`` the lines in which a window is taken for a licence notice, and one for a
    paragraph in which only joined lines are; the other columns describe the best notice (confirmed first, then the highest likeness, probability, then the family's name) and are
    null, and ``confirmed`` false, where there is none. Null and empty texts have no paragraphs. Repeated rows and
    null ids keep a row each; other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "license")
    # the key follows from the row's content, so it is the same in every scan of the input, whatever its order; equal rows share results
    rows = keyed_rows(docs, id_col, text_col)
    base = scratch.save(rows.select("id", "row", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\R"), lambda p: p != "")).cast("long").alias("n_paragraphs")), "rows")
    scanner = scanner or fit_scanner(rows)
    hits = scanner.scan(paragraphs(rows, scanner.anchors), scratch)
    by_block = hits.groupBy("row", "block").agg(
        F.count_distinct(F.when(~F.col("whole"), F.col("at"))).alias("n"),
        F.max(F.struct("confirmed", "likeness", "probability", "family")).alias("best"))
    each = scratch.save(by_block.groupBy("row").agg(F.sum(F.greatest("n", F.lit(1))).alias("n_licensed"), F.max("best").alias("best")), "hits")
    out = base.join(F.broadcast(each) if few(each) else each, "row", "left").select(
        F.col("id").alias(id_col), "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"), F.col("best.family").alias("family"),
        F.col("best.probability").alias("probability"), F.col("best.likeness").alias("likeness"), F.coalesce("best.confirmed", F.lit(False)).alias("confirmed"))
    return scratch.result(out)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
