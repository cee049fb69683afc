"""I-Match document fingerprints over randomised lexicon subsets.

A term's document frequency over the whole corpus decides whether it lies in the chosen
inverse-document-frequency band; the band is the lexicon. Randomised lexicon subsets keep 1/8 to 1/512
of the lexicon (``PER_LEVEL`` disjoint subsets on each of ``LEVELS`` levels), so that short and long texts
both have subsets in which a few terms remain. For each subset the distinct terms of a text that lie in it
are sorted and hashed; the fingerprint is the row of these hashes. Likeness is the share of equal hashes
among the sparsest levels' subsets in which either text has terms, taken level by level until ``ENOUGH`` are.

The lower end of the band is a share of the documents, which bounds the lexicon by the mean number
of distinct terms over that share, whatever the corpus size; that count is checked before broadcasting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanlens.llm.common import LOWER, chunks, distinct, mix, word_hashes, word_spans

LOW_SHARE, HIGH_SHARE = 0.0005, 0.05      # document-frequency band (high to low idf)
LEXICON_TERMS = 4_000_000                 # checked bound of the broadcast lexicon (8 bytes a term)
FIRST_LEVEL, LEVELS, PER_LEVEL = 3, 7, 8  # shares 1/8 to 1/512, eight subsets each
ENOUGH = 12                               # subsets a likeness rests on, where the texts have as many
_SEEDS = np.random.default_rng(99).integers(0, 2**64, LEVELS, dtype=np.uint64)
BLOCKS_PER_TASK = 4


def _term_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct term hashes of each row; terms are words, A-Z lower-cased."""
    low = LOWER[data]
    begin, end, rows = word_spans(low, offsets)
    w = word_hashes(low, begin, end)
    return [distinct(w[a:b]) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]


def term_frequencies(texts: DataFrame) -> DataFrame:
    """(term, df): documents that hold each term, counted per task first so that the shuffle has one row per task and term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_n, found, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merge(held, held_n, found):
            every = np.concatenate([held, *found])
            n = np.concatenate([held_n, np.ones(len(every) - len(held), np.int64)])
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            head = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            return every[head], np.add.reduceat(n, head) if len(head) else n

        def out(held, held_n):
            return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(held_n)], ["term", "n"])

        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)):
                for s in _term_sets(data, off):
                    found.append(s)
                    size += len(s)
                if size > 1_000_000:
                    held, held_n, found, size = *merge(held, held_n, found), [], 0
                if len(held) > 4_000_000:      # bounded memory: pass the partial counts on
                    yield out(held, held_n)
                    held, held_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, held_n = merge(held, held_n, found)
        yield out(held, held_n)

    return texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def band_lexicon(texts: DataFrame, low: float, high: float) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in [low, high] of the documents (at least 2)."""
    n = texts.count()
    least, most = max(2, int(np.ceil(low * n))), max(2, int(high * n))
    band = term_frequencies(texts).filter(F.col("df").between(least, most)).select("term")
    got = band.limit(LEXICON_TERMS + 1).toArrow()
    if got.num_rows > LEXICON_TERMS:
        raise ValueError(f"the band holds over {LEXICON_TERMS} terms; raise its lower share")
    return np.sort(got["term"].to_numpy().view(np.uint64))


def _signatures(sets: list[np.ndarray], lexicon: np.ndarray) -> np.ndarray:
    """One row per set, one 32-bit hash per subset of the sorted distinct terms in it; 0 where none is."""
    out = np.zeros((len(sets), LEVELS * PER_LEVEL), np.uint32)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    if not len(every) or not len(lexicon):
        return out
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known = lexicon[np.minimum(np.searchsorted(lexicon, every), len(lexicon) - 1)] == every
    every, row = every[known], row[known]
    for level in range(LEVELS):
        own = mix(every ^ _SEEDS[level])
        subset = (own >> np.uint64(64 - FIRST_LEVEL - level)).astype(np.int64)
        keep = np.flatnonzero(subset < PER_LEVEL)
        group = row[keep] * PER_LEVEL + subset[keep]
        keep = keep[order := np.argsort(group, kind="stable")]      # terms stay sorted inside a subset
        group = group[order]
        if not len(group):
            continue
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(group)) - np.repeat(head, np.diff(np.append(head, len(group))))
        total = mix(np.add.reduceat(mix(own[keep]) * (2 * rank + 1).astype(np.uint64), head))
        out[group[head] // PER_LEVEL, level * PER_LEVEL + group[head] % PER_LEVEL] = (total >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def _hex(s: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in s.astype(">u4")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; 1 for two texts without lexicon terms."""
    shape = (len(a), LEVELS, PER_LEVEL)
    used = ((a != 0) | (b != 0)).reshape(shape).sum(axis=2)[:, ::-1]
    same = ((a == b) & (a != 0)).reshape(shape).sum(axis=2)[:, ::-1]
    used, same = np.cumsum(used, axis=1), np.cumsum(same, axis=1)
    at = np.minimum((used < ENOUGH).sum(axis=1), LEVELS - 1)
    i = np.arange(len(a))
    return np.where(used[:, -1] > 0, same[i, at] / np.maximum(used[i, at], 1), 1.0)


def fingerprints(docs: DataFrame, lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``: the hex hashes of all subsets, equal for equal texts."""
    from pyspark.sql.types import StringType, StructType
    rest = [c for c in docs.columns if c != "fingerprint"]
    safe = [f"c{i}" for i in range(len(rest))]          # a name with a dot cannot pass through mapInArrow

    def stamp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x for _, _, data, off in chunks(batch.column(rest.index(text_col))) for x in _hex(_signatures(_term_sets(data, off), lexicon.value))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*safe, "fingerprint"])

    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, safe)])
    return rows.mapInArrow(stamp, StructType([*rows.schema.fields]).add("fingerprint", StringType())).toDF(*rest, "fingerprint")


def with_next(texts: DataFrame, blocks: int) -> DataFrame:
    """(id, text, next): each row of (id, text) with the text of the next row by (id, text); after the last comes the first.

    The ids are cut into ``blocks`` ranges at their quantiles (one small list); a range is one sort group, and the
    first row of a range travels to the range before it as well. Rows of one id stay in one range, in text order.
    """
    cuts = texts.filter("id is not null").agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)], 100_000)).first()[0] if blocks > 1 else []
    cuts = sorted(set(cuts or []))
    # block of an id: how many cuts it has reached; null ids come first
    block = F.when(F.col("id").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.lit(cuts) if cuts else F.expr("cast(array() as array<bigint>)"), lambda c: c <= F.col("id"))))
    placed = texts.select("id", "text", block.alias("block"))
    heads = placed.groupBy("block").agg(F.min(F.struct("id", "text")).alias("head"))
    order = Window.orderBy("block")
    first = heads.agg(F.min_by("head", "block").alias("head"))
    # one row per block: the head of the next block, or of the first one
    heads = heads.select(F.lead("block", -1).over(order).alias("block"), "head").filter("block is not null").unionByName(
        heads.agg(F.max("block").alias("block")).crossJoin(F.broadcast(first)))
    tails = heads.select(F.col("head.id").alias("id"), F.col("head.text").alias("text"), "block", F.lit(True).alias("tail"))
    group = Window.partitionBy("block").orderBy("tail", "id", "text")
    return (placed.withColumn("tail", F.lit(False)).unionByName(tails.select("id", "text", "block", "tail"))
            .withColumn("next", F.lead("text").over(group)).filter("not tail").select("id", "text", "next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many (or all) of the next
    document by ascending id. Null texts count as empty; texts without a lexicon term have the fingerprint of
    zeros and likeness 1 with each other. Rows with equal ids follow each other in text order, null ids come
    first; a table of one row is its own next document. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lexicon = spark.sparkContext.broadcast(band_lexicon(texts, low, high))
    blocks = BLOCKS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(texts, blocks).select(
        "id", F.col("text"), F.coalesce("next", F.col("text")).alias("next")).withColumns({
            "n_chars": F.char_length("text").cast("long"),
            "edited": F.concat(F.expr("left(text, cast(char_length(text) - char_length(text) div 2 as int))"), F.expr("if(char_length(text) < 2, '', left(next, cast(char_length(text) div 2 as int)))"))})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for batch in batches:
            signed = [np.concatenate([np.zeros((0, LEVELS * PER_LEVEL), np.uint32),
                                      *[_signatures(_term_sets(data, off), lex) for _, _, data, off in chunks(batch.column(c))]])
                      for c in ("text", "edited", "next")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_chars"), batch.column("edited_sha256"), pa.array(_hex(signed[0]), pa.string()),
                 pa.array(_hex(signed[1]), pa.string()), pa.array(likeness(signed[0], signed[1])), pa.array(likeness(signed[0], signed[2]))],
                ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = texts.schema["id"].dataType.simpleString()
    out = rows.withColumn("edited_sha256", F.sha2("edited", 256)).mapInArrow(
        compare, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)


def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
