"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result below the
shared checkpoint folder and reads it back as the next one's input. All but the last keep the columns of
``documents``; the last returns one row per selected copy of a document. Rows are judged one by one: the stages that
decide on whole documents write a row key first, so null ids and ids with several texts lose nothing else. Null texts are
kept as empty ones, repeated rows are near duplicates of each other, and an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanlens.llm import decontaminate, mixing, near_join, quality_crf, suffix_dedup
from loanlens.llm.common import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject (score >= 0.7)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~quality_crf.held_out("doc_id", 4, 2))
    scored = quality_crf.quality_scores(_columns(docs), labels)
    return _columns(scored.filter("predicted = 1"))


def _keyed(spark: SparkSession, docs: DataFrame, label: str) -> DataFrame:
    """The columns and a written ``row`` key, the same in every later read."""
    return Scratch(spark, label).save(_columns(docs).withColumn("row", F.monotonically_increasing_id()), "rows")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each near-duplicate group, null ids last; a repeated row is left out, also without words."""
    docs = _keyed(spark, docs, "groups")
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("name"), "text")
    heads = near_join.near_duplicate_components(named, id_col="name").filter("name = component_id").select("name.row", "n_shingles")
    wordless = docs.join(heads.filter("n_shingles = 0"), "row", "left_semi").groupBy(*COLUMNS).agg(F.min("row").alias("row"))
    keep = heads.filter("n_shingles > 0").select("row").unionByName(wordless.select("row"))
    return _columns(docs.join(keep, "row", "left_semi"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur elsewhere; n_chars follows the text."""
    cut = suffix_dedup.without_repeats(_columns(docs))
    return _columns(cut.withColumn("n_chars", F.char_length("text").cast("long")))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    docs = _keyed(spark, docs, "leaks")
    found = decontaminate.contaminated_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    return _columns(docs.join(found.filter("contaminated").select("row"), "row", "left_anti"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of documents that the source budgets select."""
    return mixing.mix_counts(_columns(docs))


STAGES = [("quality", keep_good), ("near_duplicates", one_of_each_group), ("suffix_dedup", cut_repeats),
          ("decontamination", drop_leaks), ("mixing", mix)]

# the classifier, the byte cuts and the alignment have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        after = scratch.save(stage(spark, docs, sf_dir), name)
        if before is not None and name != STAGES[-1][0]:
            scratch.drop(before)
        before, docs = after, after
    return docs
