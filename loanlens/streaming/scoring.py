"""Scoring: batch, stream, and record validation.

The reference serves one JSON application per HTTP request. Here the same
fitted pipeline scores DataFrames: a batch table, or an unbounded file stream
with the declared request schema through Structured Streaming (stateless,
checkpointed, exactly-once file sink). Malformed records are quarantined
instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evaluate import apply_threshold
from ..roles import PROFITABLE_THRESHOLD, REQUEST_FIELDS

_TYPES = {"int": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}  # Python int: 64-bit


def request_schema(fields: Sequence[tuple[str, str]] = REQUEST_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


def text_request_schema(fields: Sequence[tuple[str, str]] = REQUEST_FIELDS) -> T.StructType:
    """Raw records as they arrive: every field as text."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fields])


def score_batch(df: DataFrame, model: PipelineModel, threshold: float = PROFITABLE_THRESHOLD,
                key: str = "SK_ID_PREV") -> DataFrame:
    """``(key, refused, probability)``: refused when probability > threshold."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(key, apply_threshold(p, threshold).alias("refused"), p.alias("probability"))


def validate_records(raw: DataFrame, fields: Sequence[tuple[str, str]] = REQUEST_FIELDS, key: str = "SK_ID_PREV"):
    """Split text records into typed good rows and quarantined rows.

    A field fails when it is missing or does not convert to its declared type
    (``try_cast``, so bad input never fails the job). Returns
    ``(good, quarantine)``; quarantine rows keep the raw text and list the
    failing fields."""
    casts = {n: F.col(n).try_cast(_TYPES[t]) for n, t in fields}
    checks = [F.when(F.col(n).isNull() | casts[n].isNull(), F.lit(n)) for n, _ in fields]
    tagged = raw.withColumn("_errors", F.concat_ws(",", *checks))
    good = tagged.where(F.col("_errors") == "").select(*[casts[n].alias(n) for n, _ in fields])
    bad = tagged.where(F.col("_errors") != "").select(*[F.col(n) for n, _ in fields],
                                                     F.col("_errors").alias("errors"))
    return good, bad


def score_stream(spark: SparkSession, source_dir: str, model: PipelineModel, sink_dir: str, checkpoint_dir: str,
                 threshold: float = PROFITABLE_THRESHOLD, key: str = "SK_ID_PREV", fmt: str = "parquet",
                 available_now: bool = True, quarantine_dir: str | None = None):
    """Stream request files from ``source_dir`` (text fields), validate, score
    and write ``(key, refused, probability)`` under ``sink_dir/batch_id=N``. The
    checkpoint makes restarts resume where they stopped, and a replayed batch
    overwrites its own folder, so each record is scored into the sink once.
    Returns the started query."""
    raw = spark.readStream.schema(text_request_schema()).format(fmt).load(source_dir)

    def handle(batch: DataFrame, epoch: int) -> None:
        # each micro-batch owns one folder, overwritten on a retry: a replayed
        # batch after a failure replaces its own output instead of adding to it
        batch.persist()      # good and bad rows both come from it: each file is parsed once
        try:
            good, bad = validate_records(batch)
            score_batch(good, model, threshold, key).write.mode("overwrite").parquet(f"{sink_dir}/batch_id={epoch}")
            if quarantine_dir is not None:
                bad.write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={epoch}")
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
