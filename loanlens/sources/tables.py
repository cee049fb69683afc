"""Scans and sinks.

Paths for written artefacts come from the caller or from ``work_dir`` - a
folder under the cluster's shared ``spark.checkpoint.dir``. Only a local
session without that setting writes to a scratch folder of its machine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/loanlens-{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``work_dir`` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared location and read back, for jobs that read it several times
    (a plan is computed again by every fit and transform that reads it)."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_table(spark: SparkSession, directory: str, name: str, columns=None) -> DataFrame:
    """Parquet read with NaN turned into NULL once; selecting ``columns`` here
    lets the scan read only those (``ReadSchema``)."""
    df = spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return nan_to_null(df)


def csv_to_parquet(spark: SparkSession, csv_path: str, schema: T.StructType, parquet_path: str | None = None,
                   header: bool = True) -> DataFrame:
    """Read a CSV with a declared schema, write it as parquet beside it (or at
    ``parquet_path``), and return the parquet-backed table."""
    parquet_path = parquet_path or csv_path.rstrip("/").rsplit(".", 1)[0] + ".parquet"
    df = (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
          .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(csv_path))
    nan_to_null(df).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    (df.write.mode("overwrite").option("header", header)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    return path


def write_split_tables(tables: dict[str, DataFrame], out_dir: str, split_col: str = "split") -> dict[str, str]:
    """Write each table partitioned by its split column, so readers of one
    split prune the other split's files."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").partitionBy(split_col).parquet(path)
        paths[name] = path
    return paths


def write_feature_table(df: DataFrame, path: str, key: str | None = "SK_ID_CURR",
                        partitions: int | None = None) -> DataFrame:
    """Persist an aggregate table and return it read back. With a key the
    files are written clustered by that key (sorted within files) so later
    joins and point reads on it touch fewer row groups."""
    out = df
    if key is not None:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartition(n, key).sortWithinPartitions(key)
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed_table(df: DataFrame, name: str, path: str, key: str = "SK_ID_CURR",
                         buckets: int | None = None) -> DataFrame:
    """Save a feature table bucketed and sorted by ``key`` (files at ``path``,
    table ``name`` in the session catalog). Tables saved with the same key and
    bucket count join on the key without any exchange, so marts built from
    saved aggregates re-read them without a shuffle."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", path).format("parquet")
     .saveAsTable(name))
    return spark.table(name)


def write_report_csv(df: DataFrame, path: str) -> DataFrame:
    """Report tables (comparisons, rankings) as headed CSV: rows are dealt to
    files by their measured size, so a small report is one file and a table of
    any size is written by many tasks."""
    write_csv(df.hint("rebalance"), path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
