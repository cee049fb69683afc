"""Shared tables, per-task text kernels and connected components for the corpus operators.

Intermediate tables are written under ``spark.checkpoint.dir`` (a folder every
executor and the driver can reach) and removed by the operator that wrote
them, so a lost executor never takes away the only copy of a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanlens.session import ensure_checkpoint_dir

# A table may be broadcast only after its rows were counted against this bound.
BROADCAST_ROWS = 1_000_000
# Bytes of text one vectorised step works on: bounds a worker's memory.
CHUNK_BYTES = 1 << 18


# ---------------------------------------------------------------- shared tables

class Scratch:
    """Tables of one operator run in the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/loanlens-llm/{label}-{uuid.uuid4().hex}"
        self.n = 0
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:02d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table: cuts lineage, survives lost executors."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Write ``df`` bucketed by ``key`` into as many buckets as a shuffle has partitions: joins on the key do not move it."""
        table = f"loanlens_{name}_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.option("compression", "zstd").option("path", self.path(name)).bucketBy(buckets, key).format("parquet").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def drop(self, df: DataFrame) -> None:
        """Remove the files of a table this run saved."""
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if self.root.split("/loanlens-llm/")[1] in folder:
                self._delete(folder)

    def result(self, df: DataFrame) -> DataFrame:
        """Write the final table outside the scratch folder, then remove the folder."""
        path = self.root.replace("/loanlens-llm/", "/loanlens-llm/result-")
        df.write.option("compression", "zstd").parquet(path)
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._delete(self.root)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table holds at most ``rows`` rows, by the counts in its files."""
    return df.count() <= rows


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text) of ``docs``; ``row`` is a digest of id and text, the same in every scan whatever the order of the input."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    marked = [F.concat(F.lit("="), c) for c in (F.col("id").cast("string"), F.col("text"))]       # null differs from empty
    return rows.select(F.md5(F.concat(F.coalesce(marked[0], F.lit("")), F.lit("\x00"), F.coalesce(marked[1], F.lit("")))).alias("row"), "id", "text")


# ---------------------------------------------------------------- text kernels

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.default_rng(2024)
BYTE_VALUE = _RNG.integers(0, 2**64, size=256, dtype=np.uint64)
_SHINGLE = _RNG.integers(0, 2**64, size=16, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary Arrow column; null rows are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``limit`` bytes; a longer row comes alone."""
    data, off = utf8(column)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+``, and for each row the range of its words."""
    inside = _WORD[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    turn = np.empty(len(data) + 1, bool)
    turn[0], turn[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=turn[1:-1])
    edge = np.flatnonzero(turn)
    begin, end = edge[::2], edge[1::2]
    # a word may not cross rows: cut it where a row starts inside it
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    if len(cuts):
        begin, end = np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (polynomial over random byte values, then mixed)."""
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def distinct(s: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    s = np.sort(s)
    new = s[1:] != s[:-1]
    return s if new.all() else s[np.concatenate([[True], new])] if len(s) else s


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles; a row of fewer words has its whole sequence as one."""
    low = LOWER[data]
    begin, end, rows = word_spans(low, offsets)
    w = word_hashes(low, begin, end)
    n = len(w)
    whole = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size if n >= size else 0):
        whole += w[j:n - size + 1 + j] * _SHINGLE[j]
    whole = mix(whole)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= size:
            out.append(distinct(whole[a:b - size + 1]))
        elif b > a:
            short = (w[a:b] * _SHINGLE[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# ---------------------------------------------------------------- rolling byte hashes

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
SEGMENT = 1 << 19


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        up, down = (np.full(n, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 2**64)))
        up[0] = down[0] = 1
        _POWERS[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[n]


def rolling(data: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first position, 64-bit hashes of the ``k``-byte strings that start there and after), a bounded segment at a time."""
    up, down = _powers(SEGMENT + k)
    for a in range(0, len(data) - k + 1, SEGMENT):
        value = BYTE_VALUE[data[a:a + SEGMENT + k - 1]] * up[:len(data[a:a + SEGMENT + k - 1])]
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        m = len(value) - k + 1
        yield a, mix((total[k:] - total[:m]) * down[:m])


# ---------------------------------------------------------------- components

def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected edge table (u, v); component is the smallest node reachable.

    Alternating large-star and small-star rounds over edges kept as (larger end, smaller end): ``low`` holds the
    smallest neighbour of each larger end, combined map-side. The large star hangs every larger end on the
    smallest neighbour of its smaller end, the small star hangs all smaller neighbours of a node on the
    smallest of them. The number of edges never grows, and the rounds end when every tree is flat. ``low`` is a
    written table, so both sides of each join are plain shuffles that AQE can split at a hot node. No edge reaches
    the driver. Self-loops and repeated edges are allowed; rows with a null end are ignored; no edges give no rows.
    """
    e = edges.filter("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = scratch.save(e.distinct(), "edges")
    while True:
        low = scratch.save(e.groupBy("u").agg(F.min("v").alias("m")), "low")
        below = low.select(F.col("u").alias("v"), "m")
        if low.count() == e.count() and e.join(below, "v", "left_semi").isEmpty():
            break
        large = scratch.save(e.join(below, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "large")
        scratch.drop(e)
        low = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = scratch.save(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(large)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
