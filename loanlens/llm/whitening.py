"""Embedding whitening with exact covariances from bit planes.

Each task packs chunks of rows: every dimension's integers, shifted by the chunk's smallest, are held as bit planes
across the rows, 64 rows a word. The sum of products of two dimensions is the sum over pairs of planes of
2**(a + b) * popcount(plane a AND plane b): exact integers, added up by Spark. The covariance n*sum(xy) - sum(x)*sum(y)
is centred in whole numbers of any size before it is rounded once for ``eigh``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanlens.llm.blocks import dense, finite
from loanlens.llm.common import Scratch

CHUNK_ROWS = 1 << 13            # rows that are packed at once: bounds a worker's memory
LIMIT = 1 << 40                 # largest magnitude of floor(64 * c)
COMPONENTS = 32
_CELLS = "i int, j int, v decimal(38,0)"
_CELL_TYPES = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.decimal128(38, 0))])


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(planes of u - lowest as (dims, bits, words), lowest of each dimension, bits) of an integer matrix (rows x dims)."""
    n, dims = u.shape
    low = u.min(axis=0)
    y = np.ascontiguousarray((u - low).T)
    bits = max(1, int(y.max(initial=0)).bit_length())
    planes = np.zeros((dims, bits, -(-n // 64) * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((y >> b).astype(np.uint8) & 1, axis=1, bitorder="little")
        planes[:, b, :packed.shape[1]] = packed
    return planes.view(np.uint64), low, bits


def scatter(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of u by dimension, sums of products of each two dimensions) as exact Python integers, by AND and popcount."""
    n, dims = u.shape
    planes, low, bits = bit_planes(u)
    flat = planes.reshape(dims * bits, -1)
    weight = np.array([1 << b for b in range(bits)], dtype=object)
    ones = np.bitwise_count(flat).sum(axis=1, dtype=np.int64).reshape(dims, bits)
    sums = (ones.astype(object) * weight).sum(axis=1)                       # of u - low
    products = np.zeros((dims, dims), dtype=object)
    narrow = 2 * bits + n.bit_length() <= 62                                # weighted counts fit into longs
    small = weight.astype(np.int64) if narrow else weight
    for i in range(dims):
        row = np.zeros((dims - i) * bits, np.int64 if narrow else object)
        for a in range(bits):
            count = np.bitwise_count(planes[i, a] & flat[i * bits:]).sum(axis=1, dtype=np.int64)
            row += count * small[a] if narrow else count.astype(object) * weight[a]
        products[i, i:] = (row.reshape(dims - i, bits) * small).sum(axis=1)
        products[i:, i] = products[i, i:]
    low = low.astype(object)
    return sums + n * low, products + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of a task: (i, j, sum of products), (-1, j, sum), (-1, -1, rows)."""
    n, total, products = 0, np.zeros(0, object), np.zeros((0, 0), object)
    for batch in batches:
        u = dense(batch.column(0))
        n += len(u)
        if u.size and max(-int(u.min()), int(u.max())) >= LIMIT:
            raise ValueError(f"floor(64 * component) reaches {LIMIT}: scale the vectors down")
        if u.shape[1] > len(total):
            grow = u.shape[1] - len(total)
            total, products = np.pad(total, (0, grow)), np.pad(products, (0, grow))
        d = u.shape[1]
        for a in range(0, len(u) if d else 0, CHUNK_ROWS):
            s, p = scatter(u[a:a + CHUNK_ROWS])
            total[:d] += s
            products[:d, :d] += p
    cells = [(-1, -1, n), *((-1, j, v) for j, v in enumerate(total))]
    cells += [(i, j, products[i, j]) for i in range(len(total)) for j in range(i, len(total))]
    for a in range(0, len(cells), 10_000):
        i, j, v = zip(*cells[a:a + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array([Decimal(int(x)) for x in v], pa.decimal128(38, 0))], schema=_CELL_TYPES)


def exact_sums(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(rows, sums, sums of products) of the integer vectors ``u``; only dims * dims / 2 added-up cells reach the driver."""
    cells = rows.select("u").mapInArrow(_sums, _CELLS).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    at = {(r["i"], r["j"]): int(r["v"]) for r in cells}
    d = 1 + max((j for _, j in at), default=-1)
    return at.get((-1, -1), 0), [at[-1, j] for j in range(d)], [[at[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


def eigen(n: int, sums: list[int], products: list[list[int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, unit eigenvectors as columns, trace) of the covariance with divisor n.

    Every entry is centred as a whole number and rounded once. Directions without variance (up to rounding) are left out.
    """
    d = len(sums)
    cov = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)]).reshape(d, d)
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    some = value > d * np.finfo(float).eps * max(float(value[0]) if d else 0.0, 0.0)
    return value[some], vector[:, some], float(np.trace(cov))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each remaining row and component.

    Rows whose vector is null or holds null or non-finite entries are dropped. x = floor(64 * c) + 1000000; a shorter
    vector counts as ending in c = 0. Components are the unit eigenvectors of the covariance of x (divisor n) by falling
    eigenvalue, up to ``components`` of those with variance: none, and so no rows, where all remaining rows are equal or
    none remain. ``deviation`` is the exact sum of (n*x - S)^2 (null where it exceeds a long). Repeated rows count each,
    null ids stay, other columns are ignored. |floor(64 * c)| has to stay below 2**40 (an error says so).
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whiten")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).filter(finite(F.col("v")))
    # 1000000 is added to every entry: deviations from the mean, and so all results, are those of u
    rows = scratch.save(rows.select("id", F.transform("v", lambda e: F.floor(e * F.lit(64.0))).alias("u")), "rows")
    n, sums, products = exact_sums(rows)
    value, vector, trace = eigen(n, sums, products) if n else (np.zeros(0), np.zeros((0, 0)), 0.0)
    value, vector = value[:components], vector[:, :components]
    project = vector / np.sqrt(value)
    d = len(sums)
    wide = d * (n * 2 * max([abs(s) for s in sums], default=0) + 1) ** 2
    centre = np.array(sums, dtype=object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = dense(batch.column(1))
            u = np.pad(u, ((0, 0), (0, d - u.shape[1])))
            for a in range(0, len(u), CHUNK_ROWS):
                part = u[a:a + CHUNK_ROWS]
                reach = max(-int(part.min()), int(part.max())) if part.size else 0
                if max(wide, d * (n * 2 * reach + 1) ** 2) < 1 << 62:      # whole numbers fit into longs
                    off = n * part - centre.astype(np.int64)
                    deviation = pa.array((off * off).sum(axis=1), pa.int64())
                    centred = off / n
                else:
                    off = n * part.astype(object) - centre
                    far = [(x * x).sum() for x in off]
                    deviation = pa.array([x if x < 1 << 63 else None for x in far], pa.int64())
                    centred = (off / n).astype(float)
                w = centred @ project
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(part)), deviation, pa.array(list(w), pa.list_(pa.float64()))],
                                                 names=["id", "deviation", "w"])
    schema = f"id {dict(rows.dtypes)['id']}, deviation long, w array<double>"
    scored = scratch.save(rows.mapInArrow(score, schema), "whitened")
    explained = [float(v) / trace for v in value]
    out = scored.select(F.col("id").alias(id_col), F.posexplode("w").alias("component", "whitened"), "deviation").select(
        id_col, (F.col("component") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>"), F.col("component") + 1).alias("explained"),
        F.lit(identity_error(scored, n, len(value))).alias("identity_error"))
    return scratch.result(out)


def identity_error(scored: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, from the rows themselves."""
    if not k:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK_ROWS):
                w = np.asarray(batch.column(0).slice(a, CHUNK_ROWS).flatten()).reshape(-1, k)
                total += w.sum(axis=0)
                products += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(k, -1), i]), pa.int32()), pa.array(np.concatenate([np.arange(k), j]), pa.int32()),
                                          pa.array(np.concatenate([total, products[i, j]]))], names=["i", "j", "v"])
    cells = {(r["i"], r["j"]): r["v"] for r in scored.select("w").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    # rows are centred before they are projected, so their means are rounding errors
    return max(math.fabs(cells[i, j] / n - (cells[-1, i] / n) * (cells[-1, j] / n) - (i == j)) for i in range(k) for j in range(i, k))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
