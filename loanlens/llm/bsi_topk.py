"""Exact top-k search by inner product over a bit-sliced index.

Every block of rows holds, for each dimension, the bits of its quantised values as bitmaps over the rows (slices). A
query's score is a sum of shifted slices, one for each bit of each weight, and slices are added as bitmaps by full
adders, 64 rows a word. Products below a cut of significance are left out, which bounds every score from both sides.
Rows are then selected from the most significant slice of the sum downward; the rows that the bounds cannot decide
are scored exactly, so the result is the exact top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loanlens.llm.blocks import Running, block_numbers, dense, finite, long_ids, pair_up, rows_of
from loanlens.llm.common import Scratch

BLOCK_ROWS = 1 << 15           # rows of one block: bounds a worker's memory
PACK_QUERIES = 1024
ERROR_SHIFT = 7                # products left out sum to at most 2**-7 of the largest possible score
LIMIT = 1 << 26                # largest magnitude of a quantised component

_INDEX = ("block long, n int, dims int, ids binary, no_id binary, is_query binary, codes binary, "
          "low binary, plane_dim binary, plane_bit binary, slices binary")
_PACKS = "pack long, q_n int, q_dims int, q_row binary, q_ids binary, q_codes binary"


def _pack_rows(codes: np.ndarray, ids, no_id, is_query, block: int) -> dict:
    """One index row of a code matrix (rows x dimensions)."""
    n, dims = codes.shape
    if n and dims and max(-int(codes.min()), int(codes.max())) >= LIMIT:
        raise ValueError(f"a quantised component reaches {LIMIT}: scale the vectors down")
    columns = np.ascontiguousarray(codes.T)
    low = columns.min(axis=1) if n else np.zeros(dims, np.int64)
    above = columns - low[:, None]
    widths = [int(x).bit_length() for x in above.max(axis=1)] if n else [0] * dims
    words = -(-n // 64)
    planes = np.zeros((sum(widths), words * 8), np.uint8)
    dim, bit = np.repeat(np.arange(dims), widths), np.concatenate([np.arange(w) for w in widths] or [np.zeros(0, int)])
    for p, (d, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        packed = np.packbits((above[d] >> b).astype(np.uint8) & 1, bitorder="little")
        planes[p, :len(packed)] = packed
    return {"block": block, "n": n, "dims": dims, "ids": ids.tobytes(), "no_id": no_id.tobytes(), "is_query": is_query.tobytes(),
            "codes": columns.astype(np.int32).tobytes(), "low": low.astype(np.int64).tobytes(), "plane_dim": dim.astype(np.int32).tobytes(),
            "plane_bit": bit.astype(np.int32).tobytes(), "slices": planes.tobytes()}


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, is_query, codes) rows -> index blocks of at most BLOCK_ROWS rows."""
    numbers = block_numbers()
    held: list[tuple] = []

    def out(parts):
        width = max(p[3].shape[1] for p in parts)
        codes = np.concatenate([np.pad(p[3], ((0, 0), (0, width - p[3].shape[1]))) for p in parts])
        row = _pack_rows(codes, *[np.concatenate([p[i] for p in parts]) for i in range(3)], next(numbers))
        return pa.RecordBatch.from_pylist([row], schema=_arrow(_INDEX))
    for batch in batches:
        ids, no_id = long_ids(batch.column(0))
        part = (ids, no_id, np.asarray(batch.column(1).fill_null(False), bool), dense(batch.column(2)))
        at = 0
        while at < len(ids):
            take = BLOCK_ROWS - sum(len(p[0]) for p in held)
            held.append(tuple(x[at:at + take] for x in part))
            at += take
            if sum(len(p[0]) for p in held) >= BLOCK_ROWS:
                yield out(held)
                held = []
    if held:
        yield out(held)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query rows of each index block, in packs of at most PACK_QUERIES."""
    for r in rows_of(batches):
        at = np.flatnonzero(np.frombuffer(r["is_query"], bool))
        codes = np.frombuffer(r["codes"], np.int32).reshape(r["dims"], r["n"])
        ids = np.frombuffer(r["ids"], np.int64)
        for i in range(0, len(at), PACK_QUERIES):
            some = at[i:i + PACK_QUERIES]
            yield pa.RecordBatch.from_pylist([{
                "pack": (r["block"] << 16) + i, "q_n": len(some), "q_dims": r["dims"], "q_row": ((r["block"] << 16) + some).tobytes(),
                "q_ids": ids[some].tobytes(), "q_codes": np.ascontiguousarray(codes[:, some].T).tobytes()}], schema=_arrow(_PACKS))


class Block:
    """An index block in a worker."""

    def __init__(self, r: dict):
        self.number, self.n, self.dims = r["block"], r["n"], r["dims"]
        self.ids, self.no_id = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["no_id"], bool)
        self.codes = np.frombuffer(r["codes"], np.int32).reshape(self.dims, self.n)
        self.low = np.frombuffer(r["low"], np.int64)
        self.dim, self.bit = np.frombuffer(r["plane_dim"], np.int32), np.frombuffer(r["plane_bit"], np.int32).astype(np.int64)
        planes = np.frombuffer(r["slices"], np.uint64).reshape(len(self.dim), -(-self.n // 64))
        # a negative weight reads the complement: weight * (largest - value) and a constant
        self.planes = np.concatenate([planes, ~planes])
        self.largest = np.zeros(self.dims, np.int64)
        np.add.at(self.largest, self.dim, np.int64(1) << self.bit)
        rows = np.zeros(-(-self.n // 64) * 8, np.uint8)
        packed = np.packbits(np.ones(self.n, np.uint8), bitorder="little")
        rows[:len(packed)] = packed
        self.rows = rows.view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list, int, int, int]:
        """(slices of the truncated sum, cut, largest sum left out, constant): score = constant + (sum << cut) + 0..left out."""
        d = min(self.dims, len(query))
        weight = np.zeros(self.dims, np.int64)
        weight[:d] = query[:d]
        size, negative = np.abs(weight), weight < 0
        constant = int((weight * (self.low + np.where(negative, self.largest, 0))).sum())
        plane = np.arange(len(self.dim)) + np.where(negative[self.dim], len(self.dim), 0)
        at, place = [], []
        for j in range(int(size.max(initial=0)).bit_length()):
            hit = ((size[self.dim] >> j) & 1).astype(bool)
            at.append(plane[hit])
            place.append(self.bit[hit] + j)
        at, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, place))
        by_place = np.bincount(place)
        worth = [int(c) << w for w, c in enumerate(by_place.tolist())]
        cut, left_out, bound = 0, 0, sum(worth) >> ERROR_SHIFT
        while cut < len(worth) and left_out + worth[cut] <= bound:
            left_out += worth[cut]
            cut += 1
        order = np.argsort(place, kind="stable")
        end = np.cumsum(by_place)
        columns = {w - cut: [self.planes[at[order[end[w] - by_place[w]:end[w]]]]] for w in range(cut, len(by_place)) if by_place[w]}
        return added(columns, self.rows), cut, left_out, constant

    def exact(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        d = min(self.dims, len(query))
        return query[:d].astype(np.int64) @ self.codes[:d, at].astype(np.int64) if d else np.zeros(len(at), np.int64)


def added(columns: dict[int, list], rows: np.ndarray) -> list[np.ndarray]:
    """Slices (least significant first) of the sum of bitmaps, given by significance; full adders work on thirds at once."""
    out, w = [], 0
    while any(v >= w for v in columns):
        x = np.concatenate(columns[w]) if w in columns else np.zeros((0, len(rows)), np.uint64)
        while len(x) > 1:
            m = len(x) // 3
            if m:
                a, b, c = x[:m], x[m:2 * m], x[2 * m:3 * m]
                ab = a ^ b
                carry, x = (a & b) | (ab & c), np.concatenate([ab ^ c, x[3 * m:]])
            else:
                carry, x = x[:1] & x[1:], x[:1] ^ x[1:]
            columns.setdefault(w + 1, []).append(carry)
        out.append(x[0] if len(x) else np.zeros(len(rows), np.uint64))
        w += 1
    return out


def kth_value(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """Largest value that at least k of the rows reach (0 if there are fewer), from the most significant slice downward."""
    value, above, open_rows = 0, 0, rows
    for w in range(len(slices) - 1, -1, -1):
        hit = open_rows & slices[w]
        n = int(np.bitwise_count(hit).sum(dtype=np.int64))
        if above + n >= k:
            open_rows, value = hit, value | 1 << w
        else:
            above, open_rows = above + n, open_rows & ~slices[w]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """Positions of the rows whose sum reaches ``value``."""
    if value >> len(slices) > 0:
        return np.zeros(0, np.int64)
    above, equal = np.zeros_like(rows), rows
    for w in range(len(slices) - 1, -1, -1):
        if value > 0 and value >> w & 1:
            equal = equal & slices[w]
        else:
            above, equal = above | equal & slices[w], equal & ~slices[w]
    kept = rows if value <= 0 else above | equal
    return np.flatnonzero(np.unpackbits(kept.view(np.uint8), bitorder="little"))


def _search(k: int):
    schema = pa.schema([("q_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[int, tuple] = {}

        def make(pack, state):
            q_row, q_ids = names.pop(pack)
            n = [len(s[0]) for s in state]
            score, no_id, ids, row = (np.concatenate(x) for x in zip(*state))
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_row, n)), pa.array(np.repeat(q_ids, n)), pa.array(row),
                                               pa.array(ids, mask=no_id), pa.array(score)], schema=schema)
        running, block = Running(k, make), None
        for r in rows_of(batches):
            if block is None or block.number != r["block"]:
                block = Block(r)
            q_row = np.frombuffer(r["q_row"], np.int64)
            names[r["pack"]] = q_row.copy(), np.frombuffer(r["q_ids"], np.int64).copy()
            queries = np.frombuffer(r["q_codes"], np.int32).reshape(r["q_n"], r["q_dims"])
            state = running.of(r["pack"], r["q_n"])
            own = q_row - (block.number << 16)
            for i in range(r["q_n"]):
                slices, cut, left_out, constant = block.sums(queries[i].astype(np.int64))
                # k + 1, since the query's own row may be among them
                lowest = kth_value(slices, block.rows, k + 1) - (left_out >> cut)
                if len(state[i][0]) == k:
                    lowest = max(lowest, -((constant + left_out - int(state[i][0][-1])) >> cut))
                at = at_least(slices, block.rows, lowest)
                at = at[at != own[i]]
                if len(at):
                    running.add(state, i, block.exact(at, queries[i]), block.no_id[at], block.ids[at], (block.number << 16) + at)
            yield from running.full()
        yield from running.rest()
    return search


def exact_top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
                scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row's k best other rows by inner product of floor(scale * x).

    Queries are the rows where ``is_query`` holds (null: no). Ties go to the smaller id, null ids last, then to the
    earlier row. Vectors that are null or hold null or non-finite components take no part. A shorter vector counts as
    ending in zeros. Repeated rows are candidates of each other and queries of their own. Ids are integers; other
    columns are ignored; no rows or no queries give no rows. Quantised components have to stay below 2**26 in
    magnitude (an error says so), so that scores of up to 2,048 dimensions are exact longs.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), vector.alias("v"))
    codes = rows.filter(finite(F.col("v"))).select("id", "is_query", F.transform("v", lambda e: F.floor(e * F.lit(float(scale)))).alias("codes"))
    index = scratch.save(codes.mapInArrow(_build, _INDEX), "index")
    packs = scratch.save(index.select("block", "n", "dims", "ids", "is_query", "codes").mapInArrow(_queries, _PACKS), "queries")
    pairs = pair_up(index.drop("is_query"), packs, F.octet_length("q_codes"))
    found = scratch.save(pairs.mapInArrow(_search(k), "q_row long, query_id long, row long, vec_id long, score long"), "found")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return scratch.result(out)


def op13_bsi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return exact_top_k(vectors, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH rows_ AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM rows_ q JOIN rows_ c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
