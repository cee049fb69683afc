"""Blocks of rows as one binary row each, and the pairing of index blocks with packs of queries.

Searches hold their index as a table with one row per block of input rows, written to the shared folder. A pack is a
bounded number of queries in one row. ``pair_up`` brings every pack to every block by an equi-join on slots: blocks are
never copied, packs are, and each task works on one bounded pair at a time.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

# Packs of at most this many bytes together (counted) are broadcast; more are shuffled to their slots.
PACK_BYTES = 16 << 20
# Blocks of one slot meet the same packs in one task, so results of a pack shrink there before they leave.
SLOT_BLOCKS = 8


def block_numbers() -> Iterator[int]:
    """Numbers of the blocks that the running task makes: unique over all tasks of a stage."""
    return itertools.count(TaskContext.get().partitionId() << 16)


def finite(vector: Column) -> Column:
    """Whether an array column is no null and holds neither nulls nor NaN nor infinities."""
    return vector.isNotNull() & F.coalesce(~F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))), F.lit(False))


def dense(column: pa.Array) -> np.ndarray:
    """Rows of a list column of longs as a matrix; shorter rows end in zeros."""
    n = len(column)
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    width = int(lengths.max(initial=0))
    flat = np.asarray(column.flatten(), np.int64)
    if (lengths == width).all():
        return flat.reshape(n, width)
    out = np.zeros((n, width), np.int64)
    start = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(n), lengths)
    out[row, np.arange(len(flat)) - start[row]] = flat
    return out


def long_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (0 where null) and whether each is null."""
    return np.asarray(column.fill_null(0), np.int64), np.asarray(column.is_null(), bool)


def best(score: np.ndarray, no_id: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score, then the smaller id (null last), then the earlier row."""
    if len(score) > 4 * k:                    # only rows from the k-th score on need sorting
        at = np.flatnonzero(score >= -np.partition(-score, k - 1)[k - 1])
        return at[np.lexsort((row[at], ids[at], no_id[at], -score[at]))[:k]]
    return np.lexsort((row, ids, no_id, -score))[:k]


def pair_up(blocks: DataFrame, packs: DataFrame, size: Column, on: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
    """Each row of ``blocks`` (with a long ``block``) beside each row of ``packs`` that is equal in the columns ``on``.

    Both are written tables; ``size`` is a pack's bytes. Few bytes of packs, as counted, are broadcast. Otherwise blocks
    are dealt over slots of about ``SLOT_BLOCKS`` blocks and packs are copied to every slot, so the shuffle carries the
    index once.
    """
    total = packs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    slots = 1 if total <= PACK_BYTES else max(1, blocks.count() // SLOT_BLOCKS)
    left = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots).cast("long")))
    right = packs.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    return left.join(F.broadcast(right) if total <= PACK_BYTES else right, ["slot", *on], how).drop("slot")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, binary columns as buffers without a copy."""
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for r in range(batch.num_rows):
            yield {name: (c[r].as_buffer() if pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type) else c[r].as_py())
                   for name, c in zip(batch.schema.names, columns)}


class Running:
    """Best k results of the packs a task is working on; packs are given out when more than ``held`` are open."""

    def __init__(self, k: int, make: Callable[[int, list], pa.RecordBatch], held: int = 8):
        self.k, self.make, self.held, self.packs = k, make, held, {}

    def of(self, pack: int, queries: int) -> list:
        """(scores, no_id, ids, rows) of each query of the pack so far."""
        if pack not in self.packs:
            self.packs[pack] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64))] * queries
        return self.packs[pack]

    def add(self, state: list, i: int, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        both = [np.concatenate(x) for x in zip(state[i], (score, no_id, ids, row))]
        keep = best(*both, self.k)
        state[i] = tuple(x[keep] for x in both)

    def full(self) -> Iterator[pa.RecordBatch]:
        while len(self.packs) > self.held:
            pack = next(iter(self.packs))
            yield self.make(pack, self.packs.pop(pack))

    def rest(self) -> Iterator[pa.RecordBatch]:
        for pack, state in self.packs.items():
            yield self.make(pack, state)
