"""Benchmark decontamination by the q-gram lemma.

A leak is a document region within ``e`` edits of a window of ``w`` bytes of a benchmark item, at
any offset of the item. The region shares at least ``w - q + 1 - q * e`` of the window's q-grams,
all within a band of ``e`` diagonals. Per document:

1. every q-gram is looked up in the benchmark's q-gram table (rolling hashes over the whole text);
2. hits are sorted per item in diagonal bands twice as wide as needed that overlap by half, so
   any true region lies wholly in one band, and counted along the item;
3. window starts that reach the lemma's bound are verified by a banded alignment on the text.

Items shorter than a q-gram are looked up as they are.

The benchmark travels in blocks of a fixed number of bytes: each block is a bounded broadcast,
and the documents are scanned once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType

from loanlens.llm.common import Scratch, chunks, few, keyed_rows, mix, rolling

Q = 12                     # bytes of a q-gram
WINDOW = 100               # bytes of an item window, at every offset (a shorter item is one window)
EDIT_SHARE = 0.05          # edits allowed per window byte
LEAST = 40                 # items of fewer normalised bytes are looked up exactly
BLOCK_BYTES = 8 << 20      # benchmark bytes one scan looks for
_FILTER_BITS = 22
_UNKNOWN = 256
_STARTS = 2048             # window starts aligned at once


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[_SPACE] = 0x20


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, new offsets, and each kept byte's old position.

    A-Z and the capitals of Latin-1 (two bytes in UTF-8) become small, white-space runs one blank.
    """
    low = _FOLD[data]
    accent = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    low[1:][accent] += 0x20
    keep = np.ones(len(low), bool)
    keep[1:] = ~((low[1:] == 0x20) & (low[:-1] == 0x20))
    rows = offsets[:-1][offsets[:-1] < len(low)]
    keep[rows] = True
    at = np.flatnonzero(keep)
    return low[at], np.searchsorted(at, offsets), at


def _fold(text: str | None) -> bytes:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return _folded(raw, np.array([0, len(raw)]))[0].tobytes().strip()


def _qgrams(data: np.ndarray, q: int) -> np.ndarray:
    out = [h for _, h in rolling(data, q)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class _Index:
    """Items of a benchmark block and their q-grams, sorted by hash, with a bit filter in front.

    An item counts through its windows of ``width`` bytes at every offset (the whole item, if shorter), so each
    q-gram is held once, by its place in the item. Items shorter than a q-gram are held whole, by length.
    """

    def __init__(self, items: list[tuple[int, bytes]], q: int, window: int, share: float):
        items = [(item, text) for item, text in items if text]
        self.q, self.item, self.text = q, [item for item, _ in items], [np.frombuffer(text, np.uint8) for _, text in items]
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.width = np.minimum(self.size, window)
        self.edits = np.where(self.width >= LEAST, (share * self.width).astype(np.int64), 0)
        self.bound = np.maximum(1, self.width - q + 1 - q * self.edits)
        grams = [_qgrams(t, q) for t in self.text]
        h = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.of = np.repeat(np.arange(len(items)), [len(g) for g in grams])[order]
        self.pos = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hash >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.short = {}
        for k in sorted({len(t) for t in self.text if len(t) < q}):
            of = np.flatnonzero(self.size == k)
            h = np.concatenate([_qgrams(self.text[i], k) for i in of])
            order = np.argsort(h, kind="stable")
            self.short[k] = h[order], of[order]


def _hits(index: _Index, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text position, item, position in item) of every q-gram occurrence shared with the index."""
    at = np.flatnonzero(index.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    lo = np.searchsorted(index.hash, grams[at], side="left")
    n = np.searchsorted(index.hash, grams[at], side="right") - lo
    at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
    k = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
    return np.repeat(at, n), index.of[k], index.pos[k]


def _bands(index: _Index, doc: np.ndarray, at: np.ndarray, item: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, ...]]:
    """(doc, item, first and last diagonal, first and last start) of the windows whose distinct shared q-grams in a band reach the bound.

    In a band the places of the shared q-grams are sorted; a window start counts when ``bound`` of them in a row lie inside it.
    """
    width = 2 * (index.edits[item] + 1)
    for shift in (0, 1):
        key = np.stack([doc, item, (at - pos + shift * (width // 2)) // width, pos])
        key = key[:, np.lexsort(key[::-1])]
        new = np.ones(key.shape[1], bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        key = key[:, new]
        head = np.ones(key.shape[1], bool)
        head[1:] = (key[:3, 1:] != key[:3, :-1]).any(axis=0)
        group, place, w = np.cumsum(head), key[3], index.width[key[1]]
        last = np.arange(key.shape[1]) + index.bound[key[1]] - 1
        k = np.flatnonzero(last < key.shape[1])
        k = k[(group[last[k]] == group[k]) & (place[last[k]] - place[k] <= w[k] - index.q)]
        if not len(k):
            continue
        low = np.maximum(0, place[last[k]] + index.q - w[k])
        high = np.minimum(place[k], index.size[key[1, k]] - w[k])
        start = np.ones(len(k), bool)
        start[1:] = (group[k[1:]] != group[k[:-1]]) | (low[1:] > high[:-1] + 1)
        first = np.flatnonzero(start)
        end = np.append(first[1:], len(k)) - 1
        for (d, i, b), s0, s1 in zip(key[:3, k[first]].T.tolist(), low[first].tolist(), high[end].tolist()):
            size = 2 * (int(index.edits[i]) + 1)
            begin = b * size - shift * (size // 2)
            yield d, i, begin, begin + size - 1, s0, s1


def _nearest(text: np.ndarray, lo: int, hi: int, item: np.ndarray, s0: int, s1: int, w: int,
             first: int, last: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the best alignment in text[lo:hi] of each window item[s:s + w], s0 <= s <= s1; beyond the budget edits + 1.

    Banded: only cells on the diagonals first..last and an edit budget around them, one row of them per window byte
    and all windows at once. Windows that lie exactly on a diagonal need no rows.
    """
    span = max(last - first + 1 + 4 * edits, 1)
    d = np.arange(span)
    at = np.arange(s0, s1 + w)[:, None] + (first - 2 * edits) + d
    same = (at >= lo) & (at < hi)
    same &= text[np.clip(at, lo, hi - 1)] == item[s0:s1 + w, None]
    run = np.zeros((len(at) + 1, span), np.int32)
    np.cumsum(same, axis=0, out=run[1:])
    exact = run[w:] - run[:-w] == w
    found = exact.any(axis=1)
    end = np.arange(s0, s1 + 1)[:, None] + w + (first - 2 * edits) + d
    best, cost = exact.argmax(axis=1), np.where(found, 0, edits + 1)
    rest = np.flatnonzero(~found)
    if edits and len(rest):
        begin = end[rest] - w
        # cell d stands for the region that ends at end[., d] - w + i after i window bytes
        row = np.where((d >= edits) & (begin >= lo) & (begin <= hi), 0, _UNKNOWN).astype(np.int16)
        step, edge = d.astype(np.int16), np.full((len(rest), 1), _UNKNOWN, np.int16)
        for i in range(w):
            up = np.concatenate([row[:, 1:], edge], axis=1) + np.int16(1)
            row = np.minimum(row + ~same[rest + i], up)
            row = np.minimum.accumulate(row - step, axis=1) + step
        row = np.where((end[rest] >= lo) & (end[rest] <= hi), row, _UNKNOWN)
        best[rest] = row.argmin(axis=1)
        cost[rest] = np.minimum(row.min(axis=1), edits + 1)
    return cost, end[np.arange(len(end)), best]


def _aligned(window: bytes, region: np.ndarray, edits: int) -> tuple[int, int] | None:
    """(edits, end) of the best alignment of the whole window inside the region, or None beyond the budget."""
    r, w = len(region), len(window)
    if not r:
        return (w, 0) if w <= edits else None
    cost, end = _nearest(region, 0, r, np.frombuffer(window, np.uint8), 0, 0, w, edits, max(r - w, 0) - edits, edits)
    return (int(cost[0]), int(end[0])) if cost[0] <= edits else None


def _merged(found: list[tuple[int, int, int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(doc, item, begin, end, least edits) of the unions of overlapping regions of one document and item."""
    now = None
    for d, i, begin, end, cost in sorted(found):
        if now and now[:2] == (d, i) and begin < now[3]:
            now = (d, i, now[2], max(now[3], end), min(now[4], cost))
            continue
        if now:
            yield now
        now = (d, i, begin, end, cost)
    if now:
        yield now


_FOUND = "row string, item long, span_start long, span_end long, edits int"


def contaminated_spans(texts: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW,
                       share: float = EDIT_SHARE) -> DataFrame:
    """(row, item, span_start, span_end, edits): byte spans of (row, text) close to windows of a (item, text) benchmark.

    Overlapping regions of one item are one span; ``edits`` is the least of its windows.
    """
    spark = texts.sparkSession
    sized = benchmark.select("item", "text", F.octet_length("text").alias("size")).filter("size > 0")
    before = F.sum("size").over(Window.orderBy("item").rowsBetween(Window.unboundedPreceding, 0))
    total = sized.agg(F.sum("size")).first()[0] or 0
    parts = [None] if total <= BLOCK_BYTES else range(int(total // BLOCK_BYTES) + 1)
    out = None
    for part in parts:
        block = sized if part is None else sized.withColumn("b", F.floor(before / BLOCK_BYTES)).filter(F.col("b") == part)
        rows = [(r["item"], _fold(r["text"])) for r in block.toLocalIterator()]
        index = spark.sparkContext.broadcast(_Index(rows, q, window, share))
        found = texts.select("row", "text").mapInArrow(_search(index, q), _FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def _search(index, q: int):
    def leaks(ix: _Index, low: np.ndarray, new: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        at, item, pos = _hits(ix, _qgrams(low, q))
        doc = np.searchsorted(new, at, side="right") - 1
        inside = at + q <= new[doc + 1]
        at, item, pos, doc = at[inside], item[inside], pos[inside], doc[inside]
        # few shared q-grams of an item in a document: below the lemma's bound in every band
        _, back, n = np.unique(doc * len(ix.text) + item, return_inverse=True, return_counts=True)
        many = n[back] >= ix.bound[item]
        for d, i, first, last, s0, s1 in _bands(ix, doc[many], at[many], item[many], pos[many]):
            lo, hi, w, e = int(new[d]), int(new[d + 1]), int(ix.width[i]), int(ix.edits[i])
            for a in range(s0, s1 + 1, _STARTS):
                cost, end = _nearest(low, lo, hi, ix.text[i], a, min(s1, a + _STARTS - 1), w, first, last, e)
                for c, z in zip(cost[cost <= e].tolist(), end[cost <= e].tolist()):
                    yield d, i, max(lo, z - w), z, c
        for k, (known, of) in ix.short.items():
            h = _qgrams(low, k)
            left = np.searchsorted(known, h, side="left")
            n = np.searchsorted(known, h, side="right") - left
            at = np.repeat(np.flatnonzero(n), n[n > 0])
            item = of[np.concatenate([np.zeros(0, np.int64), *[np.arange(x, x + y) for x, y in zip(left[n > 0], n[n > 0])]]).astype(np.int64)]
            doc = np.searchsorted(new, at, side="right") - 1
            for d, i, z in zip(doc.tolist(), item.tolist(), at.tolist()):
                if z + k <= new[d + 1] and (low[z:z + k] == ix.text[i]).all():
                    yield d, i, z, z + k, 0

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: _Index = index.value
        for batch in batches:
            key = batch.column(0)
            for a, _, data, off in chunks(batch.column(1)):
                low, new, at_old = _folded(data, off)
                if not len(low) or not ix.text:
                    continue
                rows = [(key[a + d].as_py(), ix.item[i], int(at_old[begin] - off[d]), int(at_old[end - 1] - off[d]) + 1, cost)
                        for d, i, begin, end, cost in _merged(list(leaks(ix, low, new)))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*dict.fromkeys(rows)), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                        ["row", "item", "span_start", "span_end", "edits"])

    return search


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``contaminated``, ``item_ids`` (sorted), ``n_spans``, ``least_edits`` and the byte ``spans``.

    A document is contaminated when a region of it lies within the edit budget of a window of a benchmark item,
    at any offset (of a whole item, if that is shorter than a window; items of fewer than LEAST folded bytes have
    no edits). Case (A-Z) and white-space runs do not count.
    Null or empty texts are clean; null or empty items match nothing; items with a null id are looked for and reported with a null item. Repeated rows keep
    a row each; extra columns are ignored; empty tables give clean documents or no rows.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    # the key follows from the row's content, so it is the same in every scan of the input, whatever its order; equal rows share results
    rows = keyed_rows(docs, id_col, text_col)
    items = scratch.save(benchmark.select(F.monotonically_increasing_id().alias("nr"), F.col(f"`{item_col}`").alias("item"),
                                          F.col(f"`{item_text_col}`").cast("string").alias("text")), "items")
    found = contaminated_spans(rows.select("row", "text"), items.select(F.col("nr").alias("item"), "text"))
    found = found.withColumnRenamed("item", "nr").join(items.select("nr", "item"), "nr")
    each = found.groupBy("row").agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"), F.min("edits").alias("least_edits"),
        F.sort_array(F.collect_set(F.struct("span_start", "span_end", F.col("item").alias("item_id")))).alias("spans"))
    each = scratch.save(each, "spans")
    out = rows.select("row", "id").join(F.broadcast(each) if few(each) else each, "row", "left").select(
        F.col("id").alias(id_col), F.col("spans").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(ArrayType(items.schema["item"].dataType))).alias("item_ids"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "least_edits", "spans")
    return scratch.result(out)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
