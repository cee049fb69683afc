"""Removal of byte strings that repeat anywhere in a corpus, by blockwise suffix sorting.

Every suffix matters only through its first ``length`` bytes, so suffixes are sorted by a
96-bit fingerprint of that prefix. Sorting all suffixes at once would move several times the
corpus; the construction is blockwise instead:

1. the documents are packed into text blocks of a few MB, written once. Copies of a whole
   document are found by their digest; one of them stands for all;
2. a difference cover D of period ``v`` marks the sampled positions: for any two positions
   there is a shift below ``v`` that takes both into the sample. If two ``length``-byte strings
   are equal, the ``length - v + 1`` bytes at that shift are equal at two sampled positions.
   The names (64-bit fingerprints) of all sampled strings are sorted, one bucket of names per
   task, which yields the rank class "occurs again" of each sample. Different strings with the
   same name only add suffixes to the next step;
3. only suffixes that see a repeated sample within the period can have a long common prefix.
   They are sorted by two independent fingerprints (64 and 32 bits) of their prefix, again one suffix
   bucket per task; a suffix whose neighbour in the bucket carries the same pair is a repeated string;
4. the answers return to the text blocks as bit strings and the covered bytes are cut.

Buckets are ranges of the fingerprint and their number follows the corpus, so a task holds one
bucket, whatever the corpus size. A string that occurs many times sends each block's copy once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanlens.llm.common import SEGMENT, Scratch, mix, rolling, utf8

BLOCK_BYTES = 4 << 20          # text of one block (a longer document is a block of its own)
BUCKET_BYTES = 64 << 20        # corpus bytes behind one bucket of names or suffixes
#: Difference cover modulo 133 (every difference occurs): 12 of 133 positions.
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True


def _blocks(docs: DataFrame) -> DataFrame:
    """Consecutive rows (id, text) packed into blocks: ids, digests, end offsets and the concatenated UTF-8 bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        ids, digests, ends, parts, size = [], [], [], [], 0

        def block():
            one = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | seq], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(one)], pa.int32()), one),
                 pa.array([digests], pa.list_(pa.binary())), pa.array([np.array(ends, np.int64).tobytes()], pa.binary()),
                 pa.array([b"".join(parts)], pa.binary())], ["block", "ids", "digests", "ends", "text"])

        for batch in batches:
            data, off = utf8(batch.column(1))
            for i in range(batch.num_rows):
                piece = data[off[i]:off[i + 1]].tobytes()
                if ends and size + len(piece) > BLOCK_BYTES:
                    yield block()
                    ids, digests, ends, parts, size, seq = [], [], [], [], 0, seq + 1
                ids.append(batch.column(0).slice(i, 1))
                digests.append(hashlib.sha256(piece).digest())
                size += len(piece)
                ends.append(size)
                parts.append(piece)
        if ends:
            yield block()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(pack, f"block long, ids array<{kind}>, digests array<binary>, ends binary, text binary")


def _unpack(ends: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[0], np.frombuffer(ends, np.int64)]), np.frombuffer(text, np.uint8)


def _room(off: np.ndarray, skip: np.ndarray, k: int, n: int) -> np.ndarray:
    """True at the positions where a ``k``-byte string fits into its document, copies left out."""
    step = np.zeros(n + 1, np.int8)
    fits = (np.diff(off) >= k) & ~skip
    np.add.at(step, off[:-1][fits], 1)
    np.add.at(step, off[1:][fits] - k + 1, -1)
    return np.cumsum(step[:n], dtype=np.int8) > 0


def _names(text: np.ndarray, k: int, wanted: np.ndarray) -> np.ndarray:
    """Fingerprints of the ``k``-byte strings at the wanted positions, in text order."""
    out = []
    for a, h in rolling(text, k):
        out.append(h[wanted[a:a + len(h)]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


@cache
def _word_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD1342543DE82EF95
    up, down = (np.full(n, b, np.uint64) for b in (base, pow(base, -1, 2**64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _second_names(text: np.ndarray, k: int, wanted: np.ndarray) -> np.ndarray:
    """Second fingerprints (32 bits) as in ``_names``, polynomials over the mixed 8-byte words at every offset.

    Over single bytes, polynomials modulo 2^64 are equal for some regular strings; mixed words have no such order.
    """
    out = [np.zeros(0, np.uint64)]
    up, down = _word_powers(SEGMENT + k)
    for a in range(0, len(text) - k + 1, SEGMENT):
        piece = text[a:a + SEGMENT + k - 1]
        m = len(piece) - k + 1
        if not wanted[a:a + m].any():
            continue
        word = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(piece, 8)).view(np.uint64).ravel()
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(mix(word + np.uint64(0x632BE59BD9B4E019)) * up[:len(word)], out=total[1:])
        out.append(mix((total[k - 7:] - total[:m]) * down[:m])[wanted[a:a + m]])
    return (np.concatenate(out) >> np.uint64(32)).astype(np.uint32)


def _order(names: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Positions in order of the names, their second halves deciding where equal names differ in them."""
    order = np.argsort(names, kind="stable")
    s, t = names[order], second[order]
    same = s[1:] == s[:-1]
    return order if (t[1:][same] == t[:-1][same]).all() else np.lexsort((second, names))


def _sampled(off: np.ndarray, skip: np.ndarray, k: int, n: int) -> np.ndarray:
    """Positions of the cover sample, counted from each document's start."""
    inside = np.arange(n) - np.repeat(off[:-1], np.diff(off))
    return _room(off, skip, k, n) & _IN_COVER[inside % PERIOD]


def _covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + k, n), -1)
    return np.cumsum(step[:n]) > 0


def _candidates(off: np.ndarray, skip: np.ndarray, sample: np.ndarray, again: np.ndarray, length: int, n: int) -> np.ndarray:
    """Starts of ``length``-byte strings that see a repeated sample within the period."""
    x = np.flatnonzero(sample)[again]
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.maximum(x - (PERIOD - 1), 0), 1)
    np.add.at(step, x + 1, -1)
    return (np.cumsum(step[:n]) > 0) & _room(off, skip, length, n)


def _pack_sorted(s: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct fingerprints as differences of 5, 6 or 8 bytes."""
    d = np.diff(s, prepend=np.uint64(0))
    width = 5 if int(d[1:].max(initial=0)) < 1 << 40 else 6 if int(d[1:].max(initial=0)) < 1 << 48 else 8
    head = s[:1].tobytes()
    return width, head + d[1:].reshape(-1, 1).view(np.uint8)[:, :width].tobytes()


def _unpack_sorted(width: int, raw: bytes) -> np.ndarray:
    head = np.frombuffer(raw[:8], np.uint64)
    body = np.frombuffer(raw[8:], np.uint8).reshape(-1, width)
    d = np.zeros((len(body), 8), np.uint8)
    d[:, :width] = body
    return np.cumsum(np.concatenate([head, d.view(np.uint64).ravel()]), dtype=np.uint64)


_ASK = "bucket int, block long, width int, names binary, second binary, twice binary"


def _distinct(names: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """Sorted distinct names (with their second halves), each input's place among them, and how often each occurs."""
    if second is None:
        s, back, count = np.unique(names, return_inverse=True, return_counts=True)
        return s, None, back, count
    order = _order(names, second)
    s, t = names[order], second[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    back = np.empty(len(s), np.int64)
    back[order] = np.cumsum(new) - 1
    return s[new], t[new], back, np.bincount(back, minlength=int(new.sum()))


def _requests(block: int, names: np.ndarray, buckets: int, second: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per bucket: the block's distinct fingerprints in the bucket, and which occur in the block more than once."""
    s, t, _, count = _distinct(names, second)
    if not len(s):
        return
    of = (s >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cut = np.searchsorted(of, np.arange(buckets + 1))
    rows = [(b, block, *_pack_sorted(s[i:j]), None if t is None else t[i:j].tobytes(), np.packbits(count[i:j] > 1).tobytes())
            for b, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if j > i]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
        ["bucket", "block", "width", "names", "second", "twice"])


def _again(parts: list[np.ndarray], seconds: list[bytes | None]) -> list[np.ndarray]:
    """For each part, which of its names (with their second halves) occur in another part."""
    every = np.concatenate(parts)
    if seconds[0] is None:
        every.sort()
        again = np.unique(every[1:][every[1:] == every[:-1]])
        if not len(again):
            return [np.zeros(len(s), bool) for s in parts]
        return [again[np.minimum(np.searchsorted(again, s), len(again) - 1)] == s for s in parts]
    second = np.concatenate([np.frombuffer(t, np.uint32) for t in seconds])
    order = _order(every, second)
    every, second = every[order], second[order]
    same = (every[1:] == every[:-1]) & (second[1:] == second[:-1])
    again = np.zeros(len(order), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return np.split(again, np.cumsum([len(s) for s in parts])[:-1])


def _answers(asked: DataFrame) -> DataFrame:
    """Sort one bucket at a time: for each block and bucket, the bits of the names that occur again."""
    def sort_bucket(table: pa.Table) -> pa.Table:
        block, width, raw, second, twice = (table.column(c).to_pylist() for c in ("block", "width", "names", "second", "twice"))
        parts = [_unpack_sorted(w, r) for w, r in zip(width, raw)]
        out = [np.packbits(again | np.unpackbits(np.frombuffer(t, np.uint8), count=len(again)).astype(bool)).tobytes()
               for again, t in zip(_again(parts, second), twice)]
        return pa.table({"block": pa.array(block, pa.int64()), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(sort_bucket, "block long, bucket int, bits binary")


def _flags(names: np.ndarray, bits: list, buckets: int, second: np.ndarray | None = None) -> np.ndarray:
    """The answers of a block put back in text order. ``bits``: (bucket, bits) rows of the block."""
    s, _, back, _ = _distinct(names, second)
    of = (s >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cut = np.searchsorted(of, np.arange(buckets + 1))
    flag = np.zeros(len(s), bool)
    for b, raw in bits:
        i, j = cut[b], cut[b + 1]
        flag[i:j] = np.unpackbits(np.frombuffer(raw, np.uint8), count=j - i).astype(bool)
    return flag[back]


def _with_answers(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    out = blocks
    for i, a in enumerate(answers):
        rows = a.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"a{i}"))
        out = out.join(rows.hint("shuffle_hash"), "block", "left")       # the hash table holds the answers, the texts pass by
    return out


def _lists(column, i: int) -> list:
    got = column[i].as_py()
    return [(r["bucket"], r["bits"]) for r in got or []]


def _copy_masks(n: int, got: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Per document of a block: (left out of the sort, a copy of another document; repeated as a whole)."""
    skip, whole = np.zeros(n, bool), np.zeros(n, bool)
    for r in got or []:
        whole[r["at"]], skip[r["at"]] = True, not r["stands"]
    return skip, whole


def cut_repeats(docs: DataFrame, scratch: Scratch, length: int, with_text: bool) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) of each row of (id, text)."""
    k = length - PERIOD + 1
    if k < 8:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    # three passes read the texts beside small answers to their block: the texts are bucketed by block and never shuffled
    blocks = scratch.save_bucketed(_blocks(docs), "blocks", "block")
    # copies of a whole document: the first stands for all, and all of them go if long enough
    each = blocks.select("block", F.posexplode("digests").alias("at", "d"))
    first = each.groupBy("d").agg(F.min(F.struct("block", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("d", "first")
    marks = scratch.save(each.join(first, "d").groupBy("block").agg(F.collect_list(
        F.struct("at", (F.struct("block", "at") == F.col("first")).alias("stands"))).alias("copies")), "copies")
    marked = blocks.join(marks.hint("shuffle_hash"), "block", "left")
    total = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(8, total // BUCKET_BYTES + 1))
    wide = 2 * buckets         # a suffix has twice the bytes of a sample's name

    def rows_of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                off, text = _unpack(batch.column("ends")[i].as_py(), batch.column("text")[i].as_py())
                skip, whole = _copy_masks(len(off) - 1, batch.column("copies")[i].as_py())
                whole &= np.diff(off) >= length
                yield batch, i, off, text, skip, whole

    def ask_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, off, text, skip, _ in rows_of(batches):
            yield from _requests(batch.column("block")[i].as_py(), _names(text, k, _sampled(off, skip, k, len(text))), buckets)

    def suspects(batch, i, off, text, skip) -> np.ndarray:
        sample = _sampled(off, skip, k, len(text))
        again = _flags(_names(text, k, sample), _lists(batch.column("a0"), i), buckets)
        return _candidates(off, skip, sample, again, length, len(text))

    def ask_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, off, text, skip, _ in rows_of(batches):
            wanted = suspects(batch, i, off, text, skip)
            yield from _requests(batch.column("block")[i].as_py(), _names(text, length, wanted), wide, _second_names(text, length, wanted))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, off, text, skip, whole in rows_of(batches):
            wanted = suspects(batch, i, off, text, skip)
            hit = _flags(_names(text, length, wanted), _lists(batch.column("a1"), i), wide, _second_names(text, length, wanted))
            gone = _covered(len(text), np.flatnonzero(wanted)[hit], length)
            rows = []
            for a, b, all_of_it in zip(off[:-1].tolist(), off[1:].tolist(), whole.tolist()):
                mask = np.ones(b - a, bool) if all_of_it else gone[a:b]
                kept = text[a:b][~mask].tobytes()
                rows.append((b - a, int(mask.sum()), int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()),
                             hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), *cols],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    slim = marked.select("block", "ends", "text", "copies")
    names = scratch.save(_answers(slim.mapInArrow(ask_names, _ASK)), "names")
    suffixes = scratch.save(_answers(_with_answers(slim, names).mapInArrow(ask_suffixes, _ASK)), "suffixes")
    kind = docs.schema["id"].dataType.simpleString()
    return _with_answers(marked.drop("digests"), names, suffixes).mapInArrow(
        cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts are UTF-8 bytes; a byte goes when a ``length``-byte string that covers it starts at
    any other place of the corpus too, overlapping places and the same document included.
    Strings never cross documents and are judged on the input. Null texts count as empty and
    have nothing removed. Repeated rows and null ids stay, one output row each; other columns
    are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = cut_repeats(texts, scratch, length, with_text=False)
    return scratch.result(cut.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = 200) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes cut from the text; rows and other columns stay as they are.

    Characters that a cut leaves incomplete are dropped. A null text becomes empty.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    rest = [c for c in docs.columns if c != text_col]
    safe = {c: f"c{i}" for i, c in enumerate(rest)}          # field names of the struct that carries the other columns
    texts = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in safe.items()]).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    cut = cut_repeats(texts, scratch, length, with_text=True)
    return scratch.result(cut.select(*[F.col("kept_text").alias(c) if c == text_col else F.col(f"id.{safe[c]}").alias(c) for c in docs.columns]))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
