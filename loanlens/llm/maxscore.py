"""Ranked lexical search by MaxScore with bounds of term pairs.

The index holds one row per block of documents: for each term (a 64-bit hash) the documents and frequencies. For the
query terms of a pack of items every block then gets its impact lists and, for neighbouring terms of each item, the
intersection list of the two with the largest joint impact. A query walks an item's terms from the weakest: terms
whose bounds together stay below the score to beat are left out of the candidate search. The bound of a pair is the
largest impact that one document really has of both, which is smaller than the sum of the two maxima, so more terms
are left out and more documents are dropped before they are scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanlens.llm.blocks import Running, block_numbers, long_ids, pair_up, rows_of
from loanlens.llm.common import LOWER, Scratch, chunks, few, word_hashes

BLOCK_DOCS = 1 << 12
BLOCK_POSTINGS = 1 << 21         # a block is closed once it holds so many, so a worker's memory is bounded
PACK_ITEMS = 256
PACK_TERMS = 1 << 16
SEGMENT = 1 << 20                # bytes whose terms are hashed at once

_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True

_INDEX = ("block long, n_docs int, with_terms long, tokens long, ids binary, no_id binary, lengths binary, "
          "terms array<long>, dfs array<int>, docs binary, tfs binary")
_ITEMS = "item long, item_id long, no_item_id boolean, terms array<long>"
_PACKS = "pack long, q_n int, q_items binary, q_ids binary, q_no_id binary, q_starts binary, q_terms binary, vocabulary binary, weights binary"
_LISTS = ("pack long, block long, q_n int, q_items binary, q_ids binary, q_no_id binary, ids binary, no_id binary, n_docs int, starts binary, "
          "docs binary, impacts binary, q_starts binary, q_lists binary, tops binary, q_joint binary, seed_items array<long>, seed_scores array<long>")


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in schema.split(", "))])


# ---------------------------------------------------------------- terms

def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of digits, A-Z, a-z and bytes from 0x80 on, and each one's row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TERM[data]
    begin, end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]                 # a row that starts inside a run cuts it
    if len(cuts):
        begin, end = np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))
    return begin, end, np.searchsorted(offsets, begin, side="right") - 1


def term_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each term, a bounded stretch of bytes at a time."""
    out, a = np.zeros(len(begin), np.uint64), 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(end, begin[a] + SEGMENT, side="right")))
        out[a:b] = word_hashes(data[begin[a]:end[b - 1]], begin[a:b] - begin[a], end[a:b] - begin[a])
        a = b
    return out.view(np.int64)


def counted(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, terms, row of each from 0, frequency, terms with repeats of each row); terms ascend, then rows."""
    for a, b, data, offsets in chunks(column):
        low = LOWER[data]
        begin, end, row = term_spans(low, offsets)
        terms = term_hashes(low, begin, end)
        order = np.argsort(terms, kind="stable")
        terms, at = terms[order], row[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (at[1:] != at[:-1])
        first = np.flatnonzero(new)
        yield a, b, terms[first], at[first], np.diff(np.append(first, len(terms))), np.bincount(row, minlength=b - a)


# ---------------------------------------------------------------- index

def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) rows -> index blocks."""
    schema = _arrow(_INDEX)
    numbers, held, docs, postings = block_numbers(), [], 0, 0

    def out():
        terms, doc, tf = (np.concatenate([h[i] for h in held]) for i in range(3))
        lengths, ids, no_id = (np.concatenate([h[i] for h in held]) for i in range(3, 6))
        order = np.argsort(terms, kind="stable")                 # documents ascend within a term
        terms, doc, tf = terms[order], doc[order], tf[order]
        first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        df = np.diff(np.append(first, len(terms)))
        values = [next(numbers), len(ids), int((lengths > 0).sum()), int(lengths.sum()), ids.tobytes(), no_id.tobytes(), lengths.tobytes(),
                  terms[first], df.astype(np.int32), doc.astype(np.int32).tobytes(), tf.astype(np.int32).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)
    for batch in batches:
        ids, no_id = long_ids(batch.column(0))
        for a, b, terms, row, tf, lengths in counted(batch.column(1)):
            held.append((terms, row + docs, tf, lengths, ids[a:b], no_id[a:b]))
            docs, postings = docs + b - a, postings + len(terms)
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield out()
                held, docs, postings = [], 0, 0
    if held:
        yield out()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = block_numbers()
    for batch in batches:
        ids, no_id = long_ids(batch.column(0))
        for a, b, terms, row, _, _ in counted(batch.column(1)):
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(b - a + 1))
            each = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms[order]))
            yield pa.RecordBatch.from_arrays([pa.array([next(numbers) for _ in range(b - a)]), pa.array(ids[a:b]), pa.array(no_id[a:b]), each],
                                             names=["item", "item_id", "no_item_id", "terms"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, item_id, no_item_id, terms, weights) -> packs of bounded numbers of items and terms."""
    numbers, held, size = block_numbers(), [], 0

    def out():
        vocabulary, at = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
        weights = np.zeros(len(vocabulary), np.int64)
        weights[at] = np.concatenate([h[4] for h in held])
        starts = np.cumsum([0] + [len(h[3]) for h in held])
        return pa.RecordBatch.from_pylist([{
            "pack": next(numbers), "q_n": len(held), "q_items": np.array([h[0] for h in held], np.int64).tobytes(),
            "q_ids": np.array([h[1] for h in held], np.int64).tobytes(), "q_no_id": np.array([h[2] for h in held], bool).tobytes(),
            "q_starts": starts.astype(np.int64).tobytes(), "q_terms": at.astype(np.int64).tobytes(),
            "vocabulary": vocabulary.tobytes(), "weights": weights.tobytes()}], schema=_arrow(_PACKS))
    for batch in batches:
        for r in range(batch.num_rows):
            terms = np.asarray(batch.column(3)[r].values, np.int64)
            if held and (len(held) == PACK_ITEMS or size + len(terms) > PACK_TERMS):
                yield out()
                held, size = [], 0
            held.append((*[batch.column(i)[r].as_py() for i in range(3)], terms, np.asarray(batch.column(4)[r].values, np.int64)))
            size += len(terms)
    if held:
        yield out()


# ---------------------------------------------------------------- impact lists and pairs

def impacts(tf: np.ndarray, n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) of documents with n terms."""
    n = n.astype(object) if 50 * int(n.max(initial=0)) * documents >= 1 << 62 else n
    m = (50 + 50 * n * documents // max(tokens, 1)).astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def intersection(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The intersection list of two impact lists: documents of both and their joint impacts."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    return a[0][both], a[1][both] + b[1][at[both]]


def added(docs: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of the impacts of some documents (ascending) over lists."""
    score = np.zeros(len(docs), np.int64)
    for d, v in lists:
        if len(d):
            at = np.searchsorted(d, docs)
            at[at == len(d)] = 0
            hit = d[at] == docs
            score[hit] += v[at[hit]]
    return score


def _make_lists(documents: int, tokens: int, k: int):
    schema = _arrow(_LISTS)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms_column = batch.column(batch.schema.get_field_index("terms"))
            dfs_column = batch.column(batch.schema.get_field_index("dfs"))
            for i, r in enumerate(rows_of(iter([batch.drop_columns(["terms", "dfs"]).slice(j, 1) for j in range(batch.num_rows)]))):
                terms = np.asarray(terms_column[i].values, np.int64)
                ends = np.cumsum(np.asarray(dfs_column[i].values, np.int64))
                lengths = np.frombuffer(r["lengths"], np.int64)
                docs, tfs = np.frombuffer(r["docs"], np.int32), np.frombuffer(r["tfs"], np.int32)
                vocabulary, weights = np.frombuffer(r["vocabulary"], np.int64), np.frombuffer(r["weights"], np.int64)
                place = np.searchsorted(terms, vocabulary)
                place[place == len(terms)] = 0
                here = np.flatnonzero(terms[place] == vocabulary) if len(terms) else np.zeros(0, np.int64)
                lists, number = [], np.full(len(vocabulary), -1)
                for t in here.tolist():
                    e = int(ends[place[t]])
                    s = int(ends[place[t] - 1]) if place[t] else 0
                    d = docs[s:e]
                    number[t] = len(lists)
                    lists.append((d, weights[t] * impacts(tfs[s:e].astype(np.int64), lengths[d], documents, tokens)))
                top = np.array([int(v.max()) for _, v in lists] or [0], np.int64)
                pairs: dict[tuple[int, int], tuple[int, tuple]] = {}           # (largest joint impact, intersection list)
                q_starts, q_terms = np.frombuffer(r["q_starts"], np.int64), np.frombuffer(r["q_terms"], np.int64)
                q_items = np.frombuffer(r["q_items"], np.int64)
                q_lists, q_joint, new_starts, seed_items, seed_scores = [], [], [0], [], []
                for q in range(r["q_n"]):
                    own = number[q_terms[q_starts[q]:q_starts[q + 1]]]
                    own = own[own >= 0]
                    own = own[np.argsort(top[own], kind="stable")]
                    joints, strongest = [], None
                    for x, y in zip(own[::2].tolist(), own[1::2].tolist()):
                        if (x, y) not in pairs:
                            both = intersection(lists[x], lists[y])
                            pairs[x, y] = int(both[1].max(initial=0)), both
                        joints.append(pairs[x, y][0])
                        if joints[-1] and (strongest is None or joints[-1] >= strongest[0]):
                            strongest = pairs[x, y]
                    if len(own):
                        # true scores of the strongest pair's best documents: a score that k documents are known to reach
                        d, v = strongest[1] if strongest else lists[own[-1]]
                        best_docs = np.sort(d[np.argsort(-v, kind="stable")[:k]])
                        seed_scores.append(added(best_docs, [lists[x] for x in own]))
                        seed_items.append(np.full(len(best_docs), q_items[q]))
                    q_lists.append(own)
                    q_joint += joints + [0] * (len(own) - len(joints))
                    new_starts.append(new_starts[-1] + len(own))
                flat = [np.concatenate([x[i] for x in lists]) if lists else np.zeros(0, np.int64) for i in range(2)]
                values = [r["pack"], r["block"], r["q_n"], r["q_items"], r["q_ids"], r["q_no_id"], r["ids"], r["no_id"], r["n_docs"],
                          np.cumsum([0] + [len(x[0]) for x in lists]).astype(np.int64).tobytes(), flat[0].astype(np.int32).tobytes(),
                          flat[1].astype(np.int64).tobytes(), np.array(new_starts, np.int64).tobytes(),
                          np.concatenate([*q_lists, np.zeros(0, np.int64)]).astype(np.int64).tobytes(),
                          top.tobytes(), np.array(q_joint, np.int64).tobytes(),
                          np.concatenate([*seed_items, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*seed_scores, np.zeros(0, np.int64)]).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array([v.to_pybytes() if isinstance(v, pa.Buffer) else v], f.type) for v, f in zip(values, schema)], schema=schema)
    return make


# ---------------------------------------------------------------- search

def combined_bounds(tops: np.ndarray, joint: np.ndarray) -> list[int]:
    """The most that the first i + 1 terms add to one document: whole pairs by their joint maximum, one term alone by its own.

    A document with one term of a pair has that term's impact at most, and the second of a pair is the stronger one.
    """
    bounds, before = [], 0
    for i, top in enumerate(tops.tolist()):
        bounds.append(before + (max(int(joint[i // 2]), top) if i % 2 else top))
        before = bounds[-1] if i % 2 else before
    return bounds


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], bounds: list[int], beat: int, acc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a block that reach ``beat`` and are above 0.

    ``lists`` are the item's impact lists from the weakest on, ``bounds[i]`` the most that the first i + 1 add to one
    document, ``acc`` a zeroed array over the block's documents, which is left zeroed.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not lists or bounds[-1] < beat:
        return none
    bounds = [0, *bounds]
    weak = int(np.searchsorted(bounds, beat, side="left")) - 1          # the first `weak` terms alone stay below
    weak = max(weak, 0)
    for d, v in lists[weak:]:
        acc[d] += v
    docs = np.flatnonzero(acc)
    score = acc[docs]
    acc[docs] = 0
    for i in range(weak - 1, -1, -1):
        open_ = score + bounds[i + 1] >= beat
        docs, score = docs[open_], score[open_]
        if not len(docs):
            return none
        score = score + added(docs, [lists[i]])
    keep = score >= max(beat, 1)
    return docs[keep], score[keep]


def _search(k: int):
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[int, tuple] = {}

        def make(pack, state):
            items, ids, no_item = names.pop(pack)
            n = [len(s[0]) for s in state]
            score, no_id, doc, row = (np.concatenate(x) for x in zip(*state))
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(items, n)), pa.array(np.repeat(ids, n), mask=np.repeat(no_item, n)),
                                               pa.array(row), pa.array(doc, mask=no_id), pa.array(score)], schema=schema)
        running = Running(k, make)
        for r in rows_of(batches):
            items = np.frombuffer(r["q_items"], np.int64).copy()
            names[r["pack"]] = items, np.frombuffer(r["q_ids"], np.int64).copy(), np.frombuffer(r["q_no_id"], bool).copy()
            ids, no_id = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["no_id"], bool)
            starts, docs, impact = np.frombuffer(r["starts"], np.int64), np.frombuffer(r["docs"], np.int32), np.frombuffer(r["impacts"], np.int64)
            q_starts, q_lists, tops, q_joint = (np.frombuffer(r[c], np.int64) for c in ("q_starts", "q_lists", "tops", "q_joint"))
            beat = dict(zip(r["beat_items"] or [], r["beat_scores"] or []))
            state, acc = running.of(r["pack"], r["q_n"]), np.zeros(r["n_docs"], np.int64)
            for q in range(r["q_n"]):
                own = slice(q_starts[q], q_starts[q + 1])
                to_beat = max(beat.get(int(items[q]), 0), int(state[q][0][-1]) if len(state[q][0]) == k else 0)
                lists = [(docs[starts[x]:starts[x + 1]], impact[starts[x]:starts[x + 1]]) for x in q_lists[own].tolist()]
                found, score = search_block(lists, combined_bounds(tops[q_lists[own]], q_joint[own]), to_beat, acc)
                if len(found):
                    running.add(state, q, score, no_id[found], ids[found], (r["block"] << 16) + found)
            yield from running.full()
        yield from running.rest()
    return search


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents with a score above 0.

    Terms are maximal runs of digits, letters A-Z (lower-cased) and characters beyond ASCII in the whole text; null and
    empty texts have none. Equal scores go by ascending id, null ids last, then by row. Repeated document rows are
    documents of their own and count in all statistics; repeated item rows are ranked each. Items or documents without
    terms, and empty tables, give no rows. Ids are integers, other columns are ignored. Terms are compared by 64-bit
    hashes: 10^9 different terms against 10^5 query terms hold a wrong pair with odds of about 5e-6.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index = scratch.save(docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
                         .mapInArrow(_index, _INDEX), "index")
    wanted = scratch.save(items.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text"))
                          .mapInArrow(_item_terms, _ITEMS), "items")
    total = index.agg(F.coalesce(F.sum("with_terms"), F.lit(0)).alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    documents, tokens = total["documents"], total["tokens"]

    # document frequencies of the items' terms, summed over the blocks
    asked = wanted.select("item", "item_id", "no_item_id", F.explode("terms").alias("term"))
    vocabulary = scratch.save(asked.select("term").distinct(), "vocabulary")
    held = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.dfs").alias("df"))
    df = held.join(F.broadcast(vocabulary) if few(vocabulary) else vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weighed = asked.join(df.select("term", weight.alias("w")), "term").groupBy("item").agg(
        F.first("item_id").alias("item_id"), F.first("no_item_id").alias("no_item_id"), F.collect_list(F.struct("term", "w")).alias("x"))
    packs = scratch.save(weighed.select("item", "item_id", "no_item_id", F.col("x.term").alias("terms"), F.col("x.w").alias("weights"))
                         .mapInArrow(_pack, _PACKS), "packs")

    size = F.octet_length("q_terms") + F.octet_length("vocabulary") + F.octet_length("weights")
    lists = scratch.save(pair_up(index, packs, size).mapInArrow(_make_lists(documents, tokens, k), _LISTS), "lists")
    scratch.drop(index)

    # the score that k documents of each item are known to reach
    seeds = lists.select("pack", F.explode(F.arrays_zip("seed_items", "seed_scores")).alias("s")).select(
        "pack", F.col("s.seed_items").alias("item"), F.col("s.seed_scores").alias("score"))
    known = seeds.withColumn("place", F.row_number().over(Window.partitionBy("pack", "item").orderBy(F.desc("score")))).filter(F.col("place") <= k).filter(F.col("place") == k)
    known = known.groupBy("pack").agg(F.collect_list(F.struct("item", "score")).alias("x"))
    known = scratch.save(known.select("pack", F.col("x.item").alias("beat_items"), F.col("x.score").alias("beat_scores")), "known")
    pairs = pair_up(lists.drop("seed_items", "seed_scores"), known, F.size("beat_items") * 16, ("pack",), "left")
    found = scratch.save(pairs.mapInArrow(_search(k), "item long, item_id long, row long, doc_id long, score long"), "found")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return scratch.result(out.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*) AS n_all, CAST(sum(len(terms)) AS HUGEINT) AS l_all FROM d WHERE len(terms) > 0),
tf AS (
  SELECT doc_id, any_value(n) AS n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * any_value(n_all) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + CAST((50 * n * n_all) // l_all AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
