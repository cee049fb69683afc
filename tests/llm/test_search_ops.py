"""Ranked search, whitening and exact top-k against brute force, with nulls, ties, repeats, long texts and empty tables."""
import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanlens.llm import blocks, bsi_topk, maxscore, whitening
from tests.conftest import SF

# ---------------------------------------------------------------- 11: ranked lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    bags = [collections.Counter(terms(t)) for _, t in docs]
    n = [sum(b.values()) for b in bags]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = collections.Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), bag, size in zip(docs, bags, n):
            m = 50 + 50 * size * big_n // max(big_l, 1)
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
                    for t in set(terms(text)) if t in bag)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -s) for i, (s, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcéß日") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    texts = [" ".join(vocab[int(rng.random() ** 2 * 120)] for _ in range(rng.randint(1, 80))) for _ in range(n)]
    docs = list(enumerate(texts))
    docs += [(900 + i, texts[0]) for i in range(40)] + [(901, texts[0]), (901, "other " + texts[1])]      # copies tie, ids repeat
    docs += [(None, texts[0]), (None, texts[3]), (700, None), (701, ""), (702, "  ...\n--"), (703, "ABC abc Abc"), (704, texts[5].upper())]
    docs.append((705, ("lorem " * 60_000 + vocab[0] + "x" * 1_200_000 + " ") + vocab[1]))                # long text and long term
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))) for i in range(12)]
    items += [(3, texts[0]), (None, texts[3]), (50, None), (51, ""), (52, "nowhere"), (53, texts[0] + " " + texts[0]), (54, "LOREM")]
    return docs, items


SCHEMA = "{} long, text string, block long, slot long, terms string, `a.b` int"


def search(spark, docs, items, k=5, parts=3):
    d = spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in docs], SCHEMA.format("doc_id")).repartition(parts)
    q = spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in items], SCHEMA.format("item_id")).repartition(2)
    return sorted((tuple(r) for r in maxscore.ranked_search(d, q, k=k).collect()), key=repr)


@pytest.mark.parametrize("k", [1, 5, 60])
def test_ranked_search_equals_brute_force(spark, k):
    docs, items = corpus(3, 150)
    assert search(spark, docs, items, k) == brute_search(docs, items, k)


def test_ranked_search_over_shuffled_packs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "PACK_BYTES", 0)            # packs go to slots by a shuffle
    monkeypatch.setattr(blocks, "SLOT_BLOCKS", 2)
    docs, items = corpus(4, 80)
    assert search(spark, docs, items, 5, 7) == brute_search(docs, items, 5)


def test_ranked_search_of_empty_tables(spark):
    docs, items = corpus(5, 10)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []
    assert search(spark, [(1, None), (2, "?!")], items) == []


def test_pair_bounds_are_safe_and_tighter():
    rng = np.random.default_rng(1)
    tighter = 0
    for _ in range(200):
        m, n = int(rng.integers(1, 9)), 60
        lists = []
        for _ in range(m):
            d = np.flatnonzero(rng.random(n) < rng.random())
            d = d if len(d) else np.array([0])
            lists.append((d.astype(np.int32), rng.integers(1, 1000, len(d))))
        lists.sort(key=lambda x: int(x[1].max()))
        tops = np.array([x[1].max() for x in lists])
        joint = np.array([int(maxscore.intersection(a, b)[1].max(initial=0)) for a, b in zip(lists[::2], lists[1::2])] + [0], np.int64)
        bounds = maxscore.combined_bounds(tops, joint)
        dense = np.zeros((m, n), np.int64)
        for i, (d, v) in enumerate(lists):
            dense[i, d] = v
        assert all(b >= dense[:i + 1].sum(axis=0).max() for i, b in enumerate(bounds))
        assert all(b <= t for b, t in zip(bounds, np.cumsum(tops)))
        tighter += bounds[-1] < tops.sum()
        beat = int(rng.integers(0, bounds[-1] + 2))
        acc = np.zeros(n, np.int64)
        docs, score = maxscore.search_block(lists, bounds, beat, acc)
        want = dense.sum(axis=0)
        assert dict(zip(docs.tolist(), score.tolist())) == {i: int(s) for i, s in enumerate(want) if s >= max(beat, 1)} and not acc.any()
    assert tighter > 100


# ---------------------------------------------------------------- 13: exact top-k

def brute_topk(rows, k, every):
    codes = [None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(1024 * x) for x in v] for _, v in rows]
    out = []
    for q, (qid, _) in enumerate(rows):
        if codes[q] is None or qid is None or qid % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(codes[q], c)), rows[i][0] is None, rows[i][0] or 0)
                        for i, c in enumerate(codes) if i != q and c is not None)
        out += [(qid, r + 1, None if null else vid, -s) for r, (s, null, vid) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 8)]) for i in range(n)]
    rows += [(2000 + i, rows[5][1]) for i in range(30)]                                       # a group of copies: ties
    rows += [rows[0], rows[0], (7, rows[1][1]), (None, rows[2][1]), (None, [0.0] * 8)]        # repeated rows and ids, null ids
    rows += [(3000, None), (3001, [None] + [1.0] * 7), (3002, [float("nan")] * 8), (3003, [float("inf")] * 8), (3004, []), (3005, [0.5, -0.25]),
             (3006, [x * 20 for x in rows[3][1]] + [1.0]), (3007, [-0.0] * 8)]
    return rows


VEC = "vec_id long, embedding array<float>, block long, slot int, row string, `a.b` int"


def top_k(spark, rows, k, parts=4, every=10):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, 2, "r", 3) for i, v in rows], VEC).repartition(parts)
    got = bsi_topk.exact_top_k(df, F.col("vec_id") % every == 0, k=k)
    return sorted((tuple(r) for r in got.collect()), key=repr), brute_topk(rows, k, every)


@pytest.mark.parametrize("k", [1, 10, 400])
def test_top_k_equals_brute_force(spark, k):
    got, want = top_k(spark, vectors(1, 250), k)
    assert got == want


def test_top_k_over_shuffled_packs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "PACK_BYTES", 0)
    monkeypatch.setattr(blocks, "SLOT_BLOCKS", 2)
    got, want = top_k(spark, vectors(2, 300), 7, parts=9)
    assert got == want


def test_top_k_of_odd_tables(spark):
    assert top_k(spark, [], 3) == ([], [])
    assert top_k(spark, [(1, [1.0])], 3) == ([], [])                       # no query
    assert top_k(spark, [(10, [1.0])], 3) == ([], [])                      # no other row
    assert top_k(spark, [(10, [1.0]), (20, None)], 3) == ([], [])
    with pytest.raises(Exception, match="scale the vectors down"):
        top_k(spark, [(10, [1.0]), (1, [1e9])], 3)


def test_bitmap_sums_and_selection():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        codes = rng.integers(-40, 90, (n, 6))
        query = rng.integers(-50, 50, 6)
        ids = np.arange(n)
        block = bsi_topk.Block(bsi_topk._pack_rows(codes, ids, ids < 0, ids < 0, 3))
        slices, cut, left_out, constant = block.sums(query)
        held = np.zeros(n, np.int64)
        for w, s in enumerate(slices):
            held |= np.unpackbits(s.view(np.uint8), bitorder="little")[:n].astype(np.int64) << w
        true = codes @ query
        low = constant + (held << cut)
        assert (low <= true).all() and (true <= low + left_out).all()
        k = int(rng.integers(1, n + 3))
        kth = bsi_topk.kth_value(slices, block.rows, k)
        assert kth == (np.sort(held)[-k] if k <= n else 0)
        for value in (kth, kth - 3, int(held.max()) + 1, 0, -5, 1 << 40):
            assert bsi_topk.at_least(slices, block.rows, value).tolist() == np.flatnonzero(held >= value).tolist()


# ---------------------------------------------------------------- 12: whitening

def test_scatter_is_exact():
    rng = np.random.default_rng(2)
    for high, n in ((2, 1), (2, 65), (70, 300), (1 << 20, 129), (1 << 39, 40)):
        u = rng.integers(-high, high, (n, 5))
        u[:, 2] = 7                                                        # a constant dimension
        sums, products = whitening.scatter(u)
        o = u.astype(object)
        assert (sums == o.sum(axis=0)).all() and (products == o.T @ o).all()


def whitened(spark, rows, components=32, parts=3):
    df = spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], "vec_id long, embedding array<double>, n long, u double, `a.b` int").repartition(parts)
    return whitening.whiten(df, components=components).collect()


def check_whitened(got, rows, components):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = max(len(v) for _, v in kept)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (d - len(v)) for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    off = n * x - s
    cov = (off.T @ off / n ** 3).astype(float)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > d * 2.3e-16 * e[0]).sum()))
    assert len(got) == n * k
    want = (off / n).astype(float) @ v[:, :k] / np.sqrt(e[:k])
    by = collections.defaultdict(list)
    for r in got:
        by[r["component"]].append((r["vec_id"] is None, r["vec_id"] or 0, round(r["whitened"], 6), r))
    for c in range(k):
        side = sorted((i is None, i or 0, round(float(w), 6)) for (i, _), w in zip(kept, want[:, c]))
        other = sorted((i is None, i or 0, round(float(-w), 6)) for (i, _), w in zip(kept, want[:, c]))
        mine = sorted(x[:3] for x in by[c + 1])

        def near(a, b):
            return all(p[:2] == q[:2] and abs(p[2] - q[2]) < 1e-5 for p, q in zip(a, b))
        assert near(mine, side) or near(mine, other)
        assert all(abs(x[3]["explained"] - e[c] / np.trace(cov)) <= 1e-9 for x in by[c + 1])
    far = sorted((i is None, i or 0, int(f)) for (i, _), f in zip(kept, (off * off).sum(axis=1)))
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]) for r in got if r["component"] == 1) == far
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6) * [1, 2, 3, 0.5, 4, 0.2]]) for i in range(400)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (9001, None), (9002, [None] * 6), (9003, [float("nan")] * 6), (9004, [float("-inf")] * 6),
             (9005, [1.0, 2.0]), (9006, [])]
    check_whitened(whitened(spark, rows), rows, 32)
    check_whitened(whitened(spark, rows, 2, 1), rows, 2)


def test_whitening_leaves_out_directions_without_variance(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), 3.0, float(b)]) for i, (a, b) in enumerate(rng.normal(0, 1, (50, 2)))]
    got = whitened(spark, rows)
    assert {r["component"] for r in got} == {1, 2}
    check_whitened(got, rows, 32)
    assert whitened(spark, []) == [] and whitened(spark, [(1, [1.0, 2.0])] * 3) == [] and whitened(spark, [(1, None), (2, [])]) == []


# ---------------------------------------------------------------- the registered queries

@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_bsi_topk"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, cur.fetchall()))


def test_whitening_query_covers_its_table(spark):
    got = entry.queries()["op12_embedding_whitening"](spark, SF).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(got, rows, 32)
