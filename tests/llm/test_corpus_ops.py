"""Corpus operators against brute force, round trips and held-out accuracy, with nulls, ties, repeats and empty tables."""
import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanlens.llm import decontaminate, imatch, license_scan, mixing, near_join, quality_crf, suffix_dedup, toxicity, url_filter, warc
from loanlens.llm.common import Scratch, components, rolling
from loanlens.llm.common import utf8 as common_utf8
from tests.conftest import SF

DOC = "doc_id long, text string, lang string, source string, n_chars long, n long, token string, row long, prefix string"


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", f"src{k % 3}", len(t or ""), 1, "t", 2, "p") for k, (i, t) in enumerate(zip(ids, texts))], DOC)


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", low)


def random_texts(seed, n, vocabulary=400, size=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, size))) for _ in range(n)], rng, vocab


# ---------------------------------------------------------------- 8: n-gram Jaccard join

def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_near_join_equals_brute_force(spark):
    texts, rng, vocab = random_texts(1, 60)
    for _ in range(90):                                   # near copies at many distances, chains of them too
        w = rng.choice(texts).split(" ")
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [None, "", "  \n\t", "one", "ONE", "one two three", "one  two\nthree", texts[0], texts[0], "x " * 3000]
    n, comp = brute_components(texts)
    got = rows(near_join.near_duplicate_components(docs(spark, texts)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (n[i], comp[i]) for i in range(len(texts))}


def test_components_of_paths_stars_cycles_and_loops(spark):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(40)]
    star = [("m", f"s{i:03d}") for i in range(200)] + [(f"t{i:03d}", "z") for i in range(200)]     # small and large centres
    cycle = [("c1", "c3"), ("c3", "c2"), ("c2", "c1"), ("c1", "c3")]
    edges = path + star + cycle + [("l", "l"), (None, "q"), ("q", None)]
    got = components(Scratch(spark, "test"), spark.createDataFrame(edges, "u string, v string")).collect()
    want = {n: "p00" for e in path for n in e} | {n: "m" for e in star[:200] for n in e} | {n: "t000" for e in star[200:] for n in e}
    assert len(got) == len(set(got)) and {r["node"]: r["component"] for r in got} == want | {"c1": "c1", "c2": "c1", "c3": "c1"}
    assert components(Scratch(spark, "test"), spark.createDataFrame([], "u string, v string")).count() == 0


def test_near_join_repeated_and_null_ids_and_empty(spark):
    got = near_join.near_duplicate_components(docs(spark, ["a b c d e f"] * 3 + ["q"], [7, None, 3, None])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("3", "3"), ("7", "3"), ("None", "3"), ("None", "None")]
    assert near_join.near_duplicate_components(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- 2: suffix dedup

def brute_cut(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        mask = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                mask[i:i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(x, mask) if not m)
        out.append((len(x), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    texts, rng, _ = random_texts(2, 40, size=200)
    passage = texts[0][:230] + "ü"
    for i in range(12):                                   # planted at any offset, across lengths around the limit
        k = rng.randrange(len(texts))
        at = rng.randrange(len(texts[k]) + 1)
        texts[k] = texts[k][:at] + passage[rng.randint(0, 20):rng.randint(190, 231)] + texts[k][at:]
    texts += [texts[1], texts[1], None, "", "ab" * 300, "é" * 199, "z" * 200, "z" * 199]
    got = rows(suffix_dedup.remove_repeats(docs(spark, texts)))
    assert [tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for i in range(len(texts))] == brute_cut(texts)
    kept = rows(suffix_dedup.without_repeats(docs(spark, texts)))
    assert list(kept[0]) == docs(spark, []).columns and kept[len(texts) - 6]["text"] == ""


def test_cover_has_every_difference():
    d = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert d == set(range(suffix_dedup.PERIOD))


def test_strings_with_one_fingerprint_stay(spark):
    # two different strings of 200 bytes whose 64-bit fingerprints are equal
    pairs = ["di", "*c", "-t"]
    a, b = ("".join(p[bin(i).count("1") % 2 ^ turn] for p in pairs for i in range(64)) + "same end" for turn in (0, 1))
    one, two = (next(rolling(np.frombuffer(t.encode(), np.uint8), 200))[1] for t in (a, b))
    assert a != b and one.tolist() == two.tolist()
    got = rows(suffix_dedup.remove_repeats(docs(spark, [a, b, a[:150], b[:150], "c" + a, "c" + a])))
    assert [got[i]["n_removed"] for i in range(6)] == [200, 0, 0, 0, 201, 201]
    got = rows(suffix_dedup.remove_repeats(docs(spark, [a, b, a[:150], b[:150]])))
    assert [got[i]["n_removed"] for i in range(4)] == [0, 0, 0, 0]


def test_suffix_dedup_empty_and_repeated_ids(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0
    got = suffix_dedup.remove_repeats(docs(spark, ["k" * 150, "m" * 250], [None, None])).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 250]


# ---------------------------------------------------------------- 9: decontamination

def test_leaks_are_found_within_the_edit_budget_and_clean_texts_are_not(spark):
    texts, rng, vocab = random_texts(3, 30, vocabulary=3000, size=120)
    item = " ".join(rng.choice(vocab) + rng.choice("klmnop") for _ in range(40))
    edited = list(item)
    for i in (20, 90, 150):
        edited[i] = "#"
    planted = {30: "pre " + item.upper() + " post", 31: "x  " + item.replace(" ", "  \n") + " y", 32: "".join(edited), 33: item[:110] + " and then"}
    texts += [planted[k] for k in sorted(planted)] + [None, "", item[:30]]
    bench = spark.createDataFrame([(5, item), (6, None), (7, ""), (None, "tiny")], "item_id long, text string")
    got = rows(decontaminate.contaminated_documents(docs(spark, texts), bench))
    assert {i for i, r in got.items() if r["contaminated"]} == set(planted)
    assert all(got[i]["item_ids"] == [5] for i in planted) and got[32]["least_edits"] >= 0
    s = got[30]["spans"][0]
    assert texts[30].encode()[s["span_start"]:s["span_end"]].decode().lower() in item.lower()
    assert decontaminate.contaminated_documents(docs(spark, []), bench).count() == 0
    assert not rows(decontaminate.contaminated_documents(docs(spark, texts[:2]), bench.limit(0)))[0]["contaminated"]


def test_passages_of_a_window_are_found_at_every_offset(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    item = " ".join(word() for _ in range(60))[:233].strip()
    starts = [s for s in range(len(item) - 100) if item[s] != " " != item[s + 99]]
    planted = [item[s:s + 100] for s in starts] + [item[6:144]]
    planted += [t[:30] + "#" + t[31:60] + t[61:] + item[s + 100:s + 101] for s, t in zip(starts, planted)]
    short = [item[s:s + 60] for s in (0, 30, 90)]
    around = [" ".join(word() for _ in range(20)) for _ in planted + short]
    texts = [f"{a} {t} {a}" for a, t in zip(around, planted + short)] + ["it is a Zq  7 here", "it is a zq 8 here"]
    bench = spark.createDataFrame([(1, item), (2, "zQ 7"), (3, "zq 7")], "item_id long, text string")
    got = rows(decontaminate.contaminated_documents(docs(spark, texts), bench))
    n = len(planted)
    assert [got[i]["item_ids"] for i in range(len(texts))] == [[1]] * n + [[]] * len(short) + [[2, 3], []]
    assert all(got[k]["n_spans"] == 1 and (got[k]["least_edits"] == 0) == (k <= len(starts)) for k in range(n))
    assert texts[n + 3].encode()[got[n + 3]["spans"][0]["span_start"]:got[n + 3]["spans"][0]["span_end"]] == b"Zq  7"


def test_banded_alignment_equals_full_edit_distance():
    rng = random.Random(4)
    for _ in range(200):
        w = bytes(rng.choice(b"ab c") for _ in range(rng.randint(5, 25)))
        region = bytearray(w)
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(region) + 1)
            if rng.random() < 0.5:
                region[k:k] = bytes([rng.choice(b"xyz")])
            elif len(region) > 1:
                del region[min(k, len(region) - 1)]
        region = bytes(rng.choice(b"pq") for _ in range(rng.randint(0, 4))) + bytes(region) + b"q" * rng.randint(0, 4)
        row = [0] * (len(region) + 1)
        for i, c in enumerate(w, 1):
            new = [i]
            for j, x in enumerate(region, 1):
                new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
            row = new
        best, budget = min(row), 4
        got = decontaminate._aligned(w, np.frombuffer(region, np.uint8), budget)
        assert (got[0] if got else None) == (best if best <= budget else None)


# ---------------------------------------------------------------- 5: I-Match

def test_edited_texts_and_equal_fingerprints(spark):
    texts, rng, _ = random_texts(5, 50)
    texts += [None, "", "é", "ab", texts[3]]
    ids = [i * 7 for i in range(len(texts))]
    order = list(zip(ids, texts))
    rng.shuffle(order)
    got = rows(imatch.edited_fingerprints(docs(spark, [t for _, t in order], [i for i, _ in order]), low=0.02, high=0.5))
    t = [x or "" for x in texts]
    for i, x in enumerate(t):
        h = len(x) // 2
        edited = x[:len(x) - h] + t[(i + 1) % len(t)][:h]
        r = got[ids[i]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) or edited != x
    assert got[ids[3]]["fingerprint"] == got[ids[-1]]["fingerprint"]
    assert imatch.edited_fingerprints(docs(spark, [])).count() == 0
    one = imatch.edited_fingerprints(docs(spark, ["abcd"], [None])).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_document_frequencies_equal_a_count(spark):
    texts, _, _ = random_texts(6, 80)
    n = collections.Counter(w for t in texts for w in set(words(t)))
    got = sorted(r["df"] for r in imatch.term_frequencies(docs(spark, texts)).collect())
    assert got == sorted(n.values())


def test_half_edited_texts_stay_nearer_than_the_next(spark):
    got = imatch.edited_fingerprints(spark.read.parquet(f"{SF}/documents.parquet"), low=0.01, high=0.2).toPandas()
    assert got.near_edited.mean() > 5 * got.near_next.mean() and (got.near_edited >= got.near_next).mean() > 0.9


# ---------------------------------------------------------------- 6 and 10: classifiers

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(8)
    score, bind = rng.normal(size=9), 0.7
    ranges = np.array([0, 4, 4, 5, 9])
    good, flip = quality_crf._marginals(score, bind, quality_crf._has_before(ranges, 9), ranges)
    for a, b in zip(ranges[:-1], ranges[1:]):
        weight, on, change = 0.0, np.zeros(b - a), np.zeros(b - a)
        for m in range(2 ** (b - a)):
            y = np.array([(m >> i) & 1 for i in range(b - a)])
            w = np.exp((score[a:b] * y).sum() - bind * (np.diff(y) != 0).sum())
            weight += w
            on += w * y
            change[1:] += w * (np.diff(y) != 0)
        if b > a:
            assert np.allclose(good[a:b], on / weight) and np.allclose(flip[a:b], change / weight)


@pytest.mark.parametrize("op, column, least", [(quality_crf.op6_quality_crf, "quality", 0.95), (toxicity.op10_toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, op, column, least):
    sf = "/root/testdata/sf0.1"
    got = op(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held[column] == held.predicted).mean() >= least
    modulus, rest = (4, 2) if column == "quality" else (5, 0)
    assert [zlib.crc32(str(i).encode()) % modulus == rest for i in got.doc_id] == got.held_out.tolist()


@pytest.mark.parametrize("scores, column", [(quality_crf.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_scores_of_odd_rows(spark, scores, column):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    table = docs(spark, ["good words here.", "#### $$$$ idiot", None, "", "x" * 50_000, "same", "same"], [0, 1, 2, None, 4, 5, 5])
    got = scores(table, labels).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got) and got[5]["score"] == got[6]["score"]
    assert got[2]["score"] == got[3]["score"]
    assert scores(docs(spark, []), labels).count() == 0
    assert {round(r["score"], 6) for r in scores(table, labels.limit(0)).collect()} <= {0.5, 0.02}


def test_label_model_trusts_accurate_voters():
    rng = np.random.default_rng(9)
    y = (rng.random(4000) < 0.2).astype(int)
    sure = np.where(rng.random(4000) < 0.95, y, 1 - y)
    noise = (rng.random((4000, 2)) < 0.3).astype(int)
    votes = np.column_stack([sure, sure, noise]).astype(np.int8)          # the second voter only echoes the first
    model = toxicity.LabelModel(votes, np.where(np.arange(4000) < 200, y, -1))
    assert (0, 1) in model.pairs
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.93


# ---------------------------------------------------------------- 7: WARC

def test_warc_round_trip(spark):
    html = ["<p>" + "é" * 60, None, "", "short", "short", "x\r\n\r\nWARC/1.1\r\n" * 20, "<p>" + "é" * 60, "<p>" + "é" * 60, "q" * 300_000]
    ids = [5, 1, 2, 3, 4, 6, 9, None, 8]
    pages = spark.createDataFrame([(i, f"http://a.example/{i}\n", h, "x") for i, h in zip(ids, html)] + [(5, None, html[0], "y")],
                                  "page_id long, url string, html string, digest string")
    got = sorted(((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["intact"])
                  for r in warc.archive_round_trip(pages).collect()))
    want = []
    for i, h in [*zip(ids, html), (5, html[0])]:
        raw = (h or "").encode()
        again = h == html[0] and i == 9
        want.append((i or -1, "revisit" if again else "response", 5 if again else None, len(raw), hashlib.sha256(raw).hexdigest(), True))
    assert got == sorted(want)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_members_stand_alone():
    import gzip
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(b), b) for b in (b"", b"abc", b"\r\n\r\n" * 5, b"z" * 3_000_000)]
    whole = gzip.compress(b"".join(records))
    back = list(warc.split_records(warc.inflate(whole)))
    assert back == records
    members = [warc.deflate(r) for r in records]
    assert [gzip.decompress(m) for m in members] == records
    assert list(warc.split_records(warc.inflate(b"".join(members)))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(iter([records[1][:-1]])))


# ---------------------------------------------------------------- 3: URLs

def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if c.isascii() else c for c in rest[1]), rest[2]


def test_url_parts_rules_and_verdicts(spark):
    urls = ["http://WWW.Example.ORG/es/1?x=/en/", "https://example.org/en/12", "https://example.org/en/21#a", "https://badexample.org/es/", "x://b.com/de/1",
            "x://com/fr/2", "x://com.net/fr/", "no scheme", None, "", "http://", "http://h?q", "a://b://c/d", "https://ÄB.com/de/", "http://q.net/" + "a" * 9000]
    pages = spark.createDataFrame([(i, u, "p", "h") for i, u in enumerate(urls)], "page_id long, url string, path string, host string")
    got = rows(url_filter.filter_urls(pages), "page_id")
    assert [(got[i]["host"], got[i]["path"]) for i in range(len(urls))] == [split_url(u) for u in urls]
    rule = {0: "example.org/es/", 1: "example.org/en/1", 2: "org/", 3: "org/", 4: "com/de/", 5: "com/fr/", 13: "com/de/"}
    assert {i: r["rule"] for i, r in got.items() if r["rule"]} == rule
    says = {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 13: "block"}
    assert all(got[i]["verdict"] == v for i, v in says.items()) and {r["verdict"] for r in got.values()} <= {"allow", "block"}
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_trees_learn_lexical_labels(spark):
    rng = random.Random(10)
    bad = [f"http://win-{rng.randint(1, 999)}-casino{rng.randint(1, 99)}.biz/{rng.randint(1, 10**9)}?a={i}&b=2&c=3" for i in range(300)]
    good = [f"https://{''.join(rng.choice('aeiou') for _ in range(6))}.edu/guide/page" for _ in range(300)]
    train = spark.createDataFrame([(u, 1) for u in bad[:200]] + [(u, 0) for u in good[:200]], "url string, label int")
    pages = spark.createDataFrame(list(enumerate(bad[200:] + good[200:])), "page_id long, url string")
    got = rows(url_filter.filter_urls(pages, labelled=train), "page_id")
    assert sum(got[i]["verdict"] == ("block" if i < 100 else "allow") for i in range(200)) >= 195


def test_all_labels_of_all_suffixes_count(spark):
    rng = random.Random(14)
    says = [rng.randint(0, 1) for _ in range(1500)]
    name = lambda i: f"site{i:04d}.net"
    train = spark.createDataFrame([(f"http://www.{name(i)}/{k}", label) for i, label in enumerate(says) for k in range(10, 20)], "url string, label int")
    _, table, prior = url_filter.fit_trees(train, limit=3000, trees=2)
    got = rows(table, "suffix")
    assert len(got) == 1500 and abs(prior - sum(says) / 1500) < 1e-9
    assert all(abs(got[name(i)]["suffix_seen"] - np.log1p(10)) < 1e-9 and abs(got[name(i)]["suffix_rate"] - (10 * y + 10 * prior) / 20) < 1e-9
               for i, y in enumerate(says))
    pages = spark.createDataFrame([(i, f"http://www.{name(i)}/77") for i in range(1500)], "page_id long, url string")
    got = rows(url_filter.filter_urls(pages, labelled=train), "page_id")
    assert all(got[i]["verdict"] == ("block" if y else "allow") for i, y in enumerate(says))


# ---------------------------------------------------------------- 1: licences

def test_licence_notices_and_ordinary_lines(spark):
    texts = ["All rights reserved.", "Some words\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.",
             "filler " * 70 + "Licensed under the Apache License, Version 2.0." + " other" * 90, "the work of the public in part", None, "",
             "This work is licensed under the GNU General Public License, version 3."]
    texts += [f"ordinary words number {i} about the license of a driver and rights" for i in range(40)]
    got = rows(license_scan.scan_licenses(docs(spark, texts)))
    assert [got[i]["family"] for i in range(8)] == ["proprietary", "mit", "cc-by-nc", "apache-2.0", None, None, None, "gpl"]
    assert all(got[i]["confirmed"] == (got[i]["family"] is not None) for i in range(8))
    assert not any(got[i]["confirmed"] for i in range(8, 48)) and got[1]["n_paragraphs"] == 3 and got[5]["n_paragraphs"] == 0


def test_notices_wrapped_over_lines_are_scored_whole(spark):
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
           "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"]
    mit = ["Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files (the \"Software\"), to deal"]
    texts = ["\n".join(gpl), "A first paragraph.\n\n" + "\r\n".join(f" * {x}" for x in bsd) + "\n *\n * Some rest.", "\n".join(f"# {x}" for x in mit),
             "one line\n\nReleased under the MIT License.\nLicensed under the MIT license.", gpl[0] + "\n\n" + "\n\n".join(f"words {i}" for i in range(9)) + "\n\n" + gpl[2]]
    texts += [f"ordinary words number {i} about\nthe license of a driver\nand rights" for i in range(40)]
    got = rows(license_scan.scan_licenses(docs(spark, texts)))
    assert [(got[i]["family"], got[i]["confirmed"]) for i in range(4)] == [("gpl", True), ("bsd", True), ("mit", True), ("mit", True)]
    assert min(got[i]["likeness"] for i in range(3)) > 0.9 and got[3]["n_licensed"] == 2 and got[3]["n_paragraphs"] == 3
    assert not any(got[i]["confirmed"] for i in range(4, 45))


# ---------------------------------------------------------------- 4: mixing, and the SQL checks

def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("web", "en", "a", 10), ("web", "en", "b", 1000), ("web", "de", "c", 1000), ("forum", "en", "d", 5000)],
                                   "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, (1, 10), 1, ({"web": 1, "forum": 1}, {}, {})).collect()}
    # 701 tokens: 350 each; web splits 175/175 between en and de; a holds only 10, b takes the rest of en
    assert got == {"a": 10, "b": 165, "c": 175, "d": 350}


@pytest.mark.parametrize("name", ["op4_mixing_weights", "op7_warc_normaliser"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, cur.fetchall()))


def test_mixing_of_odd_rows(spark):
    table = docs(spark, ["a b c", None, "", "d e", "d e"], [0, 1, None, 3, 3]).withColumn("lang", F.when(F.col("doc_id") == 0, None).otherwise(F.col("lang")))
    got = mixing.mix_counts(table, share=(1, 1)).collect()
    # 7 tokens: reference floor(7 * 3 / 5) = 4 (two epochs of its 2 tokens), web 2, of which en gets floor(2 * 6 / 7) = 1
    assert sorted((r["domain"], r["lang"], r["tokens"], r["epoch"]) for r in got if r["tokens"]) == [
        ("reference", "en", 2, 1), ("reference", "en", 2, 2), ("web", "en", 2, 1)]
    assert mixing.mix_counts(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- any order of the input, odd names

def _mixed_corpus(spark):
    notice = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    leak = "the quick brown fox jumps over the lazy dog while seventeen grey geese fly slowly south across the frozen lake at dawn again"
    texts = [f"plain words number {i} of an ordinary text" for i in range(40)] + [f"start {i}\n\n{notice}\n\nend" for i in range(6)]
    texts += [f"opening {i} {leak} closing {i}" for i in range(6)] + [None, "", texts[41], f"again {leak}"]
    ids = list(range(len(texts) - 2)) + [41, None]
    return docs(spark, texts, ids), spark.createDataFrame([("item-a", leak), (None, "tiny"), ("empty", None)], "item_id string, text string")


def test_results_belong_to_their_documents_in_any_order(spark):
    """Files, a repartitioned and a shuffled input give the same rows; item ids may be strings."""
    table, items = _mixed_corpus(spark)
    scanner = license_scan.fit_scanner(table.select(F.col("doc_id").alias("id"), F.monotonically_increasing_id().cast("string").alias("row"), "text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        orders = [table.coalesce(1), table.repartition(5), table.repartition(7, "text"), table.orderBy(F.desc("text"))]
        leaks = [sorted(map(repr, decontaminate.contaminated_documents(t, items).collect())) for t in orders]
        found = [sorted(map(repr, license_scan.scan_licenses(t, scanner=scanner).collect())) for t in orders]
        quality = [sorted(map(repr, near_join.near_duplicate_components(t).collect())) for t in orders]
        cut = [sorted(map(repr, suffix_dedup.remove_repeats(t, length=140).collect())) for t in orders]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for results in (leaks, found, quality, cut):
        assert all(r == results[0] for r in results)
    bad = [r for r in decontaminate.contaminated_documents(orders[1], items).collect() if r["contaminated"]]
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in bad) == [-1, 46, 47, 48, 49, 50, 51] and {tuple(r["item_ids"]) for r in bad} == {("item-a",)}
    licensed = [r["doc_id"] for r in license_scan.scan_licenses(orders[2], scanner=scanner).collect() if r["confirmed"]]
    assert sorted(licensed) == [40, 41, 41, 42, 43, 44, 45]


def test_dotted_names_and_label_tables_with_an_id(spark):
    texts, _, _ = random_texts(3, 30)
    table = docs(spark, texts).withColumn("a.b", F.lit(1)).withColumn("id", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2, i % 2, "clash", 5.0) for i in range(30)] + [(3, 0, 0, "clash", 5.0)], "doc_id long, quality int, toxic int, id string, `c.d` double")
    for scores in (quality_crf.quality_scores(table, labels), toxicity.toxicity_scores(table, labels)):
        assert scores.columns == [*table.columns, "score", "predicted"] and scores.count() == 30
    assert suffix_dedup.without_repeats(table).columns == table.columns


def test_licence_limits_are_calibrated_on_held_back_rows(spark):
    held = [("", [0.9, 0.1, 0.0]), ("", [0.3, 0.3, 0.4]), ("a", [0.1, 0.9, 0.0]), ("a", [0.3, 0.7, 0.0]), ("b", [0.65, 0.0, 0.35])]
    df = spark.createDataFrame(held, "family string, p array<double>")
    got = license_scan.calibrated(df, ["a", "b"])
    assert got["a"] == pytest.approx(0.5) and got["b"] == pytest.approx(0.5)                  # (0.3 + 0.7) / 2; overlap: 0.41, raised to 0.5
    moved = spark.createDataFrame([(f, [p[0], p[1] + (0.25 if f == "" else 0.05), p[2]]) for f, p in held], "family string, p array<double>")
    assert license_scan.calibrated(moved, ["a"])["a"] == pytest.approx((0.55 + 0.75) / 2)     # moves with the held-back rows
    assert license_scan.calibrated(df.where("family <> 'a'"), ["a"])["a"] == pytest.approx(0.5)


def test_toxic_recall_and_precision_on_held_out_rows(spark):
    """Held-out rows of the larger table; labels hold some noise, so a few toxic labels lie on ordinary text."""
    big = SF.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = toxicity.op10_toxicity(spark, big).filter("held_out").join(labels, "doc_id").filter("toxic is not null")
    n = got.agg(F.sum(F.expr("cast(toxic = 1 and predicted = 1 as int)")), F.sum("toxic"), F.sum("predicted")).first()
    assert n[0] >= 0.9 * n[1] and n[0] >= 0.95 * n[2]


def test_toxicity_learns_from_posteriors_and_from_unlabelled_rows():
    rng = random.Random(4)
    plain = [" ".join(rng.choice(["tree", "river", "stone", "cloud", "meadow", "lamp"]) for _ in range(40)) for _ in range(300)]
    nasty = [t + " you stupid worthless idiot " + rng.choice(["zug", "zog"]) for t in plain[:100]]
    texts = nasty + plain[100:]
    labels = [1] * 30 + [-1] * 70 + [0] * 60 + [-1] * 140
    labels[5] = 0                                                            # a wrong label does not become a target
    model = toxicity.fit_toxicity(texts, labels)
    import pyarrow as pa
    score = np.concatenate([model.scores(d, o) for _, _, d, o in toxicity.chunks(pa.array(texts, pa.large_string()))])
    assert (score[:100] >= 0.5).all() and (score[100:] < 0.5).all()
    assert (toxicity.fit_toxicity([], []).scores(*common_utf8(pa.array(["a"]))) < 0.1).all()
