"""The pipeline stage by stage: columns, order, and each stage's decision against its operator's rule."""
import random
import re

import corpus_pipeline
from tests.conftest import SF


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    bench = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        seen[name] = {r["doc_id"]: r.asDict() for r in out.collect()}
        if name != "mixing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        docs = out
    judged = [i for i in seen["quality"] if i in labels]
    assert sum(labels[i] for i in judged) / len(judged) > 0.95
    assert set(seen["near_duplicates"]) <= set(seen["quality"])

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0d]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    sets = [shingles(r["text"]) for r in seen["near_duplicates"].values() if r["text"]]
    assert not any(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert set(seen["suffix_dedup"]) == set(seen["near_duplicates"])
    assert all(r["n_chars"] == len(r["text"]) for r in seen["suffix_dedup"].values())
    assert not any(b in " ".join(r["text"].lower().split()) for r in seen["decontamination"].values() for b in bench)
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and seen["mixing"]


def test_run_and_empty_input(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_null_and_shared_ids_lose_no_other_rows(spark):
    rng = random.Random(13)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    a, b, c, d, e = (text() for _ in range(5))
    table = [(None, a), (None, b), (7, c), (7, d), (8, d + " more"), (9, c), (9, e), (None, leak), (7, leak), (3, c), (None, None), (4, ""), (4, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in table], "doc_id long, text string, lang string, source string, n_chars long")
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF)
    want = [(None, a), (None, b), (7, d), (9, e), (3, c), (None, None), (4, ""), (7, leak)]
    assert pairs(kept) == sorted(want, key=repr)
    clean = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert pairs(clean) == sorted((x for x in table if x[1] != leak), key=repr)
    assert clean.columns == kept.columns == list(corpus_pipeline.COLUMNS)
