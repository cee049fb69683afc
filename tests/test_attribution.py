"""Tree contributions: additivity and exact agreement with brute-force Shapley
values of the path-dependent (cover-weighted) value function."""
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from loanlens.operators import attribution as at


def _expvalue(tree, x, S, nid=0):
    n = tree[nid]
    if n["left"] < 0:
        return n["value"]
    f = n["feature"]
    if f in S:
        return _expvalue(tree, x, S, n["left"] if x[f] <= n["threshold"] else n["right"])
    l, r = tree[n["left"]], tree[n["right"]]
    return (l["cover"] * _expvalue(tree, x, S, n["left"]) + r["cover"] * _expvalue(tree, x, S, n["right"])) / n["cover"]


def _brute(trees, weights, x, m):
    phi = np.zeros(m)
    for tree, w in zip(trees, weights):
        for i in range(m):
            others = [j for j in range(m) if j != i]
            for k in range(m):
                for S in itertools.combinations(others, k):
                    c = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                    phi[i] += 2 * w * c * (_expvalue(tree, x, set(S) | {i}) - _expvalue(tree, x, set(S)))
    return phi


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(0)
    X = rng.integers(0, 6, size=(300, 4)).astype(float)
    y = ((X[:, 0] + X[:, 1] * X[:, 2] / 3 + rng.normal(0, 1, 300)) > 4).astype(int)
    df = spark.createDataFrame([(int(i), *map(float, X[i]), int(y[i])) for i in range(300)],
                               "k long, a double, b double, c double, d double, y int")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = GBTClassifier(labelCol="y", maxIter=6, maxDepth=3, seed=3).fit(df)
    return df, model


def test_contributions_add_up_to_log_odds(spark, fitted):
    df, model = fitted
    out = at.tree_contributions(model, df, keep=["k"]).join(
        model.transform(df).select("k", vector_to_array("probability")[1].alias("p")), "k").collect()
    for r in out:
        logit = math.log(r["p"] / (1 - r["p"]))
        assert r["base_value"] + sum(r["contributions"]) == pytest.approx(logit, abs=1e-9)
        assert r["margin"] == pytest.approx(logit, abs=1e-9)


def test_contributions_equal_brute_force_shapley(spark, fitted):
    df, model = fitted
    trees, weights = at.gbt_trees(model)
    rows = at.tree_contributions(model, df, keep=["k", "a", "b", "c", "d"]).orderBy("k").limit(15).collect()
    for r in rows:
        x = [r["a"], r["b"], r["c"], r["d"]]
        assert np.allclose(r["contributions"], _brute(trees, weights, x, 4), atol=1e-10)


def test_long_paths_use_no_pattern_table_and_still_add_up():
    rng = np.random.default_rng(5)
    for d in (3, 8, 10):
        shares, met = rng.uniform(0.1, 0.9, d), rng.integers(0, 2, (6, d)).astype(float)
        leaf = at.Leaf([], list(range(d)), shares, 1.7)
        phi = at.leaf_contributions(met, shares, 1.7)
        # known minus expected: the contributions add up to the leaf's value less its cover-weighted one
        assert np.allclose(phi.sum(axis=1), 1.7 * (met.prod(axis=1) - shares.prod()))
        table = at.pattern_table(leaf)
        if d <= at.PATTERN_TABLE_FEATURES:
            assert np.allclose(table[(met.astype(int) << np.arange(d)).sum(axis=1)], phi)
        else:
            assert table is None


def test_deep_model_adds_up_and_oversized_models_are_refused(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 12))
    y = (np.sin(X).sum(axis=1) > 0).astype(int)
    cols = [f"x{i}" for i in range(12)]
    df = spark.createDataFrame([(i, *map(float, X[i]), int(y[i])) for i in range(400)], ["k", *cols, "y"])
    df = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    model = GBTClassifier(labelCol="y", maxIter=3, maxDepth=10, seed=3).fit(df)
    for r in at.tree_contributions(model, df, keep=["k"]).limit(50).collect():
        assert r["base_value"] + sum(r["contributions"]) == pytest.approx(r["margin"], abs=1e-9)
    with pytest.raises(ValueError):
        at.tree_contributions(model, df, max_model_bytes=1000)


def test_importance_rank_is_zero_based_and_sorted(spark, fitted):
    df, model = fitted
    long = at.contributions_long(at.tree_contributions(model, df, keep=["k"]), ["a", "b", "c", "d"], ["k"])
    rank = at.feature_importance_rank(long).orderBy("rank").collect()
    assert [r["rank"] for r in rank] == [0, 1, 2, 3]
    imps = [r["importance"] for r in rank]
    assert imps == sorted(imps, reverse=True)


def test_top_and_tail_keeps_both_ends(spark):
    from loanlens.operators.attribution import top_and_tail
    ranking = spark.range(15).withColumnRenamed("id", "rank")
    assert top_and_tail(ranking, 10).count() == 20


def test_shadow_selection_keeps_a_planted_feature_and_refuses_too_few_rounds(spark):
    from loanlens.operators.attribution import shadow_feature_selection
    df = spark.range(600).selectExpr("id as k", "cast(id % 2 as double) as y", "cast(id % 2 as double) + 0.1 * rand(1) as signal", "rand(2) as noise")
    got = {r["feature"]: r for r in shadow_feature_selection(spark, df, ["signal", "noise"], "y", "k", iterations=10).collect()}
    assert got["signal"]["keep"] and not got["noise"]["keep"] and got["signal"]["rank"] == 1
    with pytest.raises(ValueError):
        shadow_feature_selection(spark, df, ["signal"], "y", "k", iterations=4)


def test_contribution_summary_by_equal_frequency(spark):
    rng = np.random.default_rng(7)
    x = np.where(rng.random(400) < 0.3, 5.0, rng.normal(size=400).round(2))          # a third of the rows share one value
    c = rng.normal(size=400)
    rows = [(i, float(a), None if i % 9 == 0 else float(i % 4)) for i, a in enumerate(x)]
    values = spark.createDataFrame(rows, "k long, `x.1` double, y double")
    long = spark.createDataFrame([(i, f, float(v) * (1 if f == "y" else 2)) for i, v in enumerate(c) for f in ("x.1", "y")], "k long, feature string, contribution double")
    got = {(r["feature"], r["bin"]): r for r in at.contribution_summary(values, long, ["k"], bins=10, probs=(0.1, 0.5, 0.9)).collect()}
    for f, col, scale in (("x.1", 1, 2), ("y", 2, 1)):
        have = [r[col] for r in rows if r[col] is not None]
        by = {}
        for r in rows:
            v = r[col]
            b = None if v is None else 10 * sum(o < v for o in have) // len(have)
            by.setdefault(b, []).append((v, c[r[0]] * scale))
        assert {b for g, b in got if g == f} == set(by)
        for b, held in by.items():
            r, contributions = got[f, b], np.array([h[1] for h in held])
            assert r["n"] == len(held) and r["mean_contribution"] == pytest.approx(contributions.mean())
            assert [r["q10"], r["q50"], r["q90"]] == pytest.approx(list(np.quantile(contributions, [0.1, 0.5, 0.9])))
            assert (r["value_min"], r["value_max"]) == ((None, None) if b is None else (min(h[0] for h in held), max(h[0] for h in held)))


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(600, 6))
    y = (X[:, 0] + 0.8 * X[:, 1] + rng.normal(0, 0.4, 600) > 0).astype(int)
    # f2 repeats the first column with noise: neither clearly above nor clearly below the best shuffled copy
    X[:, 2] = 0.12 * X[:, 0] + rng.normal(size=600)
    return spark.createDataFrame([(i, int(y[i]), *map(float, X[i])) for i in range(600)], "k long, y int, " + ", ".join(f"f{j} double" for j in range(6)))


def test_shadow_selection_confirms_rejects_and_leaves_open(spark, planted, monkeypatch):
    sizes, plain = [], at._shadow
    monkeypatch.setattr(at, "_shadow", lambda ranked, n, features, seed: sizes.append(len(features)) or plain(ranked, n, features, seed))
    imp = spark.createDataFrame([("f0", 0.9, 0), ("f1", 0.5, 1), ("gone", 0.1, 2)], "feature string, importance double, rank int")
    out = {r["feature"]: r for r in at.shadow_feature_selection(spark, planted, [f"f{j}" for j in range(6)], "y", "k", iterations=20, trees=20, importances=imp).collect()}
    assert out["f0"]["decision"] == out["f1"]["decision"] == "confirmed" and out["f0"]["keep"] and out["f0"]["rank"] == 1
    noise = [out[f"f{j}"] for j in (3, 4, 5)]
    assert sum(r["decision"] == "rejected" for r in noise) >= 2 and not any(r["keep"] for r in noise)
    assert all(r["rank"] >= 3 and r["p_reject"] <= 0.05 / 2 / 6 and r["trials"] < 20 for r in noise if r["decision"] == "rejected")
    assert sizes == sorted(sizes, reverse=True) and sizes[0] == 6 and sizes[-1] < 6            # rejected features leave the next rounds
    assert (out["f0"]["contribution_rank"], out["f3"]["contribution_rank"]) == (0, None) and out["gone"]["decision"] is None


def test_shadow_selection_names_undecided_features(spark, planted, monkeypatch):
    # importances that win every second iteration stay tentative
    turn = iter(range(100))

    class Fit:
        def __init__(self, n):
            self.n = n

        @property
        def featureImportances(self):
            k = next(turn)
            return type("V", (), {"toArray": lambda _: np.array([1.0, 0.3 + 0.4 * (k % 2)] + [0.5] * (self.n - 2))})()

    class Forest:
        def __init__(self, **_):
            pass

        def fit(self, data):
            return Fit(4)
    monkeypatch.setattr(at, "RandomForestClassifier", Forest)
    out = {r["feature"]: r for r in at.shadow_feature_selection(spark, planted, ["f0", "f1"], "y", "k", iterations=20).collect()}
    assert out["f0"]["decision"] == "confirmed"
    assert (out["f1"]["decision"], out["f1"]["rank"], out["f1"]["hits"], out["f1"]["trials"]) == ("tentative", 2, 10, 20)
    with pytest.raises(ValueError, match="cannot decide"):
        at.shadow_feature_selection(spark, planted, ["f0", "f1"], "y", "k", iterations=4)


def test_backward_selection_stops_early_and_drops_noise(spark, planted):
    from loanlens.modeling import training as tr
    out = at.backward_selection(spark, planted.where("k < 450"), planted.where("k >= 450"), [f"f{j}" for j in range(6)], "y", 2,
                                lambda: tr.boosted_tree_classifier(max_iter=60, step_size=0.3, max_depth=3), 2, patience=3).orderBy("round").collect()
    assert [r["n_features"] for r in out] == [6, 4, 2] and out[-1]["selected"].split(",") == ["f0", "f1"]
    assert all(r["trees"] < 57 and 0 < r["log_loss"] < 0.7 for r in out[:-1]) and out[-1]["trees"] is None


def test_shuffled_copies_are_the_permutations_of_their_ranks_in_any_blocks(spark, monkeypatch):
    n, feats = 101, ["a", "b.1", "c"]
    rows = [(r, r % 3, float(r), r * r, None if r % 10 == 0 else r + 0.5) for r in range(n)]
    ranked = spark.createDataFrame(rows, "_r long, y int, a double, `b.1` long, c double").repartition(5)
    values = {f: [row[2 + i] for row in rows] for i, f in enumerate(feats)}
    for block in (7, 1000):
        monkeypatch.setattr(at, "SHADOW_BLOCK_ROWS", block)
        out = at._shadow(ranked, n, feats, 3)
        assert out.columns == ["_r", "y", "a", "b.1", "c", "shadow_a", "shadow_b.1", "shadow_c"] and dict(out.dtypes)["y"] == "int"
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Join" not in plan          # no line per value, no join by rank
        got = {r["_r"]: r for r in out.collect()}
        assert sorted(got) == list(range(n))
        for f, (a, b) in zip(feats, at._shadow_moves(n, feats, 3)):
            for r in range(n):
                assert got[(r * a + b) % n][f"shadow_{f}"] == values[f][r]
        assert all(got[r]["y"] == r % 3 and got[r]["a"] == r and got[r]["b.1"] == r * r for r in range(n))
