"""Chi-square test, splits and folds."""
import numpy as np
import math

import pytest
from pyspark.sql import functions as F

from loanlens.operators import reports as rp
from loanlens.operators import splits as sp
from loanlens.operators import stats as st
from loanlens.operators.relational import holdout_split


def test_chi2_sf_known_values():
    # dof 2: sf = exp(-x/2); dof 1 at 3.841458820694124 is 0.05
    assert st.chi2_sf(4.0, 2) == pytest.approx(math.exp(-2.0), rel=1e-12)
    assert st.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert st.chi2_sf(30.0, 10) == pytest.approx(0.0008566412, rel=1e-6)


def test_chi2_sf_closed_forms_odd_and_even():
    x = 7.3
    assert st.chi2_sf(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-12)
    assert st.chi2_sf(x, 3) == pytest.approx(math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2), rel=1e-12)
    assert st.chi2_sf(0.0, 5) == 1.0 and math.isnan(st.chi2_sf(1.0, 0))
    assert st.chi2_sf(5000.0, 5000) == pytest.approx(0.5, abs=0.01)


def test_chi2_statistic_by_hand(spark):
    # table [[10, 20], [30, 40]] with Yates correction (2x2)
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 40
    df = spark.createDataFrame(rows, "x string, y int")
    r = st.chi2_independence(df, "x", "y", y_values=[0, 1]).collect()[0]
    n, rows_, cols_ = 100, [30, 70], [40, 60]
    obs = [[10, 20], [30, 40]]
    chi2 = 0.0
    for i in range(2):
        for j in range(2):
            e = rows_[i] * cols_[j] / n
            d = e - obs[i][j]
            o = obs[i][j] + math.copysign(min(0.5, abs(d)), d)
            chi2 += (o - e) ** 2 / e
    assert r["dof"] == 1 and r["chi2"] == pytest.approx(chi2) and 0 < r["p"] < 1


def test_holdout_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    out = holdout_split(df, "k", 0.05)
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and 50 < counts["test"] < 150


def test_stratified_split_keeps_shares_exactly(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = sp.stratified_split(df, "y", "k", 0.2)
    c = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert c[(1, "test")] == 20 and c[(0, "test")] == 180 and out.count() == 1000


def test_stratified_folds_balanced(spark):
    df = spark.range(503).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    out = sp.stratified_folds(df, "y", "k", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in out if r["y"] == y]
        assert max(sizes) - min(sizes) <= 1


def test_qcut_ties_never_split(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3, 4, 5]], "x double")
    out = rp.quantile_groups(df, "x", ["L", "M", "H"], "g").collect()
    groups = {}
    for r in out:
        groups.setdefault(r["x"], set()).add(r["g"])
    assert all(len(s) == 1 for s in groups.values())


def test_qcut_equal_edges_raise(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 3, 4]], "x double")
    with pytest.raises(ValueError):
        rp.quantile_groups(df, "x", ["L", "M", "H"])


def test_within_group_percent_sums_to_100(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("b", 1), (None, 1), ("b", None)], "x string, y int")
    out = rp.within_group_percent(df, "x", "y").groupBy("x").agg(F.sum("percent").alias("s")).collect()
    assert sorted(r["x"] for r in out) == ["a", "b"]
    assert all(r["s"] == pytest.approx(100.0) for r in out)


def test_histogram_auto_bins_and_counts_match_numpy(spark):
    import numpy as np
    x = np.random.default_rng(4).gamma(2.0, 3.0, 700).round(2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    edges = np.histogram_bin_edges(x, bins="auto")
    assert rp.auto_bins(df, "x") == len(edges) - 1
    out = rp.histogram(df, "x", bins="auto").orderBy("bin").collect()
    counts, _ = np.histogram(x, bins=edges)
    assert [r["n"] for r in out] == list(counts)


def test_class_density_integrates_to_one_per_class(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    rows = [(0, float(v)) for v in rng.normal(0, 1, 400)] + [(1, float(v)) for v in rng.normal(2, 0.5, 100)]
    df = spark.createDataFrame(rows, "label int, score double")
    for common, want in [(False, {0: 1.0, 1: 1.0}), (True, {0: 0.8, 1: 0.2})]:
        pts = rp.class_density(df, "score", "label", common_norm=common).orderBy("label", "point").collect()
        for c in (0, 1):
            xs = np.array([r["score"] for r in pts if r["label"] == c])
            ys = np.array([r["density"] for r in pts if r["label"] == c])
            assert np.trapezoid(ys, xs) == pytest.approx(want[c], abs=0.02)


def test_sample_fraction_hash_and_fast(spark):
    from loanlens.operators.relational import sample_fraction
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = sample_fraction(df, 0.2, "k").count()
    assert a == sample_fraction(df, 0.2, "k").count() and 850 < a < 1150
    assert 850 < sample_fraction(df, 0.2, "k", fast=True).count() < 1150


def test_quantile_groups_sizes_differ_only_by_ties(spark):
    import numpy as np
    x = np.random.default_rng(8).integers(0, 10_000, 3000).astype(float)   # few ties
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    sizes = [r["count"] for r in rp.quantile_groups(df, "x", ["L", "M", "H"], "g").groupBy("g").count().collect()]
    ties = len(x) - len(set(x))
    assert max(sizes) - min(sizes) <= 2 + ties


def test_category_percent_order(spark):
    df = spark.createDataFrame([(s,) for s in "CCXX0011X"] + [(None,)], "s string")
    out = rp.category_percent(df, "s", order=["X", "C", "5"]).collect()
    assert [r["s"] for r in out] == ["X", "C"]
    assert out[0]["pct"] == pytest.approx(300 / 9) and out[1]["pct"] == pytest.approx(200 / 9)


def test_density_is_the_exact_kernel_sum(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=300), 2)
    y = rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "score double, label int")
    for r in rp.class_density(df, "score", "label").collect()[::37]:
        v = x[y == r["label"]]
        bw = v.std(ddof=1) * len(v) ** -0.2
        want = np.exp(-0.5 * ((r["score"] - v) / bw) ** 2).sum() / (len(v) * bw * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(want, rel=1e-9)


def test_rows_without_a_group_are_left_out_and_wide_outcomes_are_counted(spark):
    df = spark.createDataFrame([("a", 1, 2.0), (None, 0, 3.0), ("a", 0, 4.0)], "g string, y int, x double")
    assert [r["g"] for r in rp.group_rate_and_median(df, "g", "y", "x").collect()] == ["a"]
    assert [(r["g"], r["q50"]) for r in rp.grouped_describe(df, "g", "x").collect()] == [("a", 3.0)]
    many = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("y"))
    assert rp.crosstab_long(many, "g", "y").count() == 200_000


def test_hot_parent_key_is_split_and_repeated_parents_do_not_multiply(spark):
    from loanlens.operators import relational as rel
    app = spark.range(50).select(F.col("id").alias("SK_ID_CURR"))
    kids = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 80).alias("SK_ID_CURR"), F.col("id").alias("k"))
    a = rel.holdout_split(app, "SK_ID_CURR", 0.3)
    own = rel.split_by_own_key(kids, a, "SK_ID_CURR", 0.3)
    via = rel.propagate_split(kids, a.union(a), "SK_ID_CURR")
    want = {(r["k"], r["split"]) for r in kids.join(a, "SK_ID_CURR").collect()}
    assert {(r["k"], r["split"]) for r in own.collect()} == want == {(r["k"], r["split"]) for r in via.select("k", "split").collect()}
    assert via.count() == own.count() == len(want)


def _brute_positions(rows, seed):
    import hashlib
    by = {}
    for k, y in rows:
        if k is not None:
            by.setdefault(y, []).append((int(hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], 16), k))
    return {(y, k): (i, len(v)) for y, v in by.items() for i, (_, k) in enumerate(sorted(v))}


@pytest.mark.parametrize("bits, cell_rows, cut_rows", [(12, 100_000, 100_000), (3, 2, 100_000), (12, 0, 0), (5, 10, 1)])
def test_splits_by_histogram_refinement_equal_sorting(spark, monkeypatch, bits, cell_rows, cut_rows):
    # few bits a level force many refinements, no fetched cuts force the joined form
    monkeypatch.setattr(sp, "LEVEL_BITS", bits)
    monkeypatch.setattr(sp, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(sp, "CUT_ROWS", cut_rows)
    rows = [(i, None if i % 11 == 0 else "a" if i % 3 else f"rare{i % 7}") for i in range(600)] + [(None, "a"), (None, None), (9000, "single")]
    df = spark.createDataFrame(rows, "k long, `y.z` string")
    at = _brute_positions(rows, 3)
    for share in (0.0, 0.2, 0.5, 1.0):
        got = sp.stratified_split(df, "y.z", "k", share, 3).collect()
        assert len(got) == len(rows)
        for r in got:
            i, n = at.get((r["y.z"], r["k"]), (1, 0))
            assert r["split"] == ("test" if i < math.floor(n * share + 0.5) else "train")
    for k in (1, 5, 8):
        for r in sp.stratified_folds(df, "y.z", "k", k, 3).collect():
            i, n = at.get((r["y.z"], r["k"]), (0, 1))
            assert r["fold"] == i * k // n


def test_splits_of_many_labels_stay_on_the_cluster(spark):
    df = spark.range(600_000).select(F.col("id").alias("k"), (F.col("id") % 200_000).alias("y"))
    out = sp.stratified_split(df, "y", "k", 0.34, 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (y" not in plan and "BroadcastHint" not in plan and "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    sizes = out.groupBy("y").agg(F.sum((F.col("split") == "test").cast("int")).alias("t"), F.count("*").alias("n")).groupBy("t", "n").count().collect()
    assert [(r["t"], r["n"], r["count"]) for r in sizes] == [(1, 3, 200_000)]
    folds = sp.stratified_folds(df, "y", "k", 3, 1).groupBy("fold").count().collect()
    assert sorted((r["fold"], r["count"]) for r in folds) == [(0, 200_000), (1, 200_000), (2, 200_000)]


def test_splits_of_empty_tables(spark):
    df = spark.createDataFrame([], "k long, y int")
    assert sp.stratified_split(df, "y", "k").count() == 0 and sp.stratified_folds(df, "y", "k").columns == ["k", "y", "fold"]


def test_chi2_from_present_cells_equals_the_dense_table(spark):
    rng = np.random.default_rng(9)
    rows = [(f"g{int(a)}", int(b)) for a, b in zip(rng.integers(0, 9, 900) ** 2 // 9, rng.integers(0, 6, 900) ** 2 // 6)] + [(None, 1), ("g0", None), ("lone", 3)]
    df = spark.createDataFrame(rows, "x string, y int")
    full = [(a, b) for a, b in rows if a is not None and b is not None]
    xs, ys = sorted({a for a, _ in full}), sorted({b for _, b in full})
    o = np.array([[sum(1 for r in full if r == (a, b)) for b in ys] for a in xs], float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    got = st.chi2_independence(df, "x", "y").first()
    assert got["chi2"] == pytest.approx(((o - e) ** 2 / e).sum()) and got["dof"] == (len(xs) - 1) * (len(ys) - 1) and got["n_cells"] == o.size
    assert (o == 0).any()
    long = st.chi2_expected_counts(df, "x", "y").collect()
    assert len(long) == int((o > 0).sum()) and all(r["share_expected_ge5"] == pytest.approx((e >= 5).mean()) for r in long)
    dense = st.chi2_expected_counts(df, "x", "y", y_values=ys).collect()
    assert len(dense) == o.size and all(r["share_expected_ge5"] == pytest.approx((e >= 5).mean()) for r in dense)
    cell = {(r["x"], r["y"]): (r["observed"], r["expected"]) for r in dense}
    assert all(cell[a, str(b)] == (o[i, j], pytest.approx(e[i, j])) for i, a in enumerate(xs) for j, b in enumerate(ys))
    assert st.chi2_independence(df.where("x = 'none'"), "x", "y").collect() == []


def test_chi2_of_many_outcomes_fetches_no_name(spark):
    df = spark.range(600_000).select((F.col("id") % 3).alias("x"), (F.col("id") % 200_000).alias("y"))
    got = st.chi2_independence(df, "x", "y").first()
    # 200,000 outcomes of 3 rows each; ids differ by 200,000, which is 2 modulo 3, so every row lies in another group: 3 cells of 1
    assert got["chi2"] == pytest.approx(0.0, abs=1e-3) and got["dof"] == 2 * 199_999 and got["n_cells"] == 600_000
    assert st.chi2_expected_counts(df, "x", "y").first()["share_expected_ge5"] == 0.0
    with pytest.raises(ValueError, match="crosstab_long"):
        rp.crosstab_counts(df, "x", "y")
