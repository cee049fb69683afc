"""Global ranks, running sums and exact quantiles against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators.ranking import exact_quantiles, running_sums, with_global_rank


def test_global_rank_is_a_permutation_in_order(spark):
    vals = [(i, (i * 37) % 101) for i in range(300)]
    df = spark.createDataFrame(vals, "k long, v long").repartition(7)
    rows = with_global_rank(df, [F.col("v"), F.col("k")]).collect()
    got = sorted((r["_rank"], r["v"], r["k"]) for r in rows)
    want = sorted((v, k) for k, v in vals)
    assert [g[0] for g in got] == list(range(300))
    assert [(g[1], g[2]) for g in got] == want


def test_running_sums_match_cumsum(spark):
    vals = [(float(i), i % 3) for i in range(200)]
    df = spark.createDataFrame(vals, "s double, w long").repartition(5)
    out = running_sums(df, [F.desc("s")], ["w"]).orderBy(F.desc("s")).collect()
    want = np.cumsum([w for _, w in sorted(vals, reverse=True)])
    assert [r["cum_w"] for r in out] == list(want)


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.25, 1 / 3, 0.75, 1.0]])
def test_exact_quantiles_match_numpy(spark, probs):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 3, 400)
    x = rng.normal(size=400).round(3)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g long, x double")
    out = exact_quantiles(df, "x", probs, groups=["g"]).collect()
    for r in out:
        want = np.quantile(x[g == r["g"]], r["p"])
        assert r["q"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).collect()[0]["q"] == 3.0


def test_hot_value_is_spread_over_range_partitions(spark):
    """One value holding a third of all rows must not land in a single task (the
    rows differ in another column; equal rows are counted before any sort).
    (AQE coalescing is switched off here: on tiny data it merges every range
    partition into one; at scale it only merges up to the advisory size.)"""
    from loanlens.operators.ranking import _sorted_checkpoint
    n = 6000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7.0))
                               .otherwise(F.col("id").cast("double")).alias("v"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        s = _sorted_checkpoint(df, [F.col("v")])
        sizes = [r["n"] for r in s.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = n // 3
    assert sum(sizes) == n
    assert max(sizes) < hot        # the 2000 rows with v = 7.0 are split across partitions
    q = exact_quantiles(df, "v", [0.5]).collect()[0]["q"]
    assert q == float(np.quantile(np.where(np.arange(n) % 3 == 0, 7.0, np.arange(n)), 0.5))


def test_quantiles_of_null_groups_and_heavy_ties(spark):
    rows = [("a", 1.0)] * 50 + [("a", 2.0)] + [(None, 3.0), (None, 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "x", [0.5, 1.0], groups=["g"]).collect()}
    assert got == {("a", 0.5): 1.0, ("a", 1.0): 2.0, (None, 0.5): 4.0, (None, 1.0): 5.0}
    assert exact_quantiles(df.where("x > 9"), "x", [0.5]).collect() == []


def test_quantiles_sort_counted_values_only(spark):
    """No raw row is sorted: the sorted table holds one row per distinct value."""
    from loanlens.operators import ranking
    seen = []
    plain = ranking._sorted_checkpoint
    ranking._sorted_checkpoint = lambda df, order: seen.append(df.count()) or plain(df, order)
    try:
        exact_quantiles(spark.range(5000).select((F.col("id") % 7).alias("v")), "v", [0.5]).collect()
    finally:
        ranking._sorted_checkpoint = plain
    assert seen == [7]


def test_group_with_a_third_of_the_values_is_not_joined_or_put_in_one_task(spark):
    """A hot group straddles many range partitions; its values meet no join on the group."""
    from loanlens.operators import ranking
    n = 9000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g.x"),
                               ((F.col("id") * 7919) % n / 3).alias("v")).unionByName(spark.createDataFrame([(None, 1.5), (None, 2.5)], "`g.x` string, v double"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        counts = df.groupBy(F.col("`g.x`"), F.col("v").alias("_v")).agg(F.count("*").alias("_n"))
        held = ranking._held_ranks(counts, ["g.x"])
        plan = held._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" in plan and "Join Inner" not in plan
        sizes = [r["n"] for r in ranking._sorted_checkpoint(counts, [F.col("`g.x`"), F.col("_v")]).where("`g.x` = 'hot'")
                 .groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 4 and max(sizes) < n // 6
        got = {(r["g.x"], r["p"]): r["q"] for r in exact_quantiles(df, "v", [0.0, 0.3, 0.5, 1.0], groups=["g.x"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    by = {}
    for r in df.collect():
        by.setdefault(r["g.x"], []).append(r["v"])
    assert got == {(g, p): pytest.approx(float(np.quantile(v, p))) for g, v in by.items() for p in (0.0, 0.3, 0.5, 1.0)}
