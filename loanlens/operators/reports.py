"""Tables behind the reference's figures.

Drawing is not built; each function returns the numbers a chart shows.
Windows used here run over already-aggregated tables (one row per category
or bin), never over raw rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import exact_quantiles




def _count() -> Column:
    return F.count(F.lit(1))


def category_percent(df: DataFrame, col: str, order: Sequence | None = None) -> DataFrame:
    """``(col, n, pct)``: share of each non-missing category, in percent. With
    ``order`` only those categories are returned, in that order (shares stay
    relative to all non-missing rows)."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(_count().alias("n"))
    total = g.agg(F.sum("n")).first()[0] or 0        # one number, not a window over all categories
    out = g.withColumn("pct", F.col("n") * 100.0 / F.lit(total))
    if order is not None:
        pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col).cast(df.schema[col].dataType))
        out = out.where(pos > 0).orderBy(pos)
    return out


def auto_bins(df: DataFrame, col: str) -> int:
    """numpy's "auto" bin count: the narrower of the Sturges and
    Freedman-Diaconis widths (FD uses the exact interquartile range)."""
    x = F.col(col).cast("double")
    n, lo, hi = df.agg(F.count(x), F.min(x), F.max(x)).first()
    if not n or hi == lo:
        return 1
    qs = {r["p"]: r["q"] for r in exact_quantiles(df.select(x.alias("_x")), "_x", [0.25, 0.75]).collect()}
    width = (hi - lo) / (math.log2(n) + 1.0)
    iqr = qs[0.75] - qs[0.25]
    if iqr > 0:
        width = min(width, 2.0 * iqr * n ** (-1.0 / 3.0))
    return int(math.ceil((hi - lo) / width))


def histogram(df: DataFrame, col: str, bins: int | str = 10) -> DataFrame:
    """``(bin, bin_lo, bin_hi, n)`` over ``bins`` equal-width bins between the
    column's min and max (last bin closed), empty bins included; ``bins="auto"``
    picks the count like numpy. Min and max are two numbers fetched from one
    aggregate."""
    x = F.col(col).cast("double")
    if bins == "auto":
        bins = auto_bins(df, col)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    width = (hi - lo) / bins if hi > lo else 0.0
    if hi > lo:
        idx = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)), F.lit(bins - 1))
    else:
        idx = F.lit(0).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(idx.cast("int").alias("bin")).agg(_count().alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = grid.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                        F.when(F.col("bin") == bins - 1, F.lit(hi))
                        .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"))
    return edges.join(counts, on="bin", how="left").select("bin", "bin_lo", "bin_hi",
                                                           F.coalesce("n", F.lit(0)).alias("n"))


def class_density(df: DataFrame, value: str, label: str, grid_points: int = 200, cut: float = 3.0,
                  common_norm: bool = False) -> DataFrame:
    """Gaussian kernel density of ``value`` per class, each class normalised on
    its own, on a ``grid_points`` grid spanning min - cut*bw .. max + cut*bw.

    With ``common_norm`` each class curve is scaled by the class's share of
    rows instead, so the curves together integrate to one (the plotting
    library's default with a hue). Bandwidth is Scott's rule (n^-1/5 times the
    sample std). The kernel sum is exact: equal values are counted first, each
    distinct value adds its term to every grid point, and the terms are summed
    map-side, so the shuffle holds classes x grid rows per task.
    """
    x = F.col(value).cast("double")
    base = df.where(x.isNotNull() & F.col(label).isNotNull()).select(F.col(label).alias("cls"), x.alias("x"))
    st = base.groupBy("cls").agg(_count().alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                 F.stddev_samp("x").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    counted = base.groupBy("cls", F.col("x").alias("c")).agg(_count().alias("m"))
    terms = counted.join(st, on="cls").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
    point = (F.col("lo") - cut * F.col("bw") + F.col("g") * (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw"))
             / F.lit(float(grid_points - 1)))
    z = (point - F.col("c")) / F.col("bw")
    dens = (terms.groupBy("cls", "g", point.alias("x"), "n", "bw")
            .agg(F.sum(F.col("m") * F.exp(-0.5 * z * z)).alias("k")))
    density = F.col("k") / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    if common_norm:
        density = density * F.col("n") / F.sum("n").over(Window.partitionBy("g"))  # one row per class and point
    return dens.select(F.col("cls").alias(label), F.col("g").alias("point"), F.col("x").alias(value),
                       density.alias("density"))


def within_group_percent(df: DataFrame, x: str, hue: str) -> DataFrame:
    """``(x, hue, n, percent)``: share of each outcome inside each group, in
    percent; rows with a missing group or outcome are left out."""
    g = (df.where(F.col(x).isNotNull() & F.col(hue).isNotNull()).groupBy(x, hue).agg(_count().alias("n")))
    return g.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(x)))


def overall_positive_rate(df: DataFrame, hue: str, positive=1) -> DataFrame:
    """Reference line: percent of all rows whose outcome is ``positive``."""
    return df.agg((F.count_if(F.col(hue) == positive) * 100.0 / _count()).alias("positive_percent"))


def group_outcome_report(df: DataFrame, x: str, hue: str, positive=1) -> DataFrame:
    """Within-group outcome shares next to each group's share of the whole
    dataset and the overall positive rate."""
    within = within_group_percent(df, x, hue)
    share = category_percent(df, x).select(x, F.col("pct").alias("group_percent"))
    rate = overall_positive_rate(df, hue, positive).first()["positive_percent"]
    return within.join(share, on=x, how="left").withColumn("positive_percent", F.lit(rate))


def quantile_groups(df: DataFrame, col: str, labels: Sequence[str], out: str | None = None) -> DataFrame:
    """Equal-count groups by quantile edges (pandas ``qcut``): right-closed,
    lowest edge included, equal values never split, repeated edges an error.
    The q+1 exact edges are a small fitted parameter."""
    return quantile_groups_many(df, {col: (labels, out or f"{col}_group")})


def quantile_groups_many(df: DataFrame, specs: dict) -> DataFrame:
    """Several ``qcut`` columns at once, ``{col: (labels, out_name)}``: the
    edges of all columns come from one global ranking of (column, value)."""
    cols = list(specs)
    probs = sorted({i / len(specs[c][0]) for c in cols for i in range(len(specs[c][0]) + 1)})
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double")
                                                  .alias("x")) for c in cols])).alias("r")).select("r.*")
    got = exact_quantiles(long, "x", probs, groups=["column"]).collect()  # (columns x probs) rows
    new = {}
    for c in cols:
        labels, out = specs[c]
        q = len(labels)
        table = {r["p"]: r["q"] for r in got if r["column"] == c}
        e = [table[i / q] for i in range(q + 1)]
        if len(set(e)) != len(e):
            raise ValueError(f"quantile edges of {c} are not unique: {e}")
        x = F.col(f"`{c}`")
        expr = F.when(x.isNull(), F.lit(None).cast("string"))
        for i, lab in enumerate(labels):
            expr = expr.when((x <= F.lit(e[i + 1])) & (x >= F.lit(e[0])), F.lit(lab))
        new[out] = expr
    return df.withColumns(new)


def group_impact_report(rows: DataFrame, groupings: Sequence[str], outcomes: Sequence[str]) -> DataFrame:
    """Share of each outcome inside each group, for every (grouping, outcome)
    pair, in one pass: rows are unpivoted to (grouping, group, outcome_kind,
    outcome) and counted by one grouped aggregate; percentages come from a
    window over that small table."""
    cells = [F.struct(F.lit(g).alias("grouping"), F.col(f"`{g}`").cast("string").alias("group"),
                      F.lit(o).alias("outcome_kind"), F.col(f"`{o}`").cast("int").alias("outcome"))
             for g in groupings for o in outcomes]
    long = rows.select(F.explode(F.array(*cells)).alias("r")).select("r.*").where(
        F.col("group").isNotNull() & F.col("outcome").isNotNull())
    g = long.groupBy("grouping", "group", "outcome_kind", "outcome").agg(_count().alias("n"))
    w = Window.partitionBy("grouping", "group", "outcome_kind")
    return g.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(w))


def group_median(df: DataFrame, group: str, amount: str, name: str) -> DataFrame:
    """Exact median per group from global ranks: a group holding most rows is
    spread over many range partitions instead of one aggregation buffer."""
    return exact_quantiles(df, amount, [0.5], groups=[group]).select(group, F.col("q").alias(name))


def group_rate_and_median(df: DataFrame, group: str, label: str, amount: str) -> DataFrame:
    """Per group: mean label and exact median amount, ordered by the rate; rows
    without a group are left out."""
    df = df.where(F.col(group).isNotNull())
    rate = df.groupBy(group).agg(F.avg(label).alias(f"{label}_mean"))
    med = group_median(df, group, amount, f"{amount}_median")
    return rate.join(med, on=group, how="left").orderBy(f"{label}_mean", group)


def filter_groups_by_median(df: DataFrame, group: str, amount: str, value: float | None = None) -> DataFrame:
    """Rows of the groups whose median ``amount`` equals ``value``; by default
    the median shared by the most groups (ties: the smallest)."""
    med = group_median(df, group, amount, "_med")
    if value is None:
        pick = (med.groupBy("_med").agg(_count().alias("_k")).orderBy(F.desc("_k"), F.asc("_med")).limit(1))
    else:
        pick = med.sparkSession.createDataFrame([(float(value),)], "_med double")
    chosen = med.join(pick.select("_med"), on="_med", how="left_semi")
    return df.join(chosen.select(group), on=group, how="left_semi")


MAX_OUTCOMES = 1_000     # columns of the wide form; the long form has no bound


def crosstab_counts(df: DataFrame, x: str, y: str, y_values: Sequence | None = None) -> DataFrame:
    """Group x outcome count table; every outcome column present, 0 when empty.
    The wide form has a column per outcome; for outcomes without a bound use
    ``crosstab_long``, which no outcome name ever leaves the cluster for."""
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if y_values is None:  # the outcome values become columns, so their names are fetched, up to a bound
        y_values = sorted(r[0] for r in base.select(y).distinct().limit(MAX_OUTCOMES + 1).collect())
        if len(y_values) > MAX_OUTCOMES:
            raise ValueError(f"more than {MAX_OUTCOMES} outcomes: use crosstab_long")
    wide = base.groupBy(x).pivot(y, list(y_values)).agg(_count())
    return wide.fillna(0, subset=[str(v) for v in y_values])


def crosstab_long(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(x, y, n)``: one row per pair that occurs, whatever the number of outcomes."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(_count().alias("n"))


def grouped_describe(df: DataFrame, group: str, value: str) -> DataFrame:
    """pandas ``groupby().describe()``: count, mean, std, min, quartiles, max.
    Quartiles are exact and interpolated; rows without a group are left out."""
    base = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    stats = base.groupBy(group).agg(_count().alias("count"), F.avg(value).alias("mean"),
                                    F.stddev_samp(value).alias("std"), F.min(value).cast("double").alias("min"),
                                    F.max(value).cast("double").alias("max"))
    q = exact_quantiles(base, value, [0.25, 0.5, 0.75], groups=[group])
    qw = q.groupBy(group).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")).withColumnsRenamed(
        {"0.25": "q25", "0.5": "q50", "0.75": "q75"})
    return stats.join(qw, on=group, how="left")
