"""Data-quality reports. Each is one or two aggregations; wide
per-column statistics are computed in a single pass and unpivoted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranking import quantiles_of_counts

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def _is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def duplicate_row_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(is_dup, n)``: rows equal on all (or ``cols``) columns to an earlier
    row count as duplicates; NULLs compare equal. Grouping on all columns is
    a partial+final aggregation, so a heavily repeated row combines map-side."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    tot = g.agg(F.count(F.lit(1)).alias("first"), F.sum(F.col("_c") - 1).alias("dups"))
    out = tot.select(F.explode(F.array(
        F.struct(F.lit(False).alias("is_dup"), F.col("first").alias("n")),
        F.struct(F.lit(True).alias("is_dup"), F.col("dups").alias("n")))).alias("r")).select("r.*")
    return out.where(F.col("n") > 0)


def key_null_counts(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """``(table, nulls, ok)`` per table for one key column."""
    parts = [df.agg((F.count(F.lit(1)) - F.count(key)).alias("nulls")).select(F.lit(name).alias("table"), "nulls")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("nulls") == 0)


def superset_check(sup: DataFrame, sub: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(is_superset, missing)``: rows of ``sub`` whose ``cols`` values have no
    match in ``sup`` (compared by value, not by row position)."""
    keys = sup.select(*cols).distinct()
    missing = sub.select(*cols).join(keys, on=list(cols), how="left_anti")
    return missing.agg(F.count(F.lit(1)).alias("missing")).select(
        (F.col("missing") == 0).alias("is_superset"), "missing")


def null_proportions(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_share, filled_share)`` in one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "null_share")
    return long.withColumn("filled_share", 1 - F.col("null_share"))


def sentinel_audit(df: DataFrame, col: str, sentinel) -> DataFrame:
    """Of the positive values of ``col``: how many equal the sentinel."""
    c = F.col(col)
    return (df.where(c > 0).groupBy((c == F.lit(sentinel)).alias("is_sentinel"))
            .agg(F.count(F.lit(1)).alias("n")))


def table_shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows",
                                                            F.lit(len(df.columns)).alias("cols"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_profile(df: DataFrame, cols: Sequence[str] | None = None, quantiles: bool = True) -> DataFrame:
    """Per column: rows, missing, distinct, zeros, min/max/mean/std, exact
    quartiles and the most frequent value of text/integer columns (ties: the
    smallest). Two passes over the rows whatever the column count: one aggregate
    for the counters, one grouped count over (column, value) pairs, which gives
    distinct counts, modes and, ranked, the quartiles."""
    types = dict(df.dtypes)
    cols = list(cols or df.columns)
    num = [c for c in cols if _is_numeric(types[c])]
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`")
        aggs += [F.count(F.lit(1)).alias(f"{c}|rows"), (F.count(F.lit(1)) - F.count(x)).alias(f"{c}|missing")]
        if c in num:
            xd = x.cast("double")
            aggs += [F.count_if(xd == 0).alias(f"{c}|zeros"), F.min(xd).alias(f"{c}|min"),
                     F.max(xd).alias(f"{c}|max"), F.avg(xd).alias(f"{c}|mean"),
                     F.stddev_samp(xd).alias(f"{c}|std")]
    wide = df.agg(*aggs)
    fields = ["rows", "missing", "zeros", "min", "max", "mean", "std"]
    rows = []
    for c in cols:
        vals = [F.col(f"`{c}|{f}`") if f"{c}|{f}" in wide.columns else F.lit(None) for f in fields]
        rows.append(F.struct(F.lit(c).alias("column"),
                             *[v.cast("bigint" if f in ("rows", "missing", "zeros") else "double").alias(f)
                               for f, v in zip(fields, vals)]))
    prof = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    def both(c):  # distinct-preserving text and, for numbers, the value; x + 0.0 folds -0.0 into 0.0 like numeric grouping
        x = F.col(f"`{c}`")
        xd = x.cast("double") + F.lit(0.0) if c in num else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("column"), (xd if types[c] in ("double", "float") else x).cast("string").alias("v"), xd.alias("x"))
    discrete = {c for c in cols if types[c] not in ("double", "float")}
    long = df.select(F.explode(F.array(*[both(c) for c in cols])).alias("r")).select("r.*").where(F.col("v").isNotNull())
    # the cells are exploded and counted once; distinct counts, modes and quartiles read the written counts
    ensure_checkpoint_dir(df.sparkSession)
    freq = long.groupBy("column", "v", "x").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    per_col = freq.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    # mode without a window per column (a column may have billions of distinct
    # values): highest count per column, then the smallest value at that count;
    # the per-column maxima (one row per column) are broadcast
    dfreq = freq.where(F.col("column").isin(list(discrete)))
    best = dfreq.groupBy("column").agg(F.max("n").alias("top_freq"))
    top = (dfreq.join(F.broadcast(best), on="column").where(F.col("n") == F.col("top_freq"))
           .groupBy("column", "top_freq").agg(F.min("v").alias("top")))
    prof = (prof.join(per_col.select("column", "distinct"), on="column", how="left")
            .join(top, on="column", how="left"))
    if quantiles and num:
        counts = freq.where(F.col("x").isNotNull()).select("column", F.col("x").alias("_v"), F.col("n").alias("_n"))
        q = quantiles_of_counts(counts, [0.25, 0.5, 0.75], groups=["column"])
        qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(name) for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
        prof = prof.join(qw, on="column", how="left")
    return prof


def target_rate_by_column(df: DataFrame, label: str, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Label rate per category (text columns) or per equal-width bin (numeric
    columns), for all columns at once: unpivot to (column, bucket) and one
    grouped aggregate."""
    types = dict(df.dtypes)
    num = [c for c in cols if _is_numeric(types[c])]
    stats = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}|lo") for c in num],
                   *[F.max(F.col(c).cast("double")).alias(f"{c}|hi") for c in num]).collect()[0] if num else None
    buckets = []
    for c in cols:
        x = F.col(f"`{c}`")
        if c in num:
            lo, hi = stats[f"{c}|lo"], stats[f"{c}|hi"]
            if lo is None:
                b = F.lit(None).cast("string")
            elif hi == lo:
                b = F.lit("0")
            else:
                idx = F.least(F.floor((x.cast("double") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)),
                              F.lit(bins - 1))
                b = F.when(x.isNotNull(), idx.cast("string"))
        else:
            b = x.cast("string")
        buckets.append(F.struct(F.lit(c).alias("column"), b.alias("bucket")))
    long = df.select(F.col(label).alias("_y"), F.explode(F.array(*buckets)).alias("r")).select("r.*", "_y")
    return long.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("rate"))


def categorical_association(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uncertainty coefficient U(a|b) = (H(a) - H(a|b)) / H(a) for every ordered
    pair of text columns, NULL being a category. One scan: rows are unpivoted
    to (unordered pair, x, y) and counted by one grouped aggregate, which gives
    both directions; the margins are aggregates of that joint table joined back
    on (pair, x) and (pair, y), so no task ever holds a whole pair's table."""
    def txt(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<null>"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    pair = ["column_a", "column_b"]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                                                  txt(a).alias("x"), txt(b).alias("y")) for a, b in pairs]))
                     .alias("r")).select("r.*")
    joint = long.groupBy(*pair, "x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    joint = joint.unionByName(joint.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"),
                                           F.col("y").alias("x"), F.col("x").alias("y"), "n"))
    total = joint.groupBy(*pair).agg(F.sum("n").alias("total"))          # one row per pair
    nx = joint.groupBy(*pair, "x").agg(F.sum("n").alias("nx"))
    ny = joint.groupBy(*pair, "y").agg(F.sum("n").alias("ny"))
    j = joint.join(nx, on=pair + ["x"]).join(ny, on=pair + ["y"]).join(F.broadcast(total), on=pair)
    p = F.col("n") / F.col("total")
    ent = j.groupBy(*pair).agg((-F.sum(p * F.log(F.col("nx") / F.col("total")))).alias("hx"),
                               (-F.sum(p * F.log(F.col("n") / F.col("ny")))).alias("hxy"))
    return ent.select(*pair, F.when(F.col("hx") > 0, (F.col("hx") - F.col("hxy")) / F.col("hx"))
                      .otherwise(F.lit(1.0)).alias("uncertainty_coefficient"))


def numeric_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every pair (a < b) in one aggregate pass
    (pairwise complete rows per pair, as pandas ``corr``)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = []
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs.append(F.corr(F.when(both, F.col(a)), F.when(both, F.col(b))).alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{a}|{b}`").alias("corr"))
            for a, b in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
