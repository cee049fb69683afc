"""Global ranks, running sums and exact quantiles without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` pulls every row into one
task. Instead the rows are range-partitioned by the sort key (``orderBy``),
each row gets its partition index and position from
``monotonically_increasing_id`` (partition index in the upper bits), the
per-partition totals (one row per partition, a bounded table) give prefix
offsets, and the offsets are broadcast back. The sorted table is checkpointed
to the reliable checkpoint folder first so both uses see the same partitions.
Quantiles sort counted values, never raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def _sorted_checkpoint(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partitioned sort + position id, written to the reliable checkpoint.
    A hash of the whole row is the last sort key, so the range partitioner can
    split a run of equal keys over many partitions, and a retried task draws
    the same order again: rows equal in every column are interchangeable and
    stay together. Callers whose rows repeat count them first."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = (df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).orderBy(*order, F.col("_tie"))
              .withColumn("_mid", F.monotonically_increasing_id()).drop("_tie"))
    return ranked.checkpoint(eager=True)


def with_global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "_rank") -> DataFrame:
    """Add a 0-based global position in ``order`` (ties in arbitrary order)."""
    s = _sorted_checkpoint(df, order)
    pid = F.shiftright(F.col("_mid"), 33)
    counts = s.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(rank_col, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
            .drop("_pid", "_off", "_mid"))


def _part_offsets(s: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per range partition the totals ``_t_<col>`` and the sums ``_o_<col>`` of all earlier ones (one row per partition)."""
    totals = s.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"_o_{c}": F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)) for c in cols})


def running_sums(df: DataFrame, order: Sequence[Column], cols: Sequence[str],
                 prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order``. Each range partition is
    summed locally (a window keyed by partition index, so a partition stays in
    its own task), then shifted by the totals of all earlier partitions."""
    s = _sorted_checkpoint(df, order)
    s = s.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    offsets = _part_offsets(s, cols)
    local = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(offsets), on="_pid")
    out = out.withColumns({f"{prefix}{c}": F.col(f"_o_{c}") + F.sum(c).over(local) for c in cols})
    return out.drop("_pid", "_mid", *[f"_{x}_{c}" for c in cols for x in "ot"])


def _same(groups: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"{prefix}{i}"))
    return same


def _held_ranks(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Counted values (groups, ``_v``, ``_n``) plus the ranks inside their group that each holds: from ``_from`` (counted
    from 0) to ``_to`` (exclusive), and the group's ``_size``.

    After the range-partitioned sort nearly every group lies in one partition, where local windows give its ranks. At
    most one group a partition border straddles it, a hot one over many partitions: their pieces are put together by a
    table of at most one row per border, which is broadcast. No value is joined with its group.
    """
    quoted = [F.col(f"`{g}`") for g in groups]
    s = _sorted_checkpoint(counts, [g.asc_nulls_first() for g in quoted] + [F.col("_v")])
    s = s.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    ends = s.groupBy("_pid").agg(F.min("_mid").alias("_first"), F.max("_mid").alias("_last"))
    ends = ends.select(F.explode(F.array("_first", "_last")).alias("_mid")).distinct()           # two rows a partition
    edge = s.join(F.broadcast(ends), "_mid", "left_semi").select(
        F.col("_pid").alias("_epid"), *[F.col(f"`{g}`").alias(f"_e{i}") for i, g in enumerate(groups)])
    pieces = s.join(F.broadcast(edge), (F.col("_pid") == F.col("_epid")) & _same(groups, "_e"), "left_semi").groupBy(
        "_pid", *quoted).agg(F.sum("_n").alias("_piece"))
    before = Window.partitionBy(*quoted).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*quoted)
    crossing = pieces.withColumns({"_done": F.coalesce(F.sum("_piece").over(before), F.lit(0)), "_all": F.sum("_piece").over(whole),
                                   "_k": F.count(F.lit(1)).over(whole)}).where("_k > 1")
    crossing = crossing.select(F.col("_pid").alias("_cpid"), *[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(groups)], "_done", "_all")
    piece = Window.partitionBy("_pid", *quoted)
    local = piece.orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    held = s.withColumns({"_to": F.sum("_n").over(local), "_size": F.sum("_n").over(piece)})
    held = held.join(F.broadcast(crossing), (F.col("_pid") == F.col("_cpid")) & _same(groups, "_g"), "left")
    held = held.withColumns({"_to": F.col("_to") + F.coalesce("_done", F.lit(0)), "_size": F.coalesce("_all", "_size")})
    return held.select(*quoted, "_v", (F.col("_to") - F.col("_n")).alias("_from"), "_to", "_size")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    groups: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles (pandas/numpy "linear") of
    ``value`` per group, NULLs ignored. Output: ``groups..., p, q``.

    Rows are first counted by (groups, value), combined map-side, so no raw
    row is sorted.
    """
    quoted = [F.col(f"`{g}`") for g in groups]
    base = df.select(*quoted, F.col(f"`{value}`").alias("_v")).where(F.col("_v").isNotNull())
    return quantiles_of_counts(base.groupBy(*quoted, "_v").agg(F.count(F.lit(1)).alias("_n")), probs, groups)


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` of counted values (groups, ``_v``, ``_n``), one row each.

    Running counts over the distinct values give each value the interval of
    ranks it holds; a value is an order statistic around ``p * (n - 1)`` when
    that rank lies in its interval.
    """
    quoted = [F.col(f"`{g}`") for g in groups]
    if groups:
        held = _held_ranks(counts, groups)
    else:
        held = running_sums(counts, [F.col("_v")], ["_n"], prefix="_to")
        size = held.agg(F.sum("_n")).first()[0]     # one number
        held = held.select("_v", (F.col("_to_n") - F.col("_n")).alias("_from"), F.col("_to_n").alias("_to"), F.lit(size).alias("_size"))

    def at(p, side):
        rank = side(p * (F.col("_size") - 1))
        return (F.col("_from") <= rank) & (rank < F.col("_to"))
    wanted = F.filter(F.array(*[F.lit(float(p)) for p in probs]), lambda p: at(p, F.floor) | at(p, F.ceil))
    pos = F.col("p") * (F.col("_size") - 1)
    out = held.withColumn("p", F.explode(wanted)).groupBy(*quoted, "p").agg(
        F.max(F.when(at(F.col("p"), F.floor), F.col("_v"))).alias("_vlo"),
        F.max(F.when(at(F.col("p"), F.ceil), F.col("_v"))).alias("_vhi"),
        F.max(pos - F.floor(pos)).alias("_frac"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return out.select(*quoted, "p", q.cast("double").alias("q"))
