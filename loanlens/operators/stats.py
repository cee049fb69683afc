"""Chi-square test of independence.

Observed counts come from one grouped count of the cells that occur; nothing
is pivoted and no category or outcome name leaves the cluster. The statistic
needs only those cells: empty ones add their expected count, and all expected
counts add up to the number of rows. The share of cells with enough expected
rows follows from the two histograms of the margins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranking import running_sums
from .reports import crosstab_long

ENOUGH = 5       # expected rows of a cell that the rule of thumb asks for


def chi2_sf(stat: float, dof: float) -> float:
    """Survival function of the chi-square distribution with whole degrees of
    freedom, in closed form: a Poisson sum for an even number; for an odd one
    the normal tail (``erfc``) plus the same sum over half-integers."""
    if stat is None or dof is None or dof <= 0:
        return float("nan")
    h = stat / 2.0
    if h <= 0:
        return 1.0
    odd = int(dof) % 2 == 1
    tail = math.erfc(math.sqrt(h)) if odd else 0.0
    first = 0.5 if odd else 0.0
    steps = (first + k for k in range(int(dof) // 2))
    return min(1.0, tail + math.fsum(math.exp(a * math.log(h) - h - math.lgamma(a + 1)) for a in steps))



def _cells_and_margins(df: DataFrame, x: str, y: str, y_values: Sequence | None) -> tuple[DataFrame, DataFrame, DataFrame, tuple]:
    """(cells that occur ``x, y, observed``, margins ``x, _rs`` and ``y, _cs``, (rows, categories, outcomes)).

    The three tables are written (reliable checkpoints), so they are counted
    once and joins with them have bare shuffles on both sides, which AQE can
    split at a hot category. Rows without a category or outcome are left out,
    and so are outcomes outside ``y_values`` where it is given.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if y_values is not None:
        df = df.where(F.col(y).isin(list(y_values)))
    cells = crosstab_long(df, x, y).withColumnRenamed("n", "observed").checkpoint()
    rows = cells.groupBy(x).agg(F.sum("observed").alias("_rs")).checkpoint()
    cols = cells.groupBy(y).agg(F.sum("observed").alias("_cs")).checkpoint()
    total, r = rows.agg(F.sum("_rs"), F.count(F.lit(1))).first()
    return cells, rows, cols, (total or 0, r, cols.count())


def _expected(total: int):
    return F.col("_rs").cast("double") * F.col("_cs") / F.lit(total)


def share_of_expected(rows: DataFrame, cols: DataFrame, shape: tuple, least: int = ENOUGH) -> float | None:
    """Share of all cells (empty ones too) whose expected count reaches ``least``, from the margins' histograms.

    A category with r rows has enough expected rows in the outcomes of at least
    ``least * total / r`` rows: both histograms are put in one order and summed
    from the top, so no pair of margins is formed.
    """
    total, r, c = shape
    if not total:
        return None
    held = cols.groupBy("_cs").agg(F.count(F.lit(1)).alias("n")).select(F.col("_cs").alias("at"), F.lit(0).alias("asks"), "n", F.lit(0).alias("k"))
    asks = rows.groupBy("_rs").agg(F.count(F.lit(1)).alias("k")).select(
        F.expr(f"({least} * {total} + _rs - 1) div _rs").alias("at"), F.lit(1).alias("asks"), F.lit(0).alias("n"), "k")
    down = running_sums(held.unionByName(asks), [F.desc("at"), F.col("asks")], ["n"])
    enough = down.agg(F.sum(F.col("k").cast("double") * F.col("cum_n"))).first()[0]
    return enough / (float(r) * c)


def _with_expected(x: str, y: str, y_values: Sequence | None, cells: DataFrame, rows: DataFrame, cols: DataFrame, shape: tuple) -> DataFrame:
    if y_values is not None:
        kind = cells.schema[y].dataType
        every = rows.select(x, "_rs", F.explode(F.array(*[F.lit(v).cast(kind) for v in y_values])).alias(y))
        out = every.join(cells, [x, y], "left").join(cols, y).fillna(0, subset=["observed"]).withColumn(y, F.col(y).cast("string"))
    else:
        out = cells.join(rows, x).join(cols, y)
    return out.select(x, y, "observed", _expected(shape[0]).alias("expected"))


def contingency_cells(df: DataFrame, x: str, y: str, y_values: Sequence | None = None) -> DataFrame:
    """Long table ``(x, y, observed, expected)`` of the cells that occur; where
    ``y_values`` lists the outcomes, also of the empty cells, with ``y`` as text."""
    return _with_expected(x, y, y_values, *_cells_and_margins(df, x, y, y_values))


def chi2_independence(df: DataFrame, x: str, y: str, correction: bool = True,
                      y_values: Sequence | None = None) -> DataFrame:
    """One row ``(chi2, dof, n_cells, p)``, none for an empty table. With one
    degree of freedom and ``correction`` the observed counts move half a unit
    toward the expected ones (Yates), as the reference's test does by default."""
    cells, rows, cols, (total, r, c) = _cells_and_margins(df, x, y, y_values)
    dof = (r - 1) * (c - 1)
    found = []
    if total and dof == 1:                   # four cells: two margins of two rows each
        row, col = ({k: n for k, n in t.collect()} for t in (rows, cols))
        seen = {(a, b): n for a, b, n in cells.select(x, y, "observed").collect()}
        chi2 = 0.0
        for a, n in row.items():
            for b, m in col.items():
                off = abs(n * m / total - seen.get((a, b), 0))
                chi2 += (off - (min(0.5, off) if correction else 0.0)) ** 2 / (n * m / total)
        found = [(chi2, dof, r * c, chi2_sf(chi2, dof))]
    elif total:
        off = F.col("observed") - _expected(total)
        # a cell that does not occur adds its expected count; together they add what the present ones leave of the total
        part = cells.join(rows, x).join(cols, y).agg(F.sum(off * off / _expected(total)), F.sum(_expected(total))).first()
        chi2 = part[0] + max(0.0, total - part[1])
        found = [(chi2, dof, r * c, chi2_sf(chi2, dof))]
    return df.sparkSession.createDataFrame(found, "chi2 double, dof bigint, n_cells bigint, p double")


def chi2_expected_counts(df: DataFrame, x: str, y: str, y_values: Sequence | None = None) -> DataFrame:
    """Cells with expected counts (see ``contingency_cells``) plus the rule of
    thumb: share of all cells whose expected count is at least 5 (the test is
    trusted when it is >= 80%)."""
    cells, rows, cols, shape = _cells_and_margins(df, x, y, y_values)
    share = share_of_expected(rows, cols, shape)
    return _with_expected(x, y, y_values, cells, rows, cols, shape).withColumn("share_expected_ge5", F.lit(share).cast("double"))
