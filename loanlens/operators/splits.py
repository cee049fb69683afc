"""Splits and folds.

``holdout_split`` (in ``relational``) tags rows by a key hash with no
shuffle. The stratified variants are exact per label without sorting the
rows: they select the row at each cut position by refining a histogram.
Rows are counted by (label, leading hash bits), combined map-side; running
counts over one label's cells find the cell that holds a cut; only the rows
of such cells are counted again by their next bits, or ranked once few
enough are left. The cuts are a table joined by label, whatever the number
of labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import exact_quantiles
from .relational import hash_bits

HASH_BITS = 32
LEVEL_BITS = 12          # a label has at most 2**12 cells a level, so its running counts are one bounded window
CELL_ROWS = 100_000      # cells of more rows are refined; the rows of smaller ones are ranked
CUT_ROWS = 100_000       # cut tables of at most so many rows are fetched and broadcast; larger ones are joined


def _bounded(cuts: DataFrame) -> tuple[DataFrame, bool]:
    """(a cut table, whether it may be broadcast): a small one is fetched, so it is computed once."""
    rows = cuts.limit(CUT_ROWS + 1).collect()
    if len(rows) > CUT_ROWS:
        return cuts, False
    return cuts.sparkSession.createDataFrame(rows, cuts.schema), True


def _join(left: DataFrame, cuts: DataFrame, small: bool, on: Column, how: str) -> DataFrame:
    return left.join(F.broadcast(cuts) if small else cuts, on, how)


def _cells(rows: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """Counts by ``keys`` and the hash bits above ``shift``, each with the counts ``_before`` it and of all its keys' rows."""
    w = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, F.shiftright("_h", shift).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumns({"_before": F.sum("_n").over(w.orderBy("_b")) - F.col("_n"), "_all": F.sum("_n").over(w)})


def label_cuts(df: DataFrame, label: str, key: str, seed: int, positions: Column) -> tuple[DataFrame, bool]:
    """(label ``_l``, array ``_cuts`` of (hash, key) structs ascending), and whether the table may be broadcast.

    ``positions`` gives the wanted positions (array of longs, from 0) among a
    label's rows in (hash, key) order from their number, column ``_all``.
    Labels without a position have no row; rows without a key do not count.
    """
    rows = df.select(F.col(f"`{label}`").alias("_l"), hash_bits(key, seed).alias("_h"), F.col(f"`{key}`").alias("_k")).where("_k is not null")
    shift = HASH_BITS - LEVEL_BITS
    cells = _cells(rows, ["_l"], shift).select("*", F.posexplode(positions).alias("_i", "_p"))
    held = cells.where("_p >= _before and _p < _before + _n").select("_l", "_i", "_b", (F.col("_p") - F.col("_before")).alias("_at"), "_n")
    while True:
        held, small = _bounded(held)
        wanted = held.withColumnsRenamed({"_l": "_cl", "_b": "_cb"}).drop("_n")
        inside = _join(rows, wanted, small, F.col("_l").eqNullSafe(F.col("_cl")) & (F.shiftright("_h", shift) == F.col("_cb")), "inner")
        if shift == 0 or held.where(F.col("_n") > CELL_ROWS).isEmpty():
            break
        shift = max(0, shift - LEVEL_BITS)
        finer = _cells(inside, ["_l", "_i", "_at"], shift).where("_at >= _before and _at < _before + _n")
        held = finer.select("_l", "_i", "_b", (F.col("_at") - F.col("_before")).alias("_at"), "_n")
    place = F.row_number().over(Window.partitionBy("_l", "_i").orderBy("_h", "_k")) - 1
    at = inside.withColumn("_place", place).where("_place = _at")
    return _bounded(at.groupBy("_l").agg(F.array_sort(F.collect_list(F.struct("_h", "_k"))).alias("_cuts")))


def _cuts_passed(df: DataFrame, label: str, key: str, seed: int, positions: Column, out: str) -> DataFrame:
    """``df`` plus ``out``: how many of its label's cuts lie at or before the row; 0 without cuts, null without a key."""
    cuts, small = label_cuts(df, label, key, seed, positions)
    mine = F.struct(hash_bits(key, seed).alias("_h"), F.col(f"`{key}`").alias("_k"))
    passed = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= mine)), F.lit(0))
    joined = _join(df, cuts, small, F.col(f"`{label}`").eqNullSafe(F.col("_l")), "left")
    return joined.withColumn(out, F.when(F.col(f"`{key}`").isNotNull(), passed)).drop("_l", "_cuts")


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Per label, the ``round(test_size * n_label)`` rows with the smallest key
    hash go to ``test``, the rest to ``train``; label shares are kept. A null
    label is a label of its own; rows without a key are ``train``."""
    first_train = F.floor(F.col("_all") * F.lit(float(test_size)) + 0.5)
    positions = F.filter(F.array(first_train), lambda p: p < F.col("_all"))
    out = _cuts_passed(df, label, key, seed, positions, "_passed")
    return out.withColumn(split_col, F.when(F.col("_passed") == 0, "test").otherwise("train")).drop("_passed")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 0,
                     fold_col: str = "fold") -> DataFrame:
    """Fold = floor(position * k / n_label) in hash order: every fold holds the
    same share of each label (sizes differ by at most one). A null label is a
    label of its own; rows without a key are in fold 0."""
    starts = F.array(*[F.ceil(F.lit(i) * F.col("_all") / k) for i in range(1, k)]) if k > 1 else F.array().cast("array<bigint>")
    positions = F.filter(starts, lambda p: p < F.col("_all"))
    out = _cuts_passed(df, label, key, seed, positions, "_passed")
    return out.withColumn(fold_col, F.coalesce("_passed", F.lit(0)).cast("int")).drop("_passed")


def recency_split(df: DataFrame, day_col: str, test_size: float = 0.2, split_col: str = "split") -> DataFrame:
    """Train on older rows, test on the newest: rows above the exact
    (1 - test_size) quantile of the day column are ``test``."""
    cut = exact_quantiles(df, day_col, [1.0 - test_size]).first()["q"]
    return df.withColumn(split_col, F.when(F.col(day_col) > F.lit(cut), F.lit("test")).otherwise(F.lit("train")))
