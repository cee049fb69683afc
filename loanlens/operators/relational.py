"""Sampling, key-driven splits of child tables, history views and the
remaining joins (SURVEY §A sampling, §C sorts, §D joins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_TWO_32 = 4294967296.0


def hash_bits(key: str | Column, seed: int = 42) -> Column:
    """The first 32 bits of md5(key|seed) as a whole number. The same value is
    reproducible in any SQL engine with md5, and computing it needs no shuffle."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def hash_unit(key: str | Column, seed: int = 42) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) per key, from ``hash_bits``."""
    return hash_bits(key, seed) / F.lit(_TWO_32)


def sample_fraction(df: DataFrame, frac: float, key: str, seed: int = 42, fast: bool = False) -> DataFrame:
    """Rows whose key hashes below ``frac``: map-only, reproducible, and all rows
    of a key are kept or dropped together. ``fast=True`` uses Spark's Bernoulli
    ``sample`` instead (per row, reproducible only for the same partitioning)."""
    if fast:
        return df.sample(fraction=float(frac), seed=seed)
    return df.where(hash_unit(key, seed) < F.lit(float(frac)))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows: the smallest hashes (top-k per partition, then merged)."""
    return df.orderBy(hash_unit(key, seed), F.col(key)).limit(n)


def holdout_split(df: DataFrame, key: str, test_size: float = 0.05, seed: int = 42,
                  split_col: str = "split") -> DataFrame:
    """Tag each row train/test by its key's hash (no shuffle, reproducible)."""
    return df.withColumn(split_col, F.when(hash_unit(key, seed) < F.lit(float(test_size)), F.lit("test"))
                         .otherwise(F.lit("train")))


def split_children(child: DataFrame, parent_keys: DataFrame, key: str) -> DataFrame:
    """Child rows whose key occurs in the parent split (``isin`` -> semi join).
    Spark plans a broadcast semi join only when the key side is measured small
    (AQE runtime statistics), else a sort-merge semi join that AQE splits when
    one key is skewed: that needs a bare shuffle on either side, so the keys
    are not made distinct first (a semi join does not need it)."""
    return child.join(parent_keys.select(key), on=key, how="left_semi")


def split_grandchildren(grandchild: DataFrame, child: DataFrame, parent_keys: DataFrame, parent_key: str,
                        child_key: str) -> DataFrame:
    """Two hops: parent split -> child rows -> grandchild rows."""
    kids = split_children(child.select(parent_key, child_key), parent_keys, parent_key)
    return grandchild.join(kids.select(child_key), on=child_key, how="left_semi")


def split_keys(parent_split: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    """The distinct (key, split) pairs of a split parent, written once (reliable
    checkpoint) for all its children."""
    ensure_checkpoint_dir(parent_split.sparkSession)
    return parent_split.where(F.col(split_col).isin("train", "test")).select(key, split_col).distinct().checkpoint()


def propagate_split(child: DataFrame, parent_split: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    """Child rows take the split of their parent; rows without a parent drop
    out, like the reference's ``isin`` filter. One join of the child with the
    parent's distinct keys: it is scanned and shuffled once, parent rows that
    repeat a key cannot multiply its children, and as the keys are a written
    table both sides are bare shuffles, which AQE can split at a hot key."""
    return _with_split(child, split_keys(parent_split, key, split_col), key, split_col)


def _with_split(child: DataFrame, keys: DataFrame, key: str, split_col: str = "split") -> DataFrame:
    return child.join(keys.select(key, split_col), on=key).select(*[F.col(f"`{c}`") for c in child.columns], split_col)


def split_by_own_key(child: DataFrame, parents: DataFrame, key: str, test_size: float = 0.05, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Direct children of a hash-split parent: the split follows from the hash of
    the child's own parent key, and a plain semi join drops rows without a parent."""
    return holdout_split(split_children(child, parents, key), key, test_size, seed, split_col)


def split_family(app: DataFrame, bureau: DataFrame, balance: DataFrame, prev: DataFrame, cash: DataFrame,
                 inst: DataFrame, card: DataFrame, test_size: float = 0.05, seed: int = 42) -> dict:
    """Train/test copies of all seven tables: the application by key hash,
    bureau and previous applications through the client, bureau balance
    through the bureau loan, the three monthly tables through the previous
    application (two hops, as the reference derives them)."""
    a = holdout_split(app, "SK_ID_CURR", test_size, seed)
    b = split_by_own_key(bureau, a, "SK_ID_CURR", test_size, seed)
    p = split_by_own_key(prev, a, "SK_ID_CURR", test_size, seed)
    loans, earlier = split_keys(b, "SK_ID_BUREAU"), split_keys(p, "SK_ID_PREV")
    return {"application": a, "bureau": b, "bureau_balance": _with_split(balance, loans, "SK_ID_BUREAU"),
            "previous_application": p, "pos_cash_balance": _with_split(cash, earlier, "SK_ID_PREV"),
            "installments_payments": _with_split(inst, earlier, "SK_ID_PREV"),
            "credit_card_balance": _with_split(card, earlier, "SK_ID_PREV")}


def rank_top_categories(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """``value_counts().head(n)``: the n most frequent values (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def entity_history(df: DataFrame, entities: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """All rows of the given entities, sorted on several keys descending."""
    return df.join(entities.select(key).distinct(), on=key, how="left_semi").orderBy(
        *[F.desc(c) for c in order])


def enrich_predictions(predictions: DataFrame, prev: DataFrame, app: DataFrame,
                       prev_cols: Sequence[str] = ("SK_ID_CURR", "SK_ID_PREV", "DAYS_DECISION",
                                                   "NAME_CONTRACT_STATUS_Refused")) -> DataFrame:
    """Predictions (carrying their key) -> previous applications -> applications,
    both left joins. Only the needed previous-application columns are read."""
    out = predictions.join(prev.select(*prev_cols), on="SK_ID_PREV", how="left")
    return out.join(app, on="SK_ID_CURR", how="left")


def compare_importances(a: DataFrame, b: DataFrame, on: str = "col_name",
                        suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Full outer join of two ranking tables on the column name."""
    ra = a.withColumnsRenamed({c: c + suffixes[0] for c in a.columns if c != on})
    rb = b.withColumnsRenamed({c: c + suffixes[1] for c in b.columns if c != on})
    return ra.join(rb, on=on, how="full_outer")
