"""Feature marts: per-client aggregates left-joined onto the application.

Every aggregate is already hash-partitioned on ``SK_ID_CURR`` by its own
``groupBy``; the chain of left joins on that one key therefore needs only the
application side shuffled (or, under AQE, a broadcast of whichever side the
runtime statistics show is small). Join order does not matter for left joins
on a unique key, so the chain keeps the reference's order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..operators import features as fe
from ..roles import APP_COLS_TARGET_20

KEY = fe.KEY


def join_feature_tables(base: DataFrame, tables: Iterable[DataFrame], key: str = KEY) -> DataFrame:
    out = base
    for t in tables:
        out = out.join(t, on=key, how="left")
    return out


def feature_mart_20(app: DataFrame, cash: DataFrame, inst: DataFrame, bureau: DataFrame,
                    prev: DataFrame) -> DataFrame:
    """Flagship: 12 application columns + label + 8 aggregates, one row per application."""
    base = app.select(KEY, *APP_COLS_TARGET_20)
    return join_feature_tables(base, [fe.cash_features_20(cash), fe.installment_features_20(inst),
                                      fe.bureau_features_20(bureau), fe.prev_features_20(prev)])


def bureau_with_status(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Bureau rows carrying per-loan status features. Rows the full outer merge
    would add for balance-only loans have no client and are dropped by every
    client aggregate, so a left join gives the same aggregates for less."""
    return bureau.join(fe.balance_status_features(balance), on=fe.LOAN, how="left")


def feature_mart_full(app: DataFrame, bureau: DataFrame, balance: DataFrame, cash: DataFrame,
                      inst: DataFrame, card: DataFrame, prev: DataFrame) -> DataFrame:
    """All six feature tables on the application."""
    merged = bureau_with_status(bureau, balance)
    return join_feature_tables(app, [
        fe.bureau_and_latest_features(merged, values=bureau), fe.cash_features(cash),
        fe.installment_features(inst), fe.card_features(card), fe.prev_application_features(prev)])


def feature_mart_from_saved(spark, app: DataFrame, saved: Iterable[str], key: str = KEY,
                            buckets: int | None = None) -> DataFrame:
    """The mart from saved, bucketed feature tables (``write_bucketed_table``):
    the application is bucketed the same way once, and every left join then
    reads matching buckets with no exchange."""
    from ..sources.tables import work_dir, write_bucketed_table
    base = write_bucketed_table(app, "loanlens_app_" + work_dir(spark, "b").rsplit("-", 1)[-1],
                                work_dir(spark, "app-bucketed"), key, buckets)
    return join_feature_tables(base, [spark.table(t) for t in saved], key)
