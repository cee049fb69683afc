"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the stand-in loan tables (``sources.standins``) derived from the
driver's parquet files, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as TY

from ..functions import columns as fc
from ..operators import attribution as at
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import quality as qa
from ..operators import relational as rel
from ..operators import reports as rp
from ..operators import splits as sp
from ..operators import stats as st
from ..roles import REFUSED_MODEL_COLS_TO_DROP
from ..sources import tables as io
from ..sources.standins import LoanTables
from . import marts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def T(spark, sf_dir) -> LoanTables:
    return LoanTables(spark, sf_dir)


# ------------------------------------------------------------------ §E features

@register("feature_mart_20")
def q_feature_mart_20(spark, d):
    t = T(spark, d)
    return marts.feature_mart_20(t.app, t.cash, t.inst_derived, t.bureau, t.prev)


@register("join_feature_tables")
def q_join_feature_tables(spark, d):
    """The monthly tables' aggregates on the applications' keys and labels."""
    t = T(spark, d)
    return marts.join_feature_tables(t.app.select("SK_ID_CURR", "TARGET"), [fe.cash_features(t.cash), fe.installment_features(t.inst)])


@register("cash_features_20")
def q_cash20(spark, d):
    return fe.cash_features_20(T(spark, d).cash)


@register("installment_features_20")
def q_inst20(spark, d):
    return fe.installment_features_20(T(spark, d).inst)


@register("bureau_features_20")
def q_bur20(spark, d):
    return fe.bureau_features_20(T(spark, d).bureau)


@register("prev_features_20")
def q_prev20(spark, d):
    return fe.prev_features_20(T(spark, d).prev)


@register("balance_status_features")
def q_balance_status(spark, d):
    return fe.balance_status_features(T(spark, d).balance)


@register("balance_latest_status")
def q_balance_latest(spark, d):
    return fe.balance_latest_status(T(spark, d).balance)


@register("balance_recent_status")
def q_balance_recent(spark, d):
    return fe.balance_recent_status(T(spark, d).balance, 6)


@register("merge_balance_into_bureau")
def q_merge_balance(spark, d):
    t = T(spark, d)
    return fe.merge_balance_into_bureau(t.bureau, fe.balance_status_features(t.balance))


@register("bureau_features")
def q_bureau_features(spark, d):
    t = T(spark, d)
    return fe.bureau_features(marts.bureau_with_status(t.bureau, t.balance), values=t.bureau)


@register("bureau_latest_features")
def q_bureau_latest(spark, d):
    t = T(spark, d)
    return fe.bureau_latest_features(marts.bureau_with_status(t.bureau, t.balance))


@register("cash_features")
def q_cash(spark, d):
    return fe.cash_features(T(spark, d).cash)


@register("active_count_at_month")
def q_active(spark, d):
    return fe.keyed(T(spark, d).cash).groupBy(fe.KEY).agg(
        fe.active_count_at_month(name="cash_Status_Active_count"))


@register("installment_features")
def q_inst(spark, d):
    return fe.installment_features(T(spark, d).inst)


@register("card_features")
def q_card(spark, d):
    return fe.card_features(T(spark, d).card)


@register("prev_application_features")
def q_prev(spark, d):
    return fe.prev_application_features(T(spark, d).prev)


@register("feature_mart_full")
def q_mart_full(spark, d):
    t = T(spark, d)
    return marts.feature_mart_full(t.app, t.bureau, t.balance, t.cash, t.inst, t.card, t.prev)


@register("outer_join_aggregates")
def q_outer_join_aggs(spark, d):
    """The reference's aggregate-then-outer-join, folded into one aggregate."""
    end = F.col("DAYS_CREDIT_ENDDATE")
    return fe.keyed(T(spark, d).bureau).groupBy(fe.KEY).agg(
        F.avg("DAYS_CREDIT").alias("bur_DAYS_CREDIT_mean"),
        F.avg(F.when(end > 0, end)).alias("bur_DAYS_CREDIT_ENDDATE_mean"),
        F.max(F.when(end > 0, end)).alias("bur_DAYS_CREDIT_ENDDATE_max"))


@register("category_counts")
def q_category_counts(spark, d):
    return fe.category_counts(T(spark, d).bureau, fe.KEY, "CREDIT_TYPE", vocab=fe.BUREAU_CREDIT_TYPES)


@register("one_hot_infrequent")
def q_one_hot_infrequent(spark, d):
    wide = fe.category_counts(T(spark, d).bureau, fe.KEY, "CREDIT_TYPE", max_categories=7)
    value_cols = [c for c in wide.columns if c != fe.KEY]
    return wide.unpivot(fe.KEY, value_cols, "category", "n")


# ------------------------------------------------------------------ §A sources, sinks, sampling


ORDERS_SCHEMA = TY.StructType([
    TY.StructField("o_orderkey", TY.LongType()), TY.StructField("o_custkey", TY.LongType()),
    TY.StructField("o_orderstatus", TY.StringType()), TY.StructField("o_totalprice", TY.DoubleType()),
    TY.StructField("o_orderdate", TY.TimestampNTZType()), TY.StructField("o_orderpriority", TY.StringType()),
])


@register("scan_table")
def q_scan(spark, d):
    return io.scan_table(spark, d, "orders")


@register("csv_to_parquet")
def q_csv_to_parquet(spark, d):
    base = io.work_dir(spark, "csv")
    io.write_csv(io.scan_table(spark, d, "orders"), f"{base}/orders.csv")
    return io.csv_to_parquet(spark, f"{base}/orders.csv", ORDERS_SCHEMA)


def _app_split(spark, d):
    return rel.holdout_split(T(spark, d).app, "SK_ID_CURR", test_size=0.05, seed=42)


@register("holdout_split")
def q_holdout(spark, d):
    return _app_split(spark, d).select("SK_ID_CURR", "TARGET", "split")


@register("write_split_tables")
def q_write_split(spark, d):
    """Train/test copies of the seven tables, written partitioned by split and
    read back: rows per table and split."""
    t = T(spark, d)
    family = rel.split_family(t.app, t.bureau, t.balance, t.prev, t.cash, t.inst, t.card)
    paths = io.write_split_tables(family, io.work_dir(spark, "split"))
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "split", "rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("write_feature_table")
def q_write_feature(spark, d):
    return io.write_feature_table(fe.bureau_features_20(T(spark, d).bureau), io.work_dir(spark, "feat"))


@register("write_bucketed_tables")
def q_write_bucketed(spark, d):
    """The 20-feature mart rebuilt from saved, bucketed aggregates (the
    reference saves feature tables in one step and joins them in the next)."""
    t = T(spark, d)
    tag = io.work_dir(spark, "t").rsplit("-", 1)[-1]
    names = []
    for name, agg in [("cash", fe.cash_features_20(t.cash)), ("inst", fe.installment_features_20(t.inst)),
                      ("bur", fe.bureau_features_20(t.bureau)), ("prev", fe.prev_features_20(t.prev))]:
        table = f"loanlens_{name}_{tag}"
        io.write_bucketed_table(agg, table, io.work_dir(spark, f"{name}-bucketed"))
        names.append(table)
    from ..roles import APP_COLS_TARGET_20
    return marts.feature_mart_from_saved(spark, t.app.select("SK_ID_CURR", *APP_COLS_TARGET_20), names)


@register("write_report_csv")
def q_write_report(spark, d):
    top = rel.rank_top_categories(T(spark, d).prev, "NAME_GOODS_CATEGORY", 5)
    return io.write_report_csv(top, io.work_dir(spark, "report"))


@register("sample_fraction")
def q_sample_fraction(spark, d):
    return rel.sample_fraction(T(spark, d).app, 0.2, "SK_ID_CURR", seed=42)


@register("sample_n")
def q_sample_n(spark, d):
    return rel.sample_n(T(spark, d).app, 100, "SK_ID_CURR", seed=42)


# ------------------------------------------------------------------ §B quality

@register("duplicate_row_counts")
def q_dups(spark, d):
    return qa.duplicate_row_counts(T(spark, d).balance)


def _merged_bureau(t):
    return fe.merge_balance_into_bureau(t.bureau, fe.balance_status_features(t.balance))


@register("key_null_counts")
def q_key_nulls(spark, d):
    t = T(spark, d)
    return qa.key_null_counts({"bureau_merged": _merged_bureau(t), "cash": t.cash, "inst": t.inst,
                               "card": t.card, "prev": t.prev}, "SK_ID_CURR")


@register("superset_check")
def q_superset(spark, d):
    t = T(spark, d)
    return qa.superset_check(t.prev, t.cash, ["SK_ID_PREV"])


@register("null_proportions")
def q_null_props(spark, d):
    return qa.null_proportions(T(spark, d).prev)


@register("sentinel_audit")
def q_sentinel(spark, d):
    return qa.sentinel_audit(T(spark, d).app, "DAYS_EMPLOYED", fc.DAYS_SENTINEL)


@register("table_shape")
def q_shape(spark, d):
    t = T(spark, d)
    return qa.table_shape({"application": t.app, "bureau": t.bureau, "bureau_balance": t.balance,
                           "previous_application": t.prev, "pos_cash_balance": t.cash,
                           "installments_payments": t.inst, "credit_card_balance": t.card})


PROFILE_COLS = ["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "RATE_DOWN_PAYMENT",
                "DAYS_DECISION", "SELLERPLACE_AREA", "HOUR_APPR_PROCESS_START", "CNT_PAYMENT",
                "NAME_CONTRACT_TYPE", "NAME_CONTRACT_STATUS", "NAME_TYPE_SUITE", "NAME_GOODS_CATEGORY",
                "NAME_PORTFOLIO", "PRODUCT_COMBINATION"]


@register("table_profile")
def q_profile(spark, d):
    return qa.table_profile(T(spark, d).prev, PROFILE_COLS)


def _refusal(t):
    return fc.binary_label(t.prev)


RATE_COLS = ["NAME_CONTRACT_TYPE", "NAME_PORTFOLIO", "NAME_YIELD_GROUP", "AMT_APPLICATION", "DAYS_DECISION"]


@register("target_rate_by_column")
def q_target_rate(spark, d):
    return qa.target_rate_by_column(_refusal(T(spark, d)), "NAME_CONTRACT_STATUS_Refused", RATE_COLS, bins=10)


ASSOC_COLS = ["NAME_CONTRACT_TYPE", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE", "PRODUCT_COMBINATION"]


@register("categorical_association")
def q_assoc(spark, d):
    return qa.categorical_association(T(spark, d).prev, ASSOC_COLS)


CORR_COLS = ["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_DOWN_PAYMENT"]


@register("numeric_correlation")
def q_corr(spark, d):
    return qa.numeric_correlation(T(spark, d).prev, CORR_COLS)


# ------------------------------------------------------------------ §C column operators

@register("recode_status")
def q_recode(spark, d):
    return T(spark, d).balance.withColumn("STATUS_num", fc.recode_status("STATUS"))


@register("flip_sign_columns")
def q_flip(spark, d):
    return fc.flip_sign_columns(T(spark, d).app.select("SK_ID_CURR", "DAYS_BIRTH", "DAYS_EMPLOYED"),
                                ["DAYS_BIRTH", "DAYS_EMPLOYED"])


@register("null_sentinel")
def q_null_sentinel(spark, d):
    return T(spark, d).app.select("SK_ID_CURR", fc.null_sentinel("DAYS_EMPLOYED").alias("DAYS_EMPLOYED_clean"))


@register("difference_feature")
def q_difference(spark, d):
    return T(spark, d).inst.select(
        "SK_ID_PREV", "NUM_INSTALMENT_NUMBER",
        fc.difference_feature("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT").alias("Days_till_deadline"),
        fc.difference_feature("AMT_INSTALMENT", "AMT_PAYMENT").alias("Amt_deficit"))


@register("overdue_flags")
def q_overdue(spark, d):
    return T(spark, d).cash.select("SK_ID_PREV", "MONTHS_BALANCE",
                                   fc.positive_flag("SK_DPD").alias("Has_overdue"),
                                   fc.positive_flag("SK_DPD_DEF").alias("Has_overdue_def"),
                                   fc.positive_flag("CNT_INSTALMENT").alias("Has_instalments"))


@register("binary_label")
def q_binary_label(spark, d):
    return _refusal(T(spark, d)).select("SK_ID_PREV", "NAME_CONTRACT_STATUS", "NAME_CONTRACT_STATUS_Refused")


@register("exclude_values")
def q_exclude(spark, d):
    prev = T(spark, d).prev
    return prev.where(fc.exclude_values("NAME_CASH_LOAN_PURPOSE", ["XAP", "XNA"])).select(
        "SK_ID_PREV", "NAME_CASH_LOAN_PURPOSE")


@register("fill_constant")
def q_fill(spark, d):
    prev = T(spark, d).prev.select("SK_ID_PREV", "NAME_TYPE_SUITE", "AMT_DOWN_PAYMENT", "RATE_DOWN_PAYMENT")
    prev = fc.fill_constant(prev, ["NAME_TYPE_SUITE"], "NONE")
    return fc.fill_constant(prev, ["AMT_DOWN_PAYMENT", "RATE_DOWN_PAYMENT"], -1)


@register("select_roles")
def q_select_roles(spark, d):
    return fc.select_roles(T(spark, d).prev, drop=REFUSED_MODEL_COLS_TO_DROP)


@register("flatten_agg_names")
def q_flatten(spark, d):
    agg = fe.keyed(T(spark, d).cash).groupBy("SK_ID_CURR").agg(
        F.count("SK_ID_PREV").alias("SK_ID_PREV_count"), F.max("CNT_INSTALMENT").alias("CNT_INSTALMENT_max"),
        F.avg("SK_DPD").alias("SK DPD mean"))
    return fc.flatten_agg_names(agg, "cash", renames={"SK DPD mean": "cash_dpd_mean"})


@register("recency_filter")
def q_recency(spark, d):
    return T(spark, d).prev.where(fc.recency_filter("DAYS_DECISION", 365)).select("SK_ID_PREV", "DAYS_DECISION")


@register("rank_top_categories")
def q_top_categories(spark, d):
    return rel.rank_top_categories(T(spark, d).prev, "NAME_GOODS_CATEGORY", 5)


@register("entity_history")
def q_entity_history(spark, d):
    cash = T(spark, d).cash
    sizes = fe.keyed(cash).groupBy("SK_ID_CURR").agg(F.count(F.lit(1)).alias("n"))
    busiest = sizes.join(sizes.agg(F.max("n").alias("n")), on="n", how="left_semi")
    return rel.entity_history(cash, busiest, "SK_ID_CURR", ["SK_ID_PREV", "MONTHS_BALANCE"])


# ------------------------------------------------------------------ §D joins

def _test_clients(spark, d):
    return _app_split(spark, d).where(F.col("split") == "test").select("SK_ID_CURR")


@register("split_children")
def q_split_children(spark, d):
    return rel.split_children(T(spark, d).bureau, _test_clients(spark, d), "SK_ID_CURR")


@register("split_grandchildren")
def q_split_grandchildren(spark, d):
    t = T(spark, d)
    return rel.split_grandchildren(t.balance, t.bureau, _test_clients(spark, d), "SK_ID_CURR", "SK_ID_BUREAU")


@register("merge_last_and_stats")
def q_merge_last_stats(spark, d):
    balance = T(spark, d).balance
    return fe.merge_last_and_stats(fe.month_zero_status(balance), fe.open_status_stats(balance))


def _stand_in_predictions(prev: DataFrame) -> DataFrame:
    """A probability per previous application derived from its key, standing
    in for model output where the report logic, not the model, is checked."""
    return prev.select("SK_ID_PREV", rel.hash_unit("SK_ID_PREV", 7).alias("proba_1"))


@register("enrich_predictions")
def q_enrich(spark, d):
    t = T(spark, d)
    prev = _refusal(t)
    return rel.enrich_predictions(_stand_in_predictions(prev), prev,
                                  t.app.select("SK_ID_CURR", "CODE_GENDER", "AMT_INCOME_TOTAL", "DAYS_BIRTH"))


@register("compare_importances")
def q_compare_importances(spark, d):
    prev = _refusal(T(spark, d))
    corr = qa.numeric_correlation(prev.withColumn("y", F.col("NAME_CONTRACT_STATUS_Refused").cast("double")),
                                  ["y"] + CORR_COLS)
    a = (corr.where(F.col("column_a") == "y").select(F.col("column_b").alias("col_name"),
                                                     F.abs("corr").alias("importance")))
    b = qa.null_proportions(prev, CORR_COLS + ["DAYS_DECISION"]).select(
        F.col("column").alias("col_name"), F.col("filled_share").alias("importance"))
    return rel.compare_importances(a, b)


# ------------------------------------------------------------------ §E group tables, §F reports


def _purpose_population(t):
    prev = _refusal(t)
    return prev.where(fc.exclude_values("NAME_CASH_LOAN_PURPOSE", ["XAP", "XNA"]))


@register("group_rate_and_median")
def q_group_rate_median(spark, d):
    return rp.group_rate_and_median(_purpose_population(T(spark, d)), "NAME_CASH_LOAN_PURPOSE",
                                    "NAME_CONTRACT_STATUS_Refused", "AMT_APPLICATION")


@register("filter_groups_by_median")
def q_filter_groups(spark, d):
    """Goods categories (XNA excluded) whose median amount is the most shared one."""
    prev = _refusal(T(spark, d))
    pop = prev.where(fc.exclude_values("NAME_GOODS_CATEGORY", ["XNA"])).withColumn(
        "AMT_BAND", F.floor(F.col("AMT_APPLICATION") / 100000) * 100000)
    return rp.filter_groups_by_median(pop, "NAME_GOODS_CATEGORY", "AMT_BAND").select(
        "SK_ID_PREV", "NAME_GOODS_CATEGORY", "AMT_BAND", "NAME_CONTRACT_STATUS_Refused")


@register("crosstab_counts")
def q_crosstab(spark, d):
    return rp.crosstab_counts(_purpose_population(T(spark, d)), "NAME_CASH_LOAN_PURPOSE",
                              "NAME_CONTRACT_STATUS_Refused", [0, 1])


@register("grouped_describe")
def q_grouped_describe(spark, d):
    return rp.grouped_describe(T(spark, d).scores, "label", "score")


@register("category_percent")
def q_category_percent(spark, d):
    return rp.category_percent(T(spark, d).balance, "STATUS")


@register("histogram")
def q_histogram(spark, d):
    return rp.histogram(T(spark, d).bureau, "DAYS_CREDIT", bins=20)


@register("class_density")
def q_class_density(spark, d):
    return rp.class_density(T(spark, d).scores, "score", "label")


@register("within_group_percent")
def q_within(spark, d):
    return rp.within_group_percent(T(spark, d).app, "ORGANIZATION_TYPE", "TARGET")


@register("overall_positive_rate")
def q_overall_rate(spark, d):
    return rp.overall_positive_rate(T(spark, d).app, "TARGET")


@register("group_outcome_report")
def q_group_outcome(spark, d):
    return rp.group_outcome_report(T(spark, d).app, "NAME_EDUCATION_TYPE", "TARGET")


@register("quantile_groups")
def q_quantile_groups(spark, d):
    app = T(spark, d).app
    return rp.quantile_groups(app, "AMT_INCOME_TOTAL", ["Low", "Medium", "High"], "Income Group").select(
        "SK_ID_CURR", "AMT_INCOME_TOTAL", "Income Group")


def impact_rows(spark, d, threshold: float = 0.35, predictions: DataFrame | None = None) -> DataFrame:
    """Last-year previous applications with predictions (``SK_ID_PREV,
    proba_1``; stand-ins by default), the applicant's gender and income / age
    terciles."""
    t = T(spark, d)
    prev = _refusal(t)
    enriched = rel.enrich_predictions(predictions if predictions is not None else _stand_in_predictions(prev), prev,
                                      t.app.select("SK_ID_CURR", "CODE_GENDER", "AMT_INCOME_TOTAL", "DAYS_BIRTH"))
    year = enriched.where(fc.recency_filter("DAYS_DECISION", 365)).withColumn(
        "Prediction", ev.apply_threshold("proba_1", threshold))
    return rp.quantile_groups_many(year, {
        "AMT_INCOME_TOTAL": (["Low", "Medium", "High"], "Income Group"),
        "DAYS_BIRTH": (["Lower Quantile", "Middle Quantile", "Upper Quantile"], "Age Group")})


def impact_report(spark, d, predictions: DataFrame | None = None) -> DataFrame:
    return rp.group_impact_report(impact_rows(spark, d, predictions=predictions), ["CODE_GENDER", "Income Group", "Age Group"],
                                  ["Prediction", "NAME_CONTRACT_STATUS_Refused"])


@register("group_impact_report")
def q_group_impact(spark, d):
    return impact_report(spark, d)


# ------------------------------------------------------------------ §G chi-square

@register("chi2_independence")
def q_chi2(spark, d):
    return st.chi2_independence(_purpose_population(T(spark, d)), "NAME_CASH_LOAN_PURPOSE",
                                "NAME_CONTRACT_STATUS_Refused", y_values=[0, 1]).select("chi2", "dof", "n_cells")


@register("chi2_p_value")
def q_chi2_p(spark, d):
    return st.chi2_independence(_purpose_population(T(spark, d)), "NAME_CASH_LOAN_PURPOSE",
                                "NAME_CONTRACT_STATUS_Refused", y_values=[0, 1])


@register("chi2_drop_group")
def q_chi2_drop(spark, d):
    pop = _purpose_population(T(spark, d)).where(F.col("NAME_CASH_LOAN_PURPOSE") != "Other")
    return st.chi2_independence(pop, "NAME_CASH_LOAN_PURPOSE", "NAME_CONTRACT_STATUS_Refused",
                                y_values=[0, 1]).select("chi2", "dof", "n_cells")


@register("chi2_expected_counts")
def q_chi2_expected(spark, d):
    return st.chi2_expected_counts(_purpose_population(T(spark, d)), "NAME_CASH_LOAN_PURPOSE",
                                   "NAME_CONTRACT_STATUS_Refused", y_values=[0, 1])


# ------------------------------------------------------------------ §H splits

@register("stratified_split")
def q_stratified_split(spark, d):
    return sp.stratified_split(T(spark, d).app, "TARGET", "SK_ID_CURR", 0.2, seed=42).select(
        "SK_ID_CURR", "TARGET", "split")


@register("stratified_folds")
def q_stratified_folds(spark, d):
    return sp.stratified_folds(T(spark, d).app, "TARGET", "SK_ID_CURR", 5, seed=0).select(
        "SK_ID_CURR", "TARGET", "fold")


@register("recency_split")
def q_recency_split(spark, d):
    return sp.recency_split(T(spark, d).prev, "DAYS_DECISION", 0.2).select("SK_ID_PREV", "DAYS_DECISION", "split")


# ------------------------------------------------------------------ §K evaluation

@register("log_loss")
def q_log_loss(spark, d):
    return ev.log_loss(T(spark, d).scores)


@register("precision_recall_curve")
def q_pr_curve(spark, d):
    return ev.precision_recall_curve(T(spark, d).scores)


@register("average_precision")
def q_ap(spark, d):
    return ev.average_precision(T(spark, d).scores)


@register("apply_threshold")
def q_apply_threshold(spark, d):
    s = T(spark, d).scores
    return s.select("l_orderkey", "l_linenumber", "score", ev.apply_threshold("score", 0.2).alias("prediction"))


def _predicted(spark, d, t=0.35):
    return T(spark, d).scores.withColumn("prediction", ev.apply_threshold("score", t))


@register("confusion_matrix")
def q_confusion(spark, d):
    return ev.confusion_matrix(_predicted(spark, d))


@register("classification_report")
def q_class_report(spark, d):
    return ev.classification_report(_predicted(spark, d))


@register("cumulative_gain")
def q_gain(spark, d):
    return ev.cumulative_gain(T(spark, d).scores)


@register("lift_at_fraction")
def q_lift(spark, d):
    return ev.lift_at_fraction(T(spark, d).scores, 0.2)


@register("profit_at_threshold")
def q_profit(spark, d):
    return ev.profit_at_threshold(T(spark, d).scores, 0.35)


@register("profit_sweep")
def q_sweep(spark, d):
    return ev.profit_sweep(T(spark, d).scores)


@register("best_threshold")
def q_best_threshold(spark, d):
    return ev.best_threshold(ev.profit_sweep(T(spark, d).scores), base=0.5)


@register("decision_certainty")
def q_certainty(spark, d):
    s = T(spark, d).scores
    return s.select("l_orderkey", "l_linenumber", "score",
                    ev.decision_certainty("score", 0.35).alias("certainty_pct"))


# Stand-in predictions of three models: the score, the score to one decimal (ties), and its complement.
PREDICTION_MODELS = {"fine": "score", "coarse": "round(score, 1)", "reverse": "1 - score"}


@register("prediction_metrics")
def q_prediction_metrics(spark, d):
    """The leaderboard's metrics on a given table of out-of-fold predictions."""
    s = T(spark, d).scores
    parts = [s.select(F.lit(name).alias("model"), (F.col("l_orderkey") % 3).cast("int").alias("fold"), "label", F.expr(e).alias("score"))
             for name, e in PREDICTION_MODELS.items()]
    table = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return ev.prediction_metrics(table.withColumn("prediction", ev.apply_threshold("score", 0.45)))


# ------------------------------------------------------------------ §L on a given contribution table

# feature: (centre, contribution per unit, contribution of a missing value)
CONTRIBUTION_RULES = {
    "EXT_SOURCE_1": (0.5, -1.5, 0.05), "EXT_SOURCE_2": (0.5, -2.0, 0.1), "EXT_SOURCE_3": (0.5, -1.25, 0.0),
    "AMT_CREDIT": (250000.0, 0.000002, 0.0), "AMT_ANNUITY": (14000.0, 0.00001, -0.125), "OWN_CAR_AGE": (9.0, 0.03125, 0.0625),
    "DAYS_BIRTH": (-16000.0, 0.00003, 0.0),
}


def given_contributions(spark, d) -> tuple[DataFrame, DataFrame]:
    """(feature values, long contribution table) of every application by fixed linear rules."""
    app = T(spark, d).app
    values = app.select("SK_ID_CURR", *[F.col(c).cast("double").alias(c) for c in CONTRIBUTION_RULES])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce((F.col(c) - F.lit(at)) * F.lit(per), F.lit(miss)).alias("contribution"))
                     for c, (at, per, miss) in CONTRIBUTION_RULES.items()])
    return values, values.select("SK_ID_CURR", F.explode(rows).alias("r")).select("SK_ID_CURR", "r.*")


@register("feature_importance_rank")
def q_feature_importance(spark, d):
    return at.feature_importance_rank(given_contributions(spark, d)[1])


@register("top_and_tail")
def q_top_and_tail(spark, d):
    return at.top_and_tail(at.feature_importance_rank(given_contributions(spark, d)[1]), 2)


@register("contribution_summary")
def q_contribution_summary(spark, d):
    values, long = given_contributions(spark, d)
    return at.contribution_summary(values, long, ["SK_ID_CURR"])
