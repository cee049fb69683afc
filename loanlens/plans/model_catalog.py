"""Registered queries for fitted preprocessing, models, attribution and
scoring (SURVEY §I, §J, §L, §M). Models train on the stand-in tables, so the
work grows with the data."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..modeling import stages as stg
from ..modeling import training as tr
from ..operators import attribution as at
from ..operators import evaluate as ev
from ..operators import relational as rel
from ..operators import splits as sp
from ..roles import (APP_COLS_TARGET_20, PROFITABLE_THRESHOLD, REFUSED_BINARY_COLUMNS, REFUSED_FEAT_SEL_AFTER_PREP, REFUSED_FEAT_SEL_BEFORE_PREP,
                     REFUSED_ONE_HOT_COLUMNS, REFUSED_PASSTHROUGH_COLUMNS, REFUSED_TARGET_COLUMNS, REQUEST_FIELDS,
                     TARGET_DROP_AFTER_ALL, TARGET_DROP_AFTER_LATEST)
from ..sources.tables import work_dir, written
from ..streaming import scoring as sc
from . import marts
from .catalog import T, impact_report, register

LABEL_T = "TARGET"
LABEL_R = "NAME_CONTRACT_STATUS_Refused"
APP_ONEHOT = ["CODE_GENDER"]
APP_TARGET_ENC = ["ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE"]
ONEHOT_DEMO = ["FLAG_LAST_APPL_PER_CONTRACT", "NAME_CONTRACT_TYPE", "NAME_TYPE_SUITE"]
DROP_DEMO = ["NAME_CONTRACT_TYPE_XNA", "NAME_TYPE_SUITE_Group of people"]


def mart20(spark, d) -> DataFrame:
    t = T(spark, d)
    return marts.feature_mart_20(t.app, t.cash, t.inst_derived, t.bureau, t.prev)


def written_mart20(spark, d) -> DataFrame:
    """The mart joined and aggregated once; fits, splits and transforms read its table."""
    return written(mart20(spark, d), "mart20")


def target_pipeline(use_gender: bool = False) -> Pipeline:
    """Preprocessing of the payment-difficulty model. Gender stays in the mart
    (the group-impact report needs it) but is a model feature only on request."""
    onehot = APP_ONEHOT if use_gender else []
    exclude = ["SK_ID_CURR", "fold"] + ([] if use_gender else APP_ONEHOT)
    return tr.column_role_pipeline(onehot_cols=onehot, target_cols=APP_TARGET_ENC, label_col=LABEL_T,
                                   exclude_cols=exclude, mode_impute_cols=onehot,
                                   constant_impute_cols=APP_TARGET_ENC)


def refusal_frame(spark, d) -> DataFrame:
    keep = ["SK_ID_PREV", LABEL_R] + REFUSED_BINARY_COLUMNS + REFUSED_ONE_HOT_COLUMNS + REFUSED_TARGET_COLUMNS \
        + [c for c in REFUSED_PASSTHROUGH_COLUMNS if c != "SK_ID_PREV"]
    return fc.binary_label(T(spark, d).prev).select(*keep)


def refusal_pipeline() -> Pipeline:
    """The final refusal model's preprocessing: the contract type is left out
    before encoding and eight dummies after it (its feature selection); the
    previous-application key is carried, not used as a feature."""
    onehot = REFUSED_BINARY_COLUMNS + [c for c in REFUSED_ONE_HOT_COLUMNS if c not in REFUSED_FEAT_SEL_BEFORE_PREP]
    return tr.column_role_pipeline(onehot_cols=onehot, target_cols=REFUSED_TARGET_COLUMNS, label_col=LABEL_R,
                                   exclude_cols=["SK_ID_PREV"], drop_after=REFUSED_FEAT_SEL_AFTER_PREP)


def _gbt(label, max_iter=100, step=0.1, depth=4):
    return tr.boosted_tree_classifier(label=label, max_iter=max_iter, step_size=step, max_depth=depth)


def _split(df, label, key, seed=42):
    parts = sp.stratified_split(df, label, key, 0.2, seed)
    return parts.where("split = 'train'").drop("split"), parts.where("split = 'test'").drop("split")


# ------------------------------------------------------------------ §I fitted preprocessing

@register("mode_impute_sentinel")
def q_mode_impute(spark, d):
    app = T(spark, d).app.select("SK_ID_CURR", "TARGET", "CODE_GENDER")
    train, _ = _split(app, "TARGET", "SK_ID_CURR")
    model = stg.SentinelImputer(inputCols=["CODE_GENDER"], strategy="most_frequent").fit(train)
    return model.transform(app).select("SK_ID_CURR", "CODE_GENDER")


@register("constant_impute_sentinel")
def q_constant_impute(spark, d):
    app = T(spark, d).app.select("SK_ID_CURR", "ORGANIZATION_TYPE")
    model = stg.SentinelImputer(inputCols=["ORGANIZATION_TYPE"], strategy="constant").fit(app)
    return model.transform(app)


def _prev_split(spark, d):
    return _split(refusal_frame(spark, d), LABEL_R, "SK_ID_PREV")


@register("one_hot_encode")
def q_one_hot(spark, d):
    train, _ = _prev_split(spark, d)
    model = stg.NamedOneHotEncoder(inputCols=ONEHOT_DEMO).fit(train)
    return model.transform(refusal_frame(spark, d).select("SK_ID_PREV", *ONEHOT_DEMO))


@register("drop_after_encoding")
def q_drop_after(spark, d):
    train, _ = _prev_split(spark, d)
    pm = Pipeline(stages=[stg.NamedOneHotEncoder(inputCols=ONEHOT_DEMO), stg.DropColumns(inputCols=DROP_DEMO)])
    return pm.fit(train).transform(refusal_frame(spark, d).select("SK_ID_PREV", *ONEHOT_DEMO))


@register("target_encode")
def q_target_encode(spark, d):
    train, _ = _prev_split(spark, d)
    model = stg.SmoothedTargetEncoder(inputCols=REFUSED_TARGET_COLUMNS, labelCol=LABEL_R).fit(train)
    return model.transform(refusal_frame(spark, d).select("SK_ID_PREV", *REFUSED_TARGET_COLUMNS))


MART_NUMERIC = ["EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "OWN_CAR_AGE", "AMT_ANNUITY",
                "cash_CNT_INSTALMENT_max", "inst_Days_till_deadline_min", "inst_Amt_deficit_mean",
                "bur_DAYS_CREDIT_mean", "prev_AMT_ANNUITY_mean", "prev_Credit_diff_max"]


@register("missing_value_fill")
def q_missing_fill(spark, d):
    m = written_mart20(spark, d)
    return stg.MissingValueFill(inputCols=MART_NUMERIC).fit(m).transform(m).select("SK_ID_CURR", *MART_NUMERIC)


@register("column_role_pipeline")
def q_role_pipeline(spark, d):
    m = written_mart20(spark, d)
    model = target_pipeline().fit(m)
    return _named(model.transform(m), model.stages[-1].feature_names(), "SK_ID_CURR", LABEL_T)


@register("fit_transform_split")
def q_fit_transform_split(spark, d):
    pm, tr_, va = tr.fit_transform_split(written_mart20(spark, d), target_pipeline(), LABEL_T, "SK_ID_CURR")
    names = pm.stages[-1].feature_names()
    return _named(tr_, names, "SK_ID_CURR", LABEL_T).withColumn("part", F.lit("train")).unionByName(
        _named(va, names, "SK_ID_CURR", LABEL_T).withColumn("part", F.lit("valid")))


# ------------------------------------------------------------------ §J models

@register("naive_baseline_log_loss")
def q_naive(spark, d):
    folds = sp.stratified_folds(T(spark, d).app, LABEL_T, "SK_ID_CURR", 5, seed=0)
    return tr.naive_baseline_log_loss(folds, LABEL_T)


def _target_fit(spark, d, max_iter=60, patience=15, mart=None, depth=4):
    """Preprocessing and boosted trees of the payment-difficulty model. The two
    prepared parts are written once, since every boosting round reads them."""
    mart = mart if mart is not None else written_mart20(spark, d)
    pm, tr_, va = tr.fit_transform_split(mart, target_pipeline(), LABEL_T, "SK_ID_CURR")
    parts = [written(part.select("SK_ID_CURR", LABEL_T, "features"), f"target-{name}") for name, part in (("train", tr_), ("valid", va))]
    res = tr.train_with_early_stopping(*parts, _gbt(LABEL_T, max_iter, depth=depth), patience)
    return pm, *parts, res


@register("boosted_tree_classifier")
def q_gbt(spark, d):
    """The reference's fit: up to 500 rounds at rate 0.1, patience 50 and its library's depth of 6."""
    _, _, va, res = _target_fit(spark, d, max_iter=500, patience=50, depth=6)
    return tr.positive_probability(res.model.transform(va)).select("SK_ID_CURR", LABEL_T, "score")


@register("early_stopping")
def q_early_stopping(spark, d):
    _, _, _, res = _target_fit(spark, d)
    return spark.createDataFrame([(res.best_round, len(res.curve))], "best_round int, rounds_fitted int")


@register("learning_curve")
def q_learning_curve(spark, d):
    _, _, _, res = _target_fit(spark, d)
    return tr.learning_curve(spark, res)


@register("feature_set_experiments")
def q_experiments(spark, d):
    """The reference's ladder of column sets, drop lists and the 20-feature cut
    included (columns that the stand-in tables lack cannot be dropped)."""
    t = T(spark, d)
    full = marts.feature_mart_full(t.app, t.bureau, t.balance, t.cash, t.inst, t.card, t.prev)
    app_cols = [c for c in APP_COLS_TARGET_20 if c != LABEL_T]
    bur = [c for c in full.columns if c.startswith("bur_") and not c.startswith("bur_lat_")]
    lat = [c for c in full.columns if c.startswith("bur_lat_")]
    rest = [c for c in full.columns if c.split("_")[0] in ("cash", "inst", "cred", "prev")]

    def without(cols, *lists):
        return [c for c in cols if not any(c in gone for gone in lists)]
    every = app_cols + bur + lat + rest
    m20 = mart20(spark, d)
    twenty = [c for c in m20.columns if c not in ("SK_ID_CURR", LABEL_T)]
    sets = {"application": app_cols, "+bureau": app_cols + bur, "+latest": app_cols + bur + lat, "+all": every,
            "+all, first drop list": without(every, TARGET_DROP_AFTER_LATEST),
            "+all, both drop lists": without(every, TARGET_DROP_AFTER_LATEST, TARGET_DROP_AFTER_ALL), "20 features": twenty}
    missing = [c for c in twenty if c not in full.columns]      # a 20-feature aggregate the full mart names differently
    full = full.join(m20.select("SK_ID_CURR", *missing), "SK_ID_CURR", "left") if missing else full
    return tr.feature_set_experiments(spark, full, sets, LABEL_T, "SK_ID_CURR", lambda cols: target_pipeline(),
                                      _gbt(LABEL_T, 40), patience=10)


@register("refit_full")
def q_refit(spark, d):
    m = written_mart20(spark, d)
    _, _, _, res = _target_fit(spark, d, mart=m)
    model = tr.refit_full(m, target_pipeline(), _gbt(LABEL_T), res.best_round)
    return tr.positive_probability(model.transform(m)).select("SK_ID_CURR", LABEL_T, "score")


@register("hyperparameter_search")
def q_search(spark, d):
    """Six trials, three of them guided, of up to 40 rounds with patience 5 (the operator's defaults: 100, 90, 1,000 and 20)."""
    return tr.hyperparameter_search(spark, written_mart20(spark, d), LABEL_T, "SK_ID_CURR", target_pipeline(), n_trials=6, k=5,
                                    max_iter=40, patience=5, startup=3)


@register("model_leaderboard")
def q_leaderboard(spark, d):
    return tr.model_leaderboard(spark, written_mart20(spark, d), LABEL_T, "SK_ID_CURR", target_pipeline(), sample_frac=0.2, k=3)


def _refusal_model(spark, d, max_iter=60) -> PipelineModel:
    train, _ = _prev_split(spark, d)
    return Pipeline(stages=list(refusal_pipeline().getStages()) + [_gbt(LABEL_R, max_iter, 0.2)]).fit(train)


@register("save_load_model")
def q_save_load(spark, d):
    model = _refusal_model(spark, d)
    path = work_dir(spark, "saved-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return sc.score_batch(refusal_frame(spark, d), loaded)


@register("final_test_run")
def q_final_test(spark, d):
    """Held-out run of both problems: log loss, average precision, curve,
    confusion cells and report at each problem's profitable threshold (the
    refusal model's is fixed, the other's comes from the training rows)."""
    m = rel.holdout_split(written_mart20(spark, d), "SK_ID_CURR", 0.05, 42)
    r = rel.holdout_split(refusal_frame(spark, d), "SK_ID_PREV", 0.05, 42)
    out = []
    for name, df, label, pipeline, gbt, threshold in (
            ("payment_difficulty", m, LABEL_T, target_pipeline(), _gbt(LABEL_T, 60), None),
            ("refusal", r, LABEL_R, refusal_pipeline(), _gbt(LABEL_R, 60, 0.2), PROFITABLE_THRESHOLD)):
        train, test = df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")
        model = Pipeline(stages=[*pipeline.getStages(), gbt]).fit(train)

        def scored(part):
            return tr.positive_probability(model.transform(part)).select(F.col(label).alias("label"), "score")
        if threshold is None:
            threshold = ev.best_threshold(ev.profit_sweep(scored(train))).first()["best_threshold"]
        out.append(ev.held_out_report(scored(test), threshold).select(F.lit(name).alias("problem"), "*"))
    return out[0].unionByName(out[1])


# ------------------------------------------------------------------ §L attribution

def _contrib(spark, d, mart=None):
    pm, _, va, res = _target_fit(spark, d, max_iter=60, patience=15, mart=mart)
    names = pm.stages[-1].feature_names()
    return at.tree_contributions(res.model, va, keep=["SK_ID_CURR"]), names, va, pm


@register("tree_contributions")
def q_contrib(spark, d):
    c, _, _, _ = _contrib(spark, d)
    return c


@register("model_importance_rank")
def q_importance(spark, d):
    c, names, _, _ = _contrib(spark, d)
    return at.feature_importance_rank(at.contributions_long(c, names, ["SK_ID_CURR"]))


@register("model_top_and_tail")
def q_top_tail(spark, d):
    c, names, _, _ = _contrib(spark, d)
    return at.top_and_tail(at.feature_importance_rank(at.contributions_long(c, names, ["SK_ID_CURR"])), 5)


def _named(df: DataFrame, names, *keep) -> DataFrame:
    """The feature vector as named columns."""
    return df.select(*keep, vector_to_array("features").alias("_x")).select(*keep, *[F.col("_x")[i].alias(n) for i, n in enumerate(names)])


@register("model_contribution_summary")
def q_contrib_summary(spark, d):
    c, names, va, pm = _contrib(spark, d)
    return at.contribution_summary(_named(va, names, "SK_ID_CURR"), at.contributions_long(c, names, ["SK_ID_CURR"]), ["SK_ID_CURR"])


@register("backward_selection")
def q_backward(spark, d):
    """From the application and bureau features down to 20, ten a round (the
    reference drops one), with early stopping and contributions on 30% of the
    validation rows."""
    t = T(spark, d)
    full = marts.feature_mart_full(t.app, t.bureau, t.balance, t.cash, t.inst, t.card, t.prev)
    cols = [c for c in full.columns if c.startswith("bur_")] + [c for c in APP_COLS_TARGET_20 if c != LABEL_T]
    full = written(full.select("SK_ID_CURR", LABEL_T, *cols), "backward-mart")      # read by the fit and by both parts
    pm, tr_, va = tr.fit_transform_split(full, target_pipeline(), LABEL_T, "SK_ID_CURR")
    names, parts = pm.stages[-1].feature_names(), []
    for name, part in (("train", tr_), ("valid", va)):       # read by every round
        path = work_dir(spark, f"backward-{name}")
        _named(part, names, "SK_ID_CURR", LABEL_T).write.parquet(path)
        parts.append(spark.read.parquet(path))
    return at.backward_selection(spark, *parts, names, LABEL_T, reduce_to=20, make_gbt=lambda: _gbt(LABEL_T, 40, 0.2),
                                 drop_per_round=10, sample_frac=0.3, key="SK_ID_CURR", patience=5)


@register("shadow_feature_selection")
def q_shadow(spark, d):
    """Twenty iterations on the 20-feature mart, merged with the contributions of its boosted trees."""
    mart = written_mart20(spark, d)
    c, names, _, pm = _contrib(spark, d, mart)
    rank = at.feature_importance_rank(at.contributions_long(c, names, ["SK_ID_CURR"]))
    m = _named(pm.transform(mart), names, "SK_ID_CURR", LABEL_T)
    return at.shadow_feature_selection(spark, m, names, LABEL_T, "SK_ID_CURR", iterations=20, importances=rank)


# ------------------------------------------------------------------ §M scoring

@register("score_batch")
def q_score_batch(spark, d):
    return sc.score_batch(refusal_frame(spark, d), _refusal_model(spark, d))


def request_text(spark, d) -> DataFrame:
    """Requests as text fields; a missing amount arrives as 'n/a'."""
    prev = T(spark, d).prev
    cols = []
    for name, typ in REQUEST_FIELDS:
        txt = F.col(name).cast("string")
        if typ == "double":
            txt = F.coalesce(txt, F.lit("n/a"))
        cols.append(txt.alias(name))
    return prev.select(*cols)


@register("model_group_impact")
def q_model_impact(spark, d):
    """The impact report on the refusal model's own predictions for previous
    applications it was not fitted on, with the applicants' groups."""
    train, valid = _prev_split(spark, d)
    model = Pipeline(stages=list(refusal_pipeline().getStages()) + [_gbt(LABEL_R, 60, 0.2)]).fit(train)
    scored = sc.score_batch(valid, model).select("SK_ID_PREV", F.col("probability").alias("proba_1"))
    return impact_report(spark, d, scored)


@register("validate_records")
def q_validate(spark, d):
    good, bad = sc.validate_records(request_text(spark, d))
    return good.select(F.col("SK_ID_PREV").cast("bigint").alias("SK_ID_PREV"), F.lit("").alias("errors")).unionByName(
        bad.select(F.col("SK_ID_PREV").cast("bigint").alias("SK_ID_PREV"), "errors"))


@register("score_stream")
def q_score_stream(spark, d):
    model = _refusal_model(spark, d)
    base = work_dir(spark, "stream")
    reqs = request_text(spark, d)
    # requests land as several files, as a stream source would see them
    reqs.repartition(4).write.mode("overwrite").parquet(f"{base}/in")
    q = sc.score_stream(spark, f"{base}/in", model, f"{base}/out", f"{base}/ckpt",
                        quarantine_dir=f"{base}/bad")
    q.awaitTermination()
    scored = spark.read.parquet(f"{base}/out").select("SK_ID_PREV", "refused", "probability")
    bad = spark.read.parquet(f"{base}/bad").select(F.col("SK_ID_PREV").try_cast("bigint").alias("SK_ID_PREV"), "errors")
    return scored.unionByName(bad, allowMissingColumns=True)
