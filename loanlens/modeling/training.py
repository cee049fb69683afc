"""Pipelines, boosted trees and experiments.

The driver only loops over fits (each fit is a distributed Spark ML job) and
keeps per-round losses and metrics - small lists. All data stays in Spark.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators.splits import stratified_folds, stratified_split
from ..sources.tables import remove_folder, work_dir
from .search import SEARCH_SPACE, hyperparameter_search  # noqa: F401
from .stages import (DropColumns, MissingValueFill, NamedOneHotEncoder, SentinelImputer, SmoothedTargetEncoder,
                     SparseOneHotEncoder, _JsonParams)

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")
SPARSE_COL = "_onehot"


class RoleAssembler(Estimator, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Last pipeline stage: every numeric column except ``excludeCols`` becomes
    a feature (names kept, order kept); missing values go below the training
    minimum; columns are packed into one vector. Vector columns ``vectorCols``
    (sparse one-hot) follow the named ones."""

    excludeCols = Param(Params._dummy(), "excludeCols", "not features", typeConverter=TypeConverters.toListString)
    vectorCols = Param(Params._dummy(), "vectorCols", "vectors that follow the named features", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, excludeCols=None, featuresCol="features", vectorCols=()):
        super().__init__()
        self._setDefault(featuresCol="features", excludeCols=[], vectorCols=[])
        self._set(**{k: list(v) if k == "vectorCols" else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame):
        skip = set(self.getOrDefault(self.excludeCols)) | {self.getFeaturesCol()}
        names = [c for c, t in df.dtypes if c not in skip and (t in NUMERIC or t.startswith("decimal"))]
        fill = MissingValueFill(inputCols=names).fit(df)
        return RoleAssemblerModel(featuresCol=self.getFeaturesCol(),
                                  fitted=json.dumps({"names": names, "fills": fill._get_fitted(), "vectors": self.getOrDefault(self.vectorCols)}))


class RoleAssemblerModel(Model, HasFeaturesCol, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, featuresCol="features", fitted="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        """Names of the first positions of the vector; the positions of vector columns follow."""
        return self._get_fitted()["names"]

    def _transform(self, df: DataFrame) -> DataFrame:
        fit = self._get_fitted()
        filled = df.withColumns({c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")),
                                               F.lit(v)) for c, v in fit["fills"].items()})
        return VectorAssembler(inputCols=fit["names"] + fit.get("vectors", []), outputCol=self.getFeaturesCol()).transform(filled)


def column_role_pipeline(onehot_cols: Sequence[str] = (), target_cols: Sequence[str] = (),
                         label_col: str = "label", exclude_cols: Sequence[str] = (),
                         mode_impute_cols: Sequence[str] = (), constant_impute_cols: Sequence[str] = (),
                         drop_after: Sequence[str] = (), features_col: str = "features", sparse: bool = False) -> Pipeline:
    """Route columns to imputers / encoders, optionally drop encoded columns,
    and assemble the rest (numeric, not excluded) into ``features``.

    With ``sparse`` the one-hot columns become positions of a sparse vector
    after the named features, whatever the number of categories, and encoded
    names in ``drop_after`` get no position."""
    stages = []
    if mode_impute_cols:
        stages.append(SentinelImputer(inputCols=list(mode_impute_cols), strategy="most_frequent"))
    if constant_impute_cols:
        stages.append(SentinelImputer(inputCols=list(constant_impute_cols), strategy="constant"))
    if onehot_cols and sparse:
        stages.append(SparseOneHotEncoder(inputCols=list(onehot_cols), outputCol=SPARSE_COL, dropNames=list(drop_after)))
    elif onehot_cols:
        stages.append(NamedOneHotEncoder(inputCols=list(onehot_cols)))
    if target_cols:
        stages.append(SmoothedTargetEncoder(inputCols=list(target_cols), labelCol=label_col))
    if drop_after:
        stages.append(DropColumns(inputCols=list(drop_after)))
    stages.append(RoleAssembler(excludeCols=list(exclude_cols) + [label_col], featuresCol=features_col,
                                vectorCols=[SPARSE_COL] if onehot_cols and sparse else []))
    return Pipeline(stages=stages)


def fit_transform_split(df: DataFrame, pipeline: Pipeline, label: str, key: str, test_size: float = 0.2,
                        seed: int = 42):
    """Stratified split, fit on the training part only, transform both parts."""
    return fit_transform_parts(stratified_split(df, label, key, test_size, seed), pipeline)


def fit_transform_parts(parts: DataFrame, pipeline: Pipeline):
    """``fit_transform_split`` of rows that carry their ``split``."""
    train = parts.where(F.col("split") == "train").drop("split")
    valid = parts.where(F.col("split") == "test").drop("split")
    model = pipeline.fit(train)
    return model, model.transform(train), model.transform(valid)


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "score") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


# ------------------------------------------------------------------ naive baseline

def naive_baseline_log_loss(df: DataFrame, label: str, fold: str = "fold", eps: float = ev.EPS) -> DataFrame:
    """Per fold: predict the other folds' label mean; log loss in closed form
    from per-fold counts (k rows)."""
    f = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("s"))
    tot = f.agg(F.sum("n").alias("N"), F.sum("s").alias("S")).first()
    m = (F.lit(tot["S"]) - F.col("s")) / (F.lit(tot["N"]) - F.col("n"))
    p = F.least(F.greatest(m, F.lit(eps)), F.lit(1 - eps))
    loss = -(F.col("s") * F.log(p) + (F.col("n") - F.col("s")) * F.log(1 - p)) / F.col("n")
    return f.select(fold, m.alias("train_mean"), loss.alias("log_loss"))


# ------------------------------------------------------------------ boosted trees with early stopping

@dataclass
class BoostResult:
    model: GBTClassificationModel
    best_round: int                # number of trees kept
    curve: list = field(default_factory=list)   # (round, train_loss, valid_loss)


def boosted_tree_classifier(features_col="features", label="label", max_iter=100, step_size=0.1, max_depth=5,
                            subsampling_rate=1.0, min_instances=1, min_info_gain=0.0, seed=42) -> GBTClassifier:
    return GBTClassifier(featuresCol=features_col, labelCol=label, maxIter=max_iter, stepSize=step_size,
                         maxDepth=max_depth, subsamplingRate=subsampling_rate, minInstancesPerNode=min_instances,
                         minInfoGain=min_info_gain, seed=seed, lossType="logistic")


def best_round_with_patience(valid_losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: stop once ``patience`` rounds pass without a new best."""
    best_i, best = 0, float("inf")
    for i, v in enumerate(valid_losses):
        if v < best:
            best_i, best = i, v
        elif i - best_i >= patience:
            break
    return best_i + 1


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees; nothing is fitted again."""
    jvm = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    kind = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(kind.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    all_trees, all_weights = jvm.trees(), jvm.treeWeights()
    for i in range(n):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    cut = GBTClassificationModel(kind.classification.GBTClassificationModel(jvm.uid(), trees, weights, jvm.numFeatures(),
                                                                           jvm.numClasses()))
    return model._copyValues(cut)


ROWS_PER_TASK = 2_000_000        # rows of one training task, where the cores do not ask for more tasks
LEAST_TASK_ROWS = 50_000         # a boosting task of fewer rows takes longer to start than to run


def training_tasks(spark, rows: int, least_rows: int = 0) -> int:
    """Tasks of a pass over ``rows`` training rows: at most two a core and one per ``least_rows`` rows, or more where
    one would hold over ``ROWS_PER_TASK`` rows."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    if least_rows:
        tasks = min(tasks, max(1, -(-rows // least_rows)))
    return max(tasks, -(-rows // ROWS_PER_TASK))


def training_partitions(df: DataFrame, least_rows: int = 0) -> DataFrame:
    """``df`` in at most ``training_tasks`` partitions.

    Every level of every tree shuffles the node statistics of each partition,
    whatever rows it holds, so a table of many small files would shuffle far
    more than its rows need."""
    return df.coalesce(training_tasks(df.sparkSession, df.count(), least_rows))


def train_with_early_stopping(train: DataFrame, valid: DataFrame, gbt: GBTClassifier, patience: int = 50) -> BoostResult:
    """Boost until ``patience`` rounds pass without a new best validation loss,
    and keep the trees of the best round (Spark's logistic loss is twice the
    log loss). Spark cannot continue a fit, so the allowed rounds start at ten
    times the patience and double while the rule has not stopped yet, up to
    maxIter; the last fit is cut to its best round, never fitted again."""
    rounds = min(gbt.getMaxIter(), 10 * patience)
    train = training_partitions(train, LEAST_TASK_ROWS)
    while True:
        full = gbt.copy({gbt.maxIter: rounds}).fit(train)
        va = [x / 2 for x in full.evaluateEachIteration(valid)]
        best = best_round_with_patience(va, patience)
        if rounds >= gbt.getMaxIter() or best + patience <= rounds:
            break
        rounds = min(gbt.getMaxIter(), 2 * rounds)
    tr = [x / 2 for x in full.evaluateEachIteration(train)]
    seen = min(rounds, best + patience)
    return BoostResult(first_trees(full, best), best, [(i + 1, tr[i], va[i]) for i in range(seen)])


def learning_curve(spark, result: BoostResult) -> DataFrame:
    return spark.createDataFrame(result.curve, "round int, train_log_loss double, valid_log_loss double") \
        .withColumn("best_round", F.lit(result.best_round))


def model_metrics(model, df: DataFrame, label: str) -> dict:
    scored = positive_probability(model.transform(df)).select(F.col(label).alias("label"), "score")
    return {"log_loss": ev.log_loss(scored).first()[0], "average_precision": ev.average_precision(scored).first()[0]}


def feature_set_experiments(spark, df: DataFrame, sets: Mapping[str, Sequence[str]], label: str, key: str,
                            make_pipeline, gbt: GBTClassifier, patience: int = 50) -> DataFrame:
    """Same learner on several column sets: (set, n_features, rounds, log_loss, ap).

    The input with its split and each set's vectors are written, as every fit
    and evaluation reads them again and each task of a boosting round carries
    the plan behind its rows. While the tasks of one fit are few for the cores,
    several sets run at once (up to three tasks a core together); a set's
    vectors are removed when it is done."""
    base = work_dir(spark, "experiments")

    def saved(part, name):
        part.write.parquet(f"{base}/{name}")
        return spark.read.schema(part.schema).parquet(f"{base}/{name}")
    wanted = saved(df.select(*dict.fromkeys([key, label, *(c for cols in sets.values() for c in cols)])), "wanted")
    rows = saved(stratified_split(wanted, label, key), "rows")

    def run(numbered):
        i, (name, cols) = numbered
        pm, *parts = fit_transform_parts(rows.select(key, label, *cols, "split"), make_pipeline(cols))
        tr, va = (saved(part.select(key, label, "features"), f"{i}/{to}") for part, to in zip(parts, ("train", "valid")))
        res = train_with_early_stopping(tr, va, gbt.copy({gbt.labelCol: label}), patience)
        m = model_metrics(res.model, va, label)
        remove_folder(spark, f"{base}/{i}")
        return name, len(pm.stages[-1].feature_names()), res.best_round, float(m["log_loss"]), float(m["average_precision"])
    at_once = 3 * spark.sparkContext.defaultParallelism // training_tasks(spark, rows.count(), LEAST_TASK_ROWS)
    with ThreadPool(max(1, min(len(sets), at_once))) as pool:
        found = pool.map(inheritable_thread_target(spark)(run), enumerate(sets.items()), chunksize=1)
    remove_folder(spark, base)
    return spark.createDataFrame(found, "feature_set string, n_features int, rounds int, log_loss double, "
                                       "average_precision double")


def refit_full(df: DataFrame, pipeline: Pipeline, gbt: GBTClassifier, rounds: int) -> PipelineModel:
    """Refit preprocessing and model on train+validation with the chosen round
    count (the true number of trees, not the zero-based best index)."""
    return Pipeline(stages=list(pipeline.getStages()) + [gbt.copy({gbt.maxIter: rounds})]).fit(df)


# ------------------------------------------------------------------ leaderboard

def default_classifiers(label: str, seed: int = 42) -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(labelCol=label, maxIter=50),
        "decision_tree": DecisionTreeClassifier(labelCol=label, maxDepth=5, seed=seed),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=30, maxDepth=5, seed=seed),
        "gradient_boosted_trees": GBTClassifier(labelCol=label, maxIter=20, seed=seed),
        "naive_bayes": NaiveBayes(labelCol=label, modelType="gaussian"),
        "linear_svc": LinearSVC(labelCol=label, maxIter=50),
    }


def out_of_fold_predictions(df: DataFrame, label: str, key: str, pipeline: Pipeline, models: Mapping[str, Estimator],
                            k: int = 3, seed: int = 42) -> DataFrame:
    """One written table ``(key, label, model, fold, score, prediction)``: every
    row scored by every model in the one fold where neither the model nor the
    preprocessing has seen it. The preprocessing is fitted once per fold.
    ``score`` orders the rows (probability, or the margin where there is none)."""
    spark = df.sparkSession
    base = work_dir(spark, "out-of-fold")
    stratified_folds(df, label, key, k, seed).write.parquet(f"{base}/rows")
    folded, table = spark.read.parquet(f"{base}/rows"), f"{base}/predictions"
    for i in range(k):
        train, valid = (folded.where(c).drop("fold") for c in (F.col("fold") != i, F.col("fold") == i))
        fitted = pipeline.fit(train)
        train, valid = (fitted.transform(p).select(key, label, "features").persist(StorageLevel.MEMORY_AND_DISK) for p in (train, valid))
        for name, est in models.items():
            scored = est.fit(train).transform(valid)
            out = "probability" if "probability" in scored.columns else "rawPrediction"
            scored.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), F.lit(name).alias("model"), F.lit(i).alias("fold"),
                          vector_to_array(out)[1].alias("score"), F.col("prediction").cast("int").alias("prediction")).write.mode("append").parquet(table)
        train.unpersist()
        valid.unpersist()
    return spark.read.parquet(table)


def model_leaderboard(spark, df: DataFrame, label: str, key: str, pipeline: Pipeline, sample_frac: float = 0.2, k: int = 3,
                      seed: int = 42, models: Mapping[str, Estimator] | None = None) -> DataFrame:
    """Several classifiers, k-fold cross-validation on a hash sample: one row
    per model with accuracy, AUC, recall, precision, F1, kappa and MCC (mean
    over the folds), best AUC first."""
    from ..operators.relational import sample_fraction
    sample = sample_fraction(df, sample_frac, key, seed) if sample_frac < 1 else df
    table = out_of_fold_predictions(sample, label, key, pipeline, models or default_classifiers(label, seed), k, seed)
    return ev.prediction_metrics(table).orderBy(F.desc("auc"), "model")
