"""Evaluation and threshold economics. Input: ``(label, score)``
rows, optionally with a key.

Curves over the score order (precision/recall, cumulative gain) first collapse
rows to one row per distinct score, then take running sums with
``ranking.running_sums`` (range partitions + prefix offsets), never a
single-partition window. The threshold sweep is one pass: each row is
bucketed by how many grid thresholds lie strictly below its score, and
suffix sums over the 101 buckets give every threshold's confusion counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..roles import INCOME_FN, INCOME_FP, INCOME_TN, INCOME_TP
from .ranking import running_sums

EPS = 2.220446049250313e-16  # float64 machine epsilon: probability clip for log loss


def _count() -> Column:
    return F.count(F.lit(1))


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = EPS) -> DataFrame:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def apply_threshold(score: str | Column, t: float) -> Column:
    """1 when the score is strictly above ``t``, else 0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > F.lit(float(t)), 1).otherwise(0)


def cost_ratio_threshold(cost_false_positive: float, cost_false_negative: float) -> float:
    """Threshold from error costs: predict 1 when p * C01 > (1 - p) * C10."""
    return cost_false_positive / (cost_false_positive + cost_false_negative)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row ``tn, fp, fn, tp``; every cell present (0 when empty)."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows for class 0, class 1, accuracy, macro avg, weighted avg with
    precision, recall, f1 and support; zero divisions give 0."""
    cm = confusion_matrix(df, label, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    cm = cm.select("*", p1.alias("p1"), r1.alias("r1"), p0.alias("p0"), r0.alias("r0"),
                   (tn + fp).alias("s0"), (tp + fn).alias("s1"), n.alias("n"))
    f = lambda p, r: _ratio(2 * F.col(p) * F.col(r), F.col(p) + F.col(r))
    cm = cm.withColumns({"f0": f("p0", "r0"), "f1": f("p1", "r1")})
    acc = _ratio(tn + tp, F.col("n"))
    w = lambda a, b: (F.col(a) * F.col("s0") + F.col(b) * F.col("s1")) / F.col("n")
    def row(name, p, r, f1, support):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f1.alias("f1_score"), support.alias("support"))
    c = F.col
    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("s0")),
        row("1", c("p1"), c("r1"), c("f1"), c("s1")),
        row("accuracy", acc, acc, acc, c("n")),
        row("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, c("n")),
        row("weighted avg", w("p0", "p1"), w("r0", "r1"), w("f0", "f1"), c("n")),
    )
    return cm.select(F.explode(rows).alias("r")).select("r.*")


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("tp_at"), _count().alias("n_at"))


def _totals(cum: DataFrame) -> tuple[int, int]:
    """Positives and rows: the last running sums of the saved score levels, so
    the scored rows are not scanned again."""
    t = cum.agg(F.max("cum_tp_at").alias("P"), F.max("cum_n_at").alias("N")).first()
    return t["P"] or 0, t["N"] or 0


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score t (predict 1 when score >= t): tp, fp,
    precision, recall, and the chance level (share of positives)."""
    g = _by_score(df, label, score)
    cum = running_sums(g, [F.desc("threshold")], ["tp_at", "n_at"])
    P, N = _totals(cum)
    recall = F.col("cum_tp_at") / F.lit(float(P)) if P else F.lit(1.0)
    return cum.select("threshold", F.col("cum_tp_at").alias("tp"),
                      (F.col("cum_n_at") - F.col("cum_tp_at")).alias("fp"),
                      (F.col("cum_tp_at") / F.col("cum_n_at")).alias("precision"), recall.alias("recall"),
                      F.lit(P / N if N else None).cast("double").alias("chance_level"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Step-sum area: sum over distinct scores of (recall gain) x precision."""
    g = _by_score(df, label, score)
    cum = running_sums(g, [F.desc("threshold")], ["tp_at", "n_at"])
    P, _ = _totals(cum)
    if not P:
        return df.sparkSession.createDataFrame([(0.0,)], "average_precision double")
    return cum.agg(F.sum(F.col("tp_at") / F.lit(float(P)) * (F.col("cum_tp_at") / F.col("cum_n_at")))
                   .alias("average_precision"))


def cumulative_gain(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, rows taken from the top: population share and the
    share of positives (``gain_1``) and of negatives (``gain_0``) found."""
    g = _by_score(df, label, score).withColumn("neg_at", F.col("n_at") - F.col("tp_at"))
    cum = running_sums(g, [F.desc("threshold")], ["tp_at", "n_at", "neg_at"])
    P, N = _totals(cum)
    return cum.select("threshold", (F.col("cum_n_at") / F.lit(float(N))).alias("population_share"),
                      (F.col("cum_tp_at") / F.lit(float(P or 1))).alias("gain_1"),
                      (F.col("cum_neg_at") / F.lit(float((N - P) or 1))).alias("gain_0"))


def lift_at_fraction(df: DataFrame, fraction: float = 0.2, label: str = "label", score: str = "score") -> DataFrame:
    """Share of positives found in the top ``fraction`` of rows by score, at the
    last whole score level that fits in the fraction."""
    gain = cumulative_gain(df, label, score)
    return (gain.where(F.col("population_share") <= F.lit(float(fraction)))
            .agg(F.max("population_share").alias("population_share"), F.max("gain_1").alias("gain_1"))
            .select(F.lit(float(fraction)).alias("fraction"),
                    F.coalesce("population_share", F.lit(0.0)).alias("population_share"),
                    F.coalesce("gain_1", F.lit(0.0)).alias("gain_1")))


def _profit(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return (tn * F.lit(INCOME_TN) + fp * F.lit(INCOME_FP) + fn * F.lit(INCOME_FN) + tp * F.lit(INCOME_TP))


def profit_at_threshold(df: DataFrame, t: float, label: str = "label", score: str = "score") -> DataFrame:
    """Sum of confusion cells times income: TN 0.2, FP -0.2, FN -0.8, TP 0."""
    cm = confusion_matrix(df.withColumn("_pred", apply_threshold(score, t)), label, "_pred")
    return cm.select(F.lit(float(t)).alias("threshold"), "tn", "fp", "fn", "tp",
                     _profit(*(F.col(c) for c in ("tn", "fp", "fn", "tp"))).alias("profit"))


def _thresholds_below(score: Column, steps: int) -> Column:
    """How many grid thresholds k * (1/steps), k = 0..steps-1 (the values
    ``arange(0, 1, 1/steps)`` yields), lie strictly below the score. Every k
    up to floor(score*steps) - 2 is below and none past +1 is, so only three
    candidates are compared exactly."""
    step = 1.0 / steps
    f = F.floor(score * F.lit(float(steps)))
    sure = F.greatest(F.lit(0), F.least(f - 1, F.lit(steps)))

    def hit(k: Column) -> Column:
        return F.when((k >= 0) & (k < steps) & (k * F.lit(step) < score), 1).otherwise(0)
    return F.coalesce(sure + hit(f - 1) + hit(f) + hit(f + 1), F.lit(0))


def profit_sweep(df: DataFrame, steps: int = 100, label: str = "label", score: str = "score") -> DataFrame:
    """Profit for thresholds 0, 1/steps, ... (steps-1)/steps in one scan."""
    s = F.col(score).cast("double")
    y = F.col(label)
    b = _thresholds_below(s, steps).cast("int").alias("b")
    counts = df.groupBy(b).agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    spark = df.sparkSession
    grid = spark.range(steps + 1).select(F.col("id").cast("int").alias("b"))
    full = grid.join(counts, on="b", how="left").fillna(0, subset=["pos", "neg"])
    suffix = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)  # 101 rows
    full = full.withColumns({"pos_ge": F.sum("pos").over(suffix), "neg_ge": F.sum("neg").over(suffix)})
    tot = full.agg(F.sum("pos").alias("P"), F.sum("neg").alias("Nn")).first()
    P, Nn = tot["P"], tot["Nn"]
    # threshold k predicts 1 for rows with more than k grid points below: bucket b >= k + 1
    out = full.where(F.col("b") >= 1).select(
        (F.col("b") - 1).alias("k"), F.col("pos_ge").alias("tp"), F.col("neg_ge").alias("fp"))
    out = out.select(((F.col("k") * F.lit(1.0 / steps))).alias("threshold"),
                     (F.lit(Nn) - F.col("fp")).alias("tn"), "fp", (F.lit(P) - F.col("tp")).alias("fn"), "tp")
    return out.withColumn("profit", _profit(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def best_threshold(sweep: DataFrame, base: float = 0.5) -> DataFrame:
    """First threshold with the highest profit, its profit, the profit at
    ``base`` and the gain over it in percent (one aggregate over the sweep)."""
    t, p = F.col("threshold"), F.col("profit")
    out = sweep.agg(F.max_by(t, F.struct(p, -t)).alias("best_threshold"), F.max(p).alias("best_profit"),
                    F.max(F.when(F.abs(t - F.lit(base)) < 1e-9, p)).alias("base_profit"))
    return out.select("*", F.lit(float(base)).alias("base_threshold"),
                      (F.col("best_profit") * 100 / F.col("base_profit") - 100).alias("profit_increase_pct"))


def decision_certainty(score: str | Column, t: float) -> Column:
    """Probability rescaled so the threshold is 0% and the ends are 100%
    certainty of the decision taken."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > F.lit(t), (s - F.lit(t)) / F.lit(1 - t)).otherwise((F.lit(t) - s) / F.lit(t)) * 100


def held_out_report(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Everything a held-out run prints, in one long table: ``section`` is
    'metric' (log loss, average precision), 'confusion' (cells at
    ``threshold``), 'report' (per class and averages) or 'curve' (one row per
    distinct score). Columns that a section lacks are NULL."""
    decided = df.withColumn("_pred", apply_threshold(score, threshold))
    cells = confusion_matrix(decided, label, "_pred").unpivot([], ["tn", "fp", "fn", "tp"], "name", "value")
    text = lambda s: F.lit(s).alias("section")
    parts = [
        log_loss(df, label, score).select(text("metric"), F.lit("log_loss").alias("name"), F.col("log_loss").alias("value")),
        average_precision(df, label, score).select(text("metric"), F.lit("average_precision").alias("name"),
                                                   F.col("average_precision").alias("value")),
        cells.select(text("confusion"), "name", F.lit(float(threshold)).alias("threshold"), F.col("value").cast("double")),
        classification_report(decided, label, "_pred").select(
            text("report"), F.col("class").alias("name"), F.lit(float(threshold)).alias("threshold"), "precision",
            "recall", "f1_score", F.col("support").cast("bigint")),
        precision_recall_curve(df, label, score).select(text("curve"), F.lit("score").alias("name"), "threshold",
                                                        "precision", "recall"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("section", "name", "threshold", "precision", "recall", "f1_score", "support", "value")


def prediction_metrics(predictions: DataFrame, by: str = "model", fold: str = "fold", label: str = "label", score: str = "score",
                       pred: str = "prediction") -> DataFrame:
    """One row per model of a prediction table (model, fold, label, score,
    prediction): rows, folds and the mean over the folds of accuracy, AUC,
    recall, precision, F1, Cohen's kappa and Matthews' correlation.

    Rows are counted by (model, fold, score) first; running sums over those
    levels give every fold's rank sum, ties at half. A zero division gives 0; a
    fold without both classes has no AUC.
    """
    y, p = F.col(label) == 1, F.col(pred) == 1
    levels = predictions.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(by).alias("model"), F.col(fold).alias("fold"), F.col(score).alias("_s")).agg(
        F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg"), F.count_if(y & p).alias("_tp"), F.count_if(~y & p).alias("_fp"))
    cum = running_sums(levels, [F.col("model"), F.col("fold"), F.col("_s")], ["_pos"], prefix="_cum")
    wide = "decimal(38,0)"
    # twice the number of (positive, negative) pairs in the wrong order: positives at or below a negative's score, ties once
    below = F.sum(F.col("_neg").cast(wide) * (2 * F.col("_cum_pos") - F.col("_pos")))
    g = cum.groupBy("model", "fold").agg(
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_q"), F.sum("_tp").alias("tp"), F.sum("_fp").alias("fp"), below.alias("_below"),
        F.min(F.col("_cum_pos") - F.col("_pos")).alias("_before"))     # positives of the groups sorted before this one
    g = g.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_q") - F.col("fp"), "n": (F.col("_p") + F.col("_q")).cast("double")})
    tn, fp, fn, tp, n = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp", "n"))
    wrong = (F.col("_below") - 2 * F.col("_before").cast(wide) * F.col("_q")).cast("double") / 2
    recall, precision = _ratio(tp, tp + fn), _ratio(tp, tp + fp)
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    folds = g.select(
        "model", "fold", "n", ((tp + tn) / n).alias("accuracy"),
        F.when((F.col("_p") > 0) & (F.col("_q") > 0), 1 - wrong / (F.col("_p").cast("double") * F.col("_q"))).alias("auc"),
        recall.alias("recall"), precision.alias("precision"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio((tp + tn) / n - chance, 1 - chance).alias("kappa"),
        _ratio(tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)).alias("mcc"))
    return folds.groupBy("model").agg(F.sum("n").cast("bigint").alias("n_rows"), _count().alias("n_folds"),
                                      *[F.avg(c).alias(c) for c in ("accuracy", "auc", "recall", "precision", "f1", "kappa", "mcc")])
