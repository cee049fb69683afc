"""Evaluation and threshold economics: hand cases and brute force."""
import math

import numpy as np
import pytest

from loanlens.operators import evaluate as ev

S = "label int, score double"


def _df(spark, labels, scores):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(labels, scores)], S)


def test_threshold_equal_predicts_zero(spark):
    df = _df(spark, [1], [0.35]).withColumn("prediction", ev.apply_threshold("score", 0.35))
    assert df.collect()[0]["prediction"] == 0


def test_one_class_predicted_has_all_cells_and_zero_precision(spark):
    df = _df(spark, [0, 1, 1], [0.0, 0.0, 0.0]).withColumn("prediction", ev.apply_threshold("score", 0.5))
    cm = ev.confusion_matrix(df).collect()[0].asDict()
    assert cm == {"tn": 1, "fp": 0, "fn": 2, "tp": 0}
    rep = {r["class"]: r for r in ev.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1_score"] == 0.0


def test_log_loss_extremes_finite(spark):
    v = ev.log_loss(_df(spark, [0, 1], [1.0, 0.0])).collect()[0][0]
    assert math.isfinite(v) and v > 30


def _brute_profit(labels, scores, t):
    pred = scores > t
    tn = np.sum((labels == 0) & ~pred)
    fp = np.sum((labels == 0) & pred)
    fn = np.sum((labels == 1) & ~pred)
    tp = np.sum((labels == 1) & pred)
    return tn * 0.2 + fp * -0.2 + fn * -0.8 + tp * 0.0


def test_profit_sweep_matches_brute_force_on_grid_points(spark):
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 500)
    scores = np.concatenate([rng.integers(0, 100, 250) * 0.01, rng.random(250)])  # many exact grid ties
    rows = ev.profit_sweep(_df(spark, labels, scores)).collect()
    assert len(rows) == 100
    for r in rows:
        t = r["threshold"]
        assert r["profit"] == pytest.approx(_brute_profit(labels, scores, t))
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == 500


def test_best_threshold_takes_first_of_ties(spark):
    sweep = spark.createDataFrame([(0.1, 5.0), (0.2, 7.0), (0.3, 7.0), (0.5, 1.0)], "threshold double, profit double")
    r = ev.best_threshold(sweep, base=0.5).collect()[0]
    assert r["best_threshold"] == 0.2 and r["base_profit"] == 1.0 and r["profit_increase_pct"] == 600.0


def test_average_precision_matches_step_sum(spark):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 300)
    scores = rng.integers(0, 20, 300) / 20.0
    got = ev.average_precision(_df(spark, labels, scores)).collect()[0][0]
    # step sum over distinct thresholds, descending
    P = labels.sum()
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        sel = scores >= t
        tp = labels[sel].sum()
        r, p = tp / P, tp / sel.sum()
        ap += (r - prev_r) * p
        prev_r = r
    assert 0.0 <= got <= 1.0 and got == pytest.approx(ap)


def test_gain_monotone_and_ends_at_one(spark):
    rng = np.random.default_rng(3)
    df = _df(spark, rng.integers(0, 2, 200), rng.random(200))
    g = ev.cumulative_gain(df).orderBy("population_share").collect()
    vals = [r["gain_1"] for r in g]
    assert all(a <= b for a, b in zip(vals, vals[1:])) and vals[-1] == pytest.approx(1.0)


def test_cost_ratio_threshold():
    assert ev.cost_ratio_threshold(1, 4) == 0.2


def test_best_threshold_profit_dominates_sweep(spark):
    rng = np.random.default_rng(9)
    df = _df(spark, rng.integers(0, 2, 400), rng.random(400))
    sweep = ev.profit_sweep(df)
    best = ev.best_threshold(sweep, base=0.2).collect()[0]
    profits = [r["profit"] for r in sweep.collect()]
    assert best["best_profit"] == max(profits)


def test_held_out_report_has_all_sections(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.1)], "label int, score double")
    rows = ev.held_out_report(df, 0.5).collect()
    by = {(r["section"], r["name"]): r for r in rows if r["section"] != "curve"}
    assert [by["confusion", c]["value"] for c in ("tn", "fp", "fn", "tp")] == [1, 1, 1, 1]
    assert by["metric", "average_precision"]["value"] == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert by["report", "accuracy"]["precision"] == 0.5 and by["report", "1"]["support"] == 2
    assert sum(r["section"] == "curve" for r in rows) == 4
