"""Early stopping: the kept model is the prefix of the fitted trees, and no more rounds run than the rule needs."""
import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from loanlens.modeling import training as tr


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(400, 3))
    y = (X[:, 0] + rng.normal(0, 1.5, 400) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, X[i]), int(y[i])) for i in range(400)], "k int, a double, b double, c double, y int")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return df.where("k < 300"), df.where("k >= 300")


def _scores(model, df):
    return [r[0] for r in model.transform(df).orderBy("k").select(vector_to_array("probability")[1]).collect()]


def test_first_trees_equal_a_shorter_fit_and_can_be_saved(spark, parts, tmp_path):
    train, valid = parts
    gbt = GBTClassifier(labelCol="y", maxIter=6, maxDepth=2, seed=1)
    cut = tr.first_trees(gbt.fit(train), 3)
    short = gbt.copy({gbt.maxIter: 3}).fit(train)
    assert cut.getNumTrees == 3 and _scores(cut, valid) == pytest.approx(_scores(short, valid))
    cut.write().overwrite().save(str(tmp_path / "m"))
    assert _scores(GBTClassificationModel.load(str(tmp_path / "m")), valid) == pytest.approx(_scores(cut, valid))


def test_patience_bounds_the_rounds(spark, parts):
    train, valid = parts
    gbt = GBTClassifier(labelCol="y", maxIter=200, maxDepth=4, stepSize=0.5, seed=1)
    res = tr.train_with_early_stopping(train, valid, gbt, patience=3)
    assert res.model.getNumTrees == res.best_round
    assert len(res.curve) <= res.best_round + 3 < 200
    losses = [v for _, _, v in res.curve]
    assert res.best_round == 1 + losses.index(min(losses))


# ---------------------------------------------------------------- guided search

def _objective(p):
    """A loss with one narrow valley, as hyper-parameters have."""
    return (p["maxDepth"] - 4) ** 2 / 40 + 3 * abs(p["stepSize"] - 0.09) + (p["minInfoGain"] - 0.1) ** 2 * 4 + abs(p["subsamplingRate"] - 0.85) \
        + (p["minInstancesPerNode"] - 7) ** 2 / 200


def test_guided_draws_beat_random_draws_at_equal_trials():
    from loanlens.modeling.search import DensityRatioSampler

    def best(startup, seed):
        sampler, history = DensityRatioSampler(seed=seed, startup=startup), []
        for _ in range(60):
            p, guided = sampler.draw(history)
            assert guided == (len(history) >= max(2, startup))
            history.append((p, _objective(p)))
        return min(loss for _, loss in history)
    seeds = range(10)
    guided, plain = [best(10, s) for s in seeds], [best(60, s) for s in seeds]
    assert guided[0] < plain[0] and np.mean(guided) < 0.7 * np.mean(plain) and sum(g < r for g, r in zip(guided, plain)) >= 9


def test_search_dimensions_and_densities():
    import random

    from loanlens.modeling.search import SEARCH_SPACE, Density, Dimension
    rng = random.Random(3)
    for low, high, kind in SEARCH_SPACE.values():
        d = Dimension(low, high, kind)
        values = [d.value(rng.random()) for _ in range(500)]
        assert low <= min(values) and max(values) <= high and (kind != "int" or set(values) == set(range(low, high + 1)))
        assert all(d.value(d.unit(v)) == pytest.approx(v) for v in values)
    for points in ([0.2], [0.0, 0.5, 0.99], [0.4] * 5):
        mix = Density(points)
        grid = (np.arange(4000) + 0.5) / 4000
        assert np.mean([mix.at(u) for u in grid]) == pytest.approx(1.0, rel=1e-3)
        assert all(0 <= mix.draw(rng) < 1 for _ in range(200))


def test_search_stops_every_fold_and_keeps_encoders_inside(spark, monkeypatch):
    from loanlens.modeling import stages as stg
    rng = np.random.default_rng(1)
    rows = [(i, f"c{int(rng.integers(0, 4))}", float(x), int(x + rng.normal(0, 1) > 0)) for i, x in enumerate(rng.normal(size=240))]
    df = spark.createDataFrame(rows, "k long, c string, a double, y int")
    seen, plain = [], stg.SmoothedTargetEncoder._fit
    monkeypatch.setattr(stg.SmoothedTargetEncoder, "_fit", lambda self, part: seen.append(part.count()) or plain(self, part))
    pipe = tr.column_role_pipeline(target_cols=["c"], label_col="y", exclude_cols=["k"])
    out = tr.hyperparameter_search(spark, df, "y", "k", pipe, n_trials=3, k=3, max_iter=60, patience=2, startup=2).collect()
    assert seen == [160, 160, 160]                               # once per fold, on its training rows only
    assert [r["trial"] for r in out] == [0, 1, 2] and [r["guided"] for r in out] == [False, False, True]
    for r in out:
        assert len(r["fold_rounds"]) == 3 and r["rounds"] == pytest.approx(np.mean(r["fold_rounds"])) and 0 < r["cv_log_loss"] < 1.5
    assert min(min(r["fold_rounds"]) for r in out) < 58          # patience ended fits before the last round


# ---------------------------------------------------------------- leaderboard

def test_prediction_metrics_match_their_definitions(spark):
    from loanlens.operators import evaluate as ev
    rng = np.random.default_rng(2)
    rows = []
    for m in ("a", "b", "c"):
        for fold in range(3):
            for _ in range(80):
                y = int(rng.random() < 0.3)
                s = round(float(rng.normal(y * (m == "a"), 1)), 1)       # ties
                rows.append((m, fold, y, s, int(s > 0.4)))
    rows += [("a", 0, None, 1.0, 1), ("one class", 0, 1, 0.5, 1), ("one class", 0, 1, 0.1, 0)]
    got = {r["model"]: r for r in ev.prediction_metrics(spark.createDataFrame(rows, "model string, fold int, label int, score double, prediction int")).collect()}
    for m in ("a", "b", "c"):
        each = []
        for fold in range(3):
            y, s, p = (np.array([r[i] for r in rows if r[0] == m and r[1] == fold and r[2] is not None]) for i in (2, 3, 4))
            tp, fp, fn, tn = ((p[y == 1] == 1).sum(), (p[y == 0] == 1).sum(), (p[y == 1] == 0).sum(), (p[y == 0] == 0).sum())
            auc = ((s[y == 1][:, None] > s[y == 0]) + 0.5 * (s[y == 1][:, None] == s[y == 0])).mean()
            n = len(y)
            pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / n ** 2
            mcc = np.corrcoef(y, p)[0, 1]
            each.append(((tp + tn) / n, auc, tp / (tp + fn), tp / (tp + fp), 2 * tp / (2 * tp + fp + fn), ((tp + tn) / n - pe) / (1 - pe), mcc))
        r = got[m]
        assert [r[c] for c in ("accuracy", "auc", "recall", "precision", "f1", "kappa", "mcc")] == pytest.approx(list(np.mean(each, axis=0)))
        assert r["n_rows"] == 240 and r["n_folds"] == 3
    assert got["one class"]["auc"] is None and got["one class"]["mcc"] == 0.0 and got["one class"]["recall"] == 0.5


def test_out_of_fold_predictions_cover_every_row_once(spark):
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(x), int(x + rng.normal(0, 0.5) > 0)) for i, x in enumerate(rng.normal(size=120))], "k long, a double, y int")
    models = {"lr": LogisticRegression(labelCol="y", maxIter=5), "svc": LinearSVC(labelCol="y", maxIter=5)}
    table = tr.out_of_fold_predictions(df, "y", "k", tr.column_role_pipeline(label_col="y", exclude_cols=["k"]), models, k=3)
    assert table.count() == 240 and table.select("key", "model").distinct().count() == 240
    sizes = [r["count"] for r in table.groupBy("fold").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 4
    board = tr.model_leaderboard(spark, df, "y", "k", tr.column_role_pipeline(label_col="y", exclude_cols=["k"]), 1.0, 2, models={"svc": models["svc"], "lr": models["lr"]}).collect()
    assert {r["model"] for r in board} == {"lr", "svc"} and all(r["auc"] > 0.8 and r["mcc"] > 0.4 for r in board)
    assert board[0]["auc"] >= board[1]["auc"]


# ---------------------------------------------------------------- experiments

def test_experiments_split_once_and_boost_on_written_vectors(spark, monkeypatch):
    import os
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b), int(a + b + rng.normal(0, 0.5) > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int").repartition(7)
    splits, trained = [], []
    split, train = tr.stratified_split, tr.train_with_early_stopping
    monkeypatch.setattr(tr, "stratified_split", lambda *a, **k: splits.append(1) or split(*a, **k))
    monkeypatch.setattr(tr, "train_with_early_stopping", lambda *a, **k: trained.append(a[0].inputFiles()) or train(*a, **k))
    gbt = GBTClassifier(labelCol="y", maxIter=5, maxDepth=2, seed=1)
    sets = {"a": ["a"], "both": ["a", "b"], "a again": ["a"]}
    out = tr.feature_set_experiments(spark, df, sets, "y", "k", lambda cols: tr.column_role_pipeline(label_col="y", exclude_cols=["k"]), gbt, 2).collect()
    assert [r["feature_set"] for r in out] == list(sets) and [r["n_features"] for r in out] == [1, 2, 1]
    assert out[0][1:] == out[2][1:] and out[1]["log_loss"] < out[0]["log_loss"]
    assert len(splits) == 1 and len(trained) == 3 and all(trained)      # one split; every fit reads files, not the plan behind them
    assert not any(os.path.exists(f.removeprefix("file:")) for files in trained for f in files)
    _, tr_, va = tr.fit_transform_split(df.select("k", "y", "a", "b"), tr.column_role_pipeline(label_col="y", exclude_cols=["k"]), "y", "k")
    alone = train(tr_, va, gbt, 2)
    assert out[1]["rounds"] == alone.best_round and out[1]["log_loss"] == pytest.approx(tr.model_metrics(alone.model, va, "y")["log_loss"])


def test_boosting_tasks_follow_the_rows(spark, monkeypatch):
    df = spark.range(1000).repartition(100)
    assert tr.training_partitions(df, 400).rdd.getNumPartitions() == min(3, 2 * spark.sparkContext.defaultParallelism)
    assert tr.training_partitions(df, 1).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tr, "ROWS_PER_TASK", 20)
    assert tr.training_partitions(df, 400).rdd.getNumPartitions() == 50


# ---------------------------------------------------------------- the whole fit

def test_boosted_tree_query_runs_the_references_fit(spark, monkeypatch):
    from loanlens.plans import model_catalog as mc
    rng = np.random.default_rng(6)
    rows = [(i, int(x > 0.5), "XNA" if i % 9 == 0 else f"o{i % 3}", f"e{i % 2}", float(x)) for i, x in enumerate(rng.normal(size=200))]
    mart = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, ORGANIZATION_TYPE string, NAME_EDUCATION_TYPE string, AMT double")
    monkeypatch.setattr(mc, "written_mart20", lambda spark, d: mart)
    asked, train = [], tr.train_with_early_stopping

    def short(train_part, valid_part, gbt, patience=50):
        asked.append((gbt.getMaxIter(), patience, gbt.getStepSize(), gbt.getMaxDepth()))
        return train(train_part, valid_part, gbt.copy({gbt.maxIter: 3}), patience)
    monkeypatch.setattr(tr, "train_with_early_stopping", short)
    out = mc.q_gbt(spark, "unused").collect()
    assert asked == [(500, 50, 0.1, 6)] and len(out) == 40 and all(0 < r["score"] < 1 for r in out)


def test_a_fit_that_still_improves_runs_once(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 10), int(i % 10 > 4)) for i in range(100)], "a double, y int")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    fits, plain = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, d: fits.append(self.getMaxIter()) or plain(self, d))
    res = tr.train_with_early_stopping(df, df, GBTClassifier(labelCol="y", maxIter=20, maxDepth=1, stepSize=0.05, seed=1), patience=2)
    assert fits == [20] and res.best_round == 20 and len(res.curve) == 20
