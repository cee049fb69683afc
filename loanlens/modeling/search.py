"""Guided hyper-parameter search over boosted trees.

The driver keeps one row per trial (parameters, loss, rounds). A trial is one
boosted fit per fold, each a distributed Spark ML job that stops by patience
on its fold's validation rows; folds run at the same time. The preprocessing
is fitted once per fold on the fold's training rows, so no encoder sees a
validation label, and its output is written once for all trials.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.splits import stratified_folds
from ..sources.tables import work_dir

SEARCH_SPACE = {  # name: (low, high, kind)
    "maxDepth": (2, 10, "int"),
    "stepSize": (0.05, 0.3, "log"),
    "minInfoGain": (0.0, 0.5, "float"),
    "minInstancesPerNode": (1, 10, "int"),
    "subsamplingRate": (0.5, 1.0, "float"),
}


@dataclass(frozen=True)
class Dimension:
    """One parameter, searched on a unit interval."""

    low: float
    high: float
    kind: str            # "int", "float" or "log"

    def value(self, u: float):
        if self.kind == "log":
            return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        if self.kind == "int":      # every whole number owns an equal part of the interval
            return min(int(self.high), int(self.low) + int(u * (self.high - self.low + 1)))
        return self.low + u * (self.high - self.low)

    def unit(self, value: float) -> float:
        if self.kind == "log":
            return (math.log(value) - math.log(self.low)) / (math.log(self.high) - math.log(self.low))
        if self.kind == "int":
            return (value - self.low + 0.5) / (self.high - self.low + 1)
        return (value - self.low) / (self.high - self.low)


class Density:
    """Mixture of normals around the seen points of the unit interval, cut to it, and one uniform part."""

    def __init__(self, points: Sequence[float]):
        self.points = sorted(points)
        # a kernel reaches to the farther neighbour (a lone point over half the interval), but not below 1 / (2 n + 2)
        least = 1 / (len(self.points) + 1) if len(self.points) < 100 else 0.01
        gaps = [b - a for a, b in zip(self.points, self.points[1:])]
        around = [max([0.0, *gaps[max(0, i - 1):i + 1]]) for i in range(len(self.points))] if gaps else [0.5] * len(self.points)
        self.widths = [min(0.5, max(least / 2, g)) for g in around]

    def draw(self, rng: random.Random) -> float:
        i = rng.randrange(len(self.points) + 1)
        if i == len(self.points):
            return rng.random()
        while True:
            u = rng.gauss(self.points[i], self.widths[i])
            if 0.0 <= u < 1.0:
                return u

    def at(self, u: float) -> float:
        total = 1.0
        for p, w in zip(self.points, self.widths):
            inside = 0.5 * (math.erf((1 - p) / w / math.sqrt(2)) - math.erf(-p / w / math.sqrt(2)))
            total += math.exp(-0.5 * ((u - p) / w) ** 2) / (w * math.sqrt(2 * math.pi) * inside)
        return total / (len(self.points) + 1)


class DensityRatioSampler:
    """Draws where good trials are dense and bad ones rare.

    The first ``startup`` trials are uniform. Then the best ``good_share`` of
    the trials are the good ones; ``candidates`` points are drawn from their
    density and the one with the highest ratio of good to bad density is tried.
    """

    def __init__(self, space: Mapping[str, tuple] = SEARCH_SPACE, seed: int = 0, startup: int = 10, good_share: float = 0.1, candidates: int = 24):
        self.space = {name: Dimension(*spec) for name, spec in space.items()}
        self.rng = random.Random(seed)
        self.startup, self.good_share, self.candidates = startup, good_share, candidates

    def draw(self, history: Sequence[tuple[Mapping, float]]) -> tuple[dict, bool]:
        """(parameters, whether they were guided) given all (parameters, loss) so far."""
        if len(history) < max(2, self.startup):
            return {name: d.value(self.rng.random()) for name, d in self.space.items()}, False
        ranked = sorted(range(len(history)), key=lambda i: (history[i][1], i))
        n_good = max(1, math.ceil(self.good_share * len(history)))
        good, bad = ranked[:n_good], ranked[n_good:]
        out = {}
        for name, d in self.space.items():
            likely = Density([d.unit(history[i][0][name]) for i in good])
            unlikely = Density([d.unit(history[i][0][name]) for i in bad])
            tried = [likely.draw(self.rng) for _ in range(self.candidates)]
            out[name] = d.value(max(tried, key=lambda u: likely.at(u) / unlikely.at(u)))
        return out, True


def _prepared_folds(df: DataFrame, label: str, key: str, pipeline: Pipeline, k: int, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """(train, valid) of each fold, transformed by the pipeline fitted on its training rows and written once."""
    spark = df.sparkSession
    base = work_dir(spark, "search-folds")
    stratified_folds(df, label, key, k, seed).write.parquet(f"{base}/rows")
    folded, out = spark.read.parquet(f"{base}/rows"), []
    for i in range(k):
        train = folded.where(F.col("fold") != i).drop("fold")
        model = pipeline.fit(train)
        parts = []
        for name, part in (("train", train), ("valid", folded.where(F.col("fold") == i).drop("fold"))):
            model.transform(part).select(key, label, "features").write.parquet(f"{base}/{name}{i}")
            parts.append(spark.read.parquet(f"{base}/{name}{i}"))
        out.append((parts[0], parts[1]))
    return out


def hyperparameter_search(spark, df: DataFrame, label: str, key: str, pipeline: Pipeline, n_trials: int = 100, k: int = 5,
                          max_iter: int = 1000, patience: int = 20, seed: int = 0, startup: int = 10, parallelism: int = 4,
                          space: Mapping[str, tuple] = SEARCH_SPACE) -> DataFrame:
    """Guided search over the tree parameters Spark shares with the reference's
    tuner, scored by the mean validation log loss of ``k`` stratified folds.

    Every fold's fit stops once ``patience`` rounds pass without a new best
    loss. One row per trial: ``trial, guided, params`` (JSON), ``cv_log_loss``,
    ``rounds`` (mean rounds kept, the rounds to refit with) and ``fold_rounds``.
    """
    from .training import train_with_early_stopping
    folds = _prepared_folds(df, label, key, pipeline, k, seed)
    sampler = DensityRatioSampler(space, seed, startup)
    history, rows = [], []
    with ThreadPool(min(parallelism, k)) as pool:
        for trial in range(n_trials):
            params, guided = sampler.draw(history)
            gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, seed=42, **params)
            fits = pool.map(inheritable_thread_target(spark)(lambda part: train_with_early_stopping(*part, gbt.copy(), patience)), folds, chunksize=1)
            loss = sum(fit.curve[fit.best_round - 1][2] for fit in fits) / k
            history.append((params, loss))
            rounds = [fit.best_round for fit in fits]
            rows.append((trial, guided, json.dumps(params), float(loss), sum(rounds) / k, rounds))
    return spark.createDataFrame(rows, "trial int, guided boolean, params string, cv_log_loss double, rounds double, fold_rounds array<int>")
