"""Feature attribution and selection.

``tree_contributions`` gives exact path-dependent Shapley contributions
(Lundberg et al., 2018) for a Spark GBT model, in log-odds units, so that
``base_value + sum(contributions) = log-odds of the model's probability``.

The value of a set of known features at a leaf is the leaf's prediction times,
per path feature, "row meets its conditions" (known) or the share of training
rows that do (unknown). Averaging over all feature orders is an integral of a
polynomial in one variable, so a Gauss-Legendre sum of half the path's length is
exact. The driver only reads the leaves' paths (trees x leaves, size-checked)
and broadcasts them; the sums run inside ``mapInPandas`` with numpy, once per
pattern of met conditions for short paths, per row for long ones.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import work_dir
from .ranking import _held_ranks, exact_quantiles, with_global_rank
from .relational import hash_unit


@dataclass
class Leaf:
    conds: list            # (feature, threshold, goes_left) along the path
    feats: list            # distinct features on the path
    shares: np.ndarray     # per path feature: share of training rows meeting its conditions
    value: float


PATTERN_TABLE_FEATURES = 8      # up to so many path features, all 2^d patterns are tabulated in the task


# ------------------------------------------------------------------ one leaf

def leaf_contributions(met: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Contributions of a leaf's path features, one row per row of ``met``
    (1 where the row meets every condition on that feature)."""
    n, d = met.shape
    out = np.zeros((n, d))
    if d == 0:
        return out
    nodes, weights = np.polynomial.legendre.leggauss((d + 1) // 2)     # exact up to degree d - 1
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = t * met + (1 - t) * shares
        before, after = np.ones((n, d)), np.ones((n, d))
        before[:, 1:] = np.cumprod(factor[:, :-1], axis=1)
        after[:, :-1] = np.cumprod(factor[:, :0:-1], axis=1)[:, ::-1]
        out += w * before * after
    return out * (met - shares) * value


def pattern_table(leaf: Leaf) -> np.ndarray | None:
    """Contributions for every pattern of met conditions, or None for a long path."""
    d = len(leaf.feats)
    if d > PATTERN_TABLE_FEATURES:
        return None
    met = (np.arange(2 ** d)[:, None] >> np.arange(d)) & 1
    return leaf_contributions(met.astype(np.float64), leaf.shares, leaf.value)


# ------------------------------------------------------------------ model extraction

def gbt_trees(model: GBTClassificationModel):
    """Trees as node dicts, read from the model's saved files (small)."""
    spark = SparkSession.getActiveSession()
    path = work_dir(spark, "model")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees = {}
    for r in rows:
        cover = r["impurityStats"][0] if r["impurityStats"] else float(r["rawCount"])
        thr = r["split"]["leftCategoriesOrThreshold"]
        trees.setdefault(r["treeID"], {})[r["id"]] = dict(
            left=r["leftChild"], right=r["rightChild"], feature=r["split"]["featureIndex"],
            threshold=thr[0] if thr else None, value=r["prediction"], cover=cover)
    return [trees[k] for k in sorted(trees)], list(model.treeWeights)


def compile_leaves(tree: dict) -> tuple[list[Leaf], float]:
    """Leaf paths of one tree and its cover-weighted mean prediction."""
    leaves, root = [], 0
    expected = 0.0
    stack = [(root, [], 1.0)]
    total = tree[root]["cover"]
    while stack:
        nid, conds, _ = stack.pop()
        node = tree[nid]
        if node["left"] < 0:
            feats, zs = [], []
            for f, _, _, ratio in conds:
                if f in feats:
                    zs[feats.index(f)] *= ratio
                else:
                    feats.append(f)
                    zs.append(ratio)
            leaves.append(Leaf([(f, t, left) for f, t, left, _ in conds], feats, np.array(zs), node["value"]))
            expected += node["cover"] / total * node["value"]
            continue
        for child, left in ((node["left"], True), (node["right"], False)):
            ratio = tree[child]["cover"] / node["cover"] if node["cover"] else 0.0
            stack.append((child, conds + [(node["feature"], node["threshold"], left, ratio)], 0))
    return leaves, expected


def _score_block(X: np.ndarray, compiled, tables, weights, n_features: int):
    n = X.shape[0]
    phi = np.zeros((n, n_features))
    margin = np.zeros(n)
    for (leaves, _), per_leaf, w in zip(compiled, tables, weights):
        for leaf, table in zip(leaves, per_leaf):
            ok = {}
            for f, t, left in leaf.conds:
                c = X[:, f] <= t if left else X[:, f] > t
                ok[f] = ok[f] & c if f in ok else c
            reach = np.ones(n, dtype=bool)
            for f in leaf.feats:
                reach &= ok[f]
            if table is None:
                vals = leaf_contributions(np.stack([ok[f] for f in leaf.feats], axis=1).astype(np.float64), leaf.shares,
                                          leaf.value)
            else:
                pattern = np.zeros(n, dtype=np.int64)
                for k, f in enumerate(leaf.feats):
                    pattern |= ok[f].astype(np.int64) << k
                vals = table[pattern]           # (n, d)
            for k, f in enumerate(leaf.feats):
                phi[:, f] += w * vals[:, k]
            margin += w * leaf.value * reach
    return phi, margin


def tree_contributions(model: GBTClassificationModel, df: DataFrame, features_col: str = "features",
                       keep: Sequence[str] = (), max_model_bytes: int = 256 << 20) -> DataFrame:
    """Per row: ``contributions`` (array, one per feature, log-odds units),
    ``base_value`` and ``margin`` (log-odds), plus the ``keep`` columns. A model
    whose leaf paths exceed ``max_model_bytes`` is refused, as they are broadcast."""
    trees, weights = gbt_trees(model)
    compiled = [compile_leaves(t) for t in trees]
    # Spark's logistic GBT: probability = 1 / (1 + exp(-2 F)); log-odds = 2 F
    weights2 = [2.0 * w for w in weights]
    base = float(sum(w * e for (_, e), w in zip(compiled, weights2)))
    n_feat = model.numFeatures
    size = len(pickle.dumps(compiled))
    if size > max_model_bytes:
        raise ValueError(f"the model's leaf paths take {size} bytes, more than {max_model_bytes}")
    shared = df.sparkSession.sparkContext.broadcast(compiled)
    keep = list(keep)
    src = df.select(*keep, vector_to_array(F.col(features_col)).alias("_x"))
    schema = T.StructType([f for f in src.schema.fields if f.name in keep] + [
        T.StructField("contributions", T.ArrayType(T.DoubleType())), T.StructField("base_value", T.DoubleType()),
        T.StructField("margin", T.DoubleType())])

    def run(batches):
        leaves = shared.value
        tables = [[pattern_table(leaf) for leaf in tree] for tree, _ in leaves]
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["_x"].to_numpy()).astype(np.float64)
            phi, margin = _score_block(X, leaves, tables, weights2, n_feat)
            out = pdf[keep].copy()
            out["contributions"] = list(phi)
            out["base_value"] = base
            out["margin"] = margin
            yield out
    return src.mapInPandas(run, schema)


def contributions_long(contrib: DataFrame, feature_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    names = F.array(*[F.lit(n) for n in feature_names])
    return contrib.select(*keep, F.posexplode("contributions").alias("pos", "contribution")).select(
        *keep, names[F.col("pos")].alias("feature"), "contribution")


def feature_importance_rank(long: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, descending, with a 0-based rank
    (the window runs over one row per feature)."""
    imp = long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return imp.withColumn("rank", F.row_number().over(w) - 1)


def top_and_tail(ranking: DataFrame, n: int = 10, order: str = "rank") -> DataFrame:
    """First ``n`` and last ``n`` rows of a ranking; a row in both ends appears twice."""
    head = ranking.orderBy(F.asc(order)).limit(n)
    tail = ranking.orderBy(F.desc(order)).limit(n)
    return head.union(tail)


def contribution_summary(values: DataFrame, long: DataFrame, key: Sequence[str], bins: int = 10,
                         probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Data of the summary plot: per feature and bucket of the feature's value,
    the count, the range of values, and mean, extremes and exact quantiles
    (``q25``, ...) of the contributions.

    Buckets hold equal numbers of rows: a value belongs to bucket
    ``floor(bins * rows below it / rows)``, so equal values stay together and
    empty buckets are absent. Missing values are a bucket of their own (NULL).
    Values are counted before they are ranked, and the bucket borders are one
    small row per feature.
    """
    feats = [c for c in values.columns if c not in key]
    vlong = values.select(*key, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                             F.col(f"`{c}`").cast("double").alias("value"))
                                                    for c in feats])).alias("r")).select(*key, "r.*")
    vlong = vlong.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    held = _held_ranks(vlong.where("value is not null").groupBy("feature", F.col("value").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), ["feature"])
    starts = held.groupBy("feature", F.floor(F.col("_from") * F.lit(bins) / F.col("_size")).cast("int").alias("bin")).agg(F.min("_v").alias("low"))
    borders = starts.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("low", "bin"))).alias("borders"))   # one row per feature
    j = long.join(vlong, on=[*key, "feature"]).join(F.broadcast(borders), on="feature", how="left")
    reached = F.filter("borders", lambda b: b["low"] <= F.col("value"))
    j = j.select("feature", F.when(F.col("value").isNotNull(), F.element_at(reached, -1)["bin"]).alias("bin"), "value", "contribution")
    stats = j.groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("value_min"), F.max("value").alias("value_max"),
        F.avg("contribution").alias("mean_contribution"), F.min("contribution").alias("min_contribution"), F.max("contribution").alias("max_contribution"))
    q = exact_quantiles(j, "contribution", list(probs), groups=["feature", "bin"])
    q = q.groupBy("feature", "bin").agg(*[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(f"q{round(100 * p):02d}") for p in probs])
    q = q.withColumnsRenamed({"feature": "_f", "bin": "_b"})
    return stats.join(q, (F.col("feature") == F.col("_f")) & F.col("bin").eqNullSafe(F.col("_b")), "left").drop("_f", "_b")


# ------------------------------------------------------------------ selection

def backward_selection(spark, train: DataFrame, valid: DataFrame, features: Sequence[str], label: str,
                       reduce_to: int, make_gbt, drop_per_round: int = 1, sample_frac: float = 1.0,
                       key: str | None = None, patience: int | None = None) -> DataFrame:
    """Refit, rank features by mean |contribution| on (a hash sample of) the
    validation rows, drop the least important ``drop_per_round``, repeat until
    ``reduce_to`` remain. With ``patience`` every fit stops early on the
    validation rows. One row per round: features, trees kept, validation log
    loss (of the fit with early stopping) and what was dropped."""
    from ..modeling.training import train_with_early_stopping
    selected = list(features)
    rows, rnd = [], 0
    while len(selected) > reduce_to:
        asm = VectorAssembler(inputCols=selected, outputCol="_f", handleInvalid="keep")
        tr, va = asm.transform(train), asm.transform(valid)
        gbt = make_gbt().setFeaturesCol("_f").setLabelCol(label)
        if patience is not None:
            fit = train_with_early_stopping(tr, va, gbt, patience)
            model, trees, loss = fit.model, fit.best_round, fit.curve[fit.best_round - 1][2]
        else:
            model, loss = gbt.fit(tr), None
            trees = model.getNumTrees
        if sample_frac < 1.0 and key is not None:
            va = va.where(hash_unit(key, 42) < sample_frac)
        contrib = tree_contributions(model, va, "_f")
        rank = feature_importance_rank(contributions_long(contrib, selected)).collect()  # one row per feature
        order = [r["feature"] for r in sorted(rank, key=lambda r: r["rank"])]
        k = min(drop_per_round, len(selected) - reduce_to)
        dropped = order[-k:]
        rows.append((rnd, len(selected), trees, loss, ",".join(dropped)))
        selected = [c for c in selected if c not in dropped]
        rnd += 1
    rows.append((rnd, len(selected), None, None, ""))
    return spark.createDataFrame(rows, "round int, n_features int, trees int, log_loss double, dropped string") \
        .withColumn("selected", F.lit(",".join(selected)))


def _shadow_moves(n: int, features: Sequence[str], seed: int) -> list[tuple[int, int]]:
    """For each feature a bijection r -> (a * r + b) mod n of the row ranks."""
    rng = np.random.default_rng(seed)
    moves = []
    for _ in features:
        a = int(rng.integers(1, max(n, 2)))
        while math.gcd(a, n) != 1:
            a += 1
        moves.append((a, int(rng.integers(0, max(n, 1)))))
    return moves


SHADOW_BLOCK_ROWS = 100_000     # ranks put together by one task, and rows sent on at once
LEAST_BLOCK_ROWS = 5_000        # smaller blocks are not worth a task, where the cores ask for more


def _shadow(ranked: DataFrame, n: int, features: Sequence[str], seed: int) -> DataFrame:
    """``ranked`` (features, a row rank ``_r`` from 0 and other numbers) with a
    shuffled copy ``shadow_<f>`` of each feature: the value of f at rank r goes
    to rank (a_f * r + b_f) mod n. The ranks are cut into blocks. A task sends
    each block one row per feature with the places and values it has for it,
    12 bytes a value, and the rows themselves; the block is filled in place, so
    nothing is grouped by rank, joined or sorted."""
    cores = ranked.sparkSession.sparkContext.defaultParallelism
    block = -(-n // max(1, -(-n // SHADOW_BLOCK_ROWS), min(2 * cores, n // LEAST_BLOCK_ROWS)))
    moves = _shadow_moves(n, features, seed)
    rest = [c for c in ranked.columns if c != "_r" and c not in features]
    own = [*rest, *features]
    width, first = len(own), len(rest)
    rows = ranked.select("_r", *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(own)])

    def dealt(ranks, values):
        """Per block the rows' places and values, one line each."""
        for i, (a, b) in enumerate([(1, 0), *moves]):
            to = (ranks * a + b) % n
            goes = to // block
            low = goes.min()
            sizes = np.bincount(goes - low)
            order = np.argsort((goes - low).astype(np.uint16) if len(sizes) < 2 ** 16 else goes, kind="stable")     # 16 bits: a radix sort
            places, v = (to - goes * block).astype(np.int32)[order], (values if i == 0 else values[:, first + i - 1])[order]
            ends = np.cumsum(sizes)
            for k in np.flatnonzero(sizes):
                lo, hi = ends[k] - sizes[k], ends[k]
                yield int(low + k), i, places[lo:hi].tobytes(), v[lo:hi].tobytes()

    def deal(batches):
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= SHADOW_BLOCK_ROWS:
                yield lines(held)
                held, size = [], 0
        if size:
            yield lines(held)

    def lines(held):
        pdf = pd.concat(held)
        return pd.DataFrame(dealt(pdf["_r"].to_numpy(np.int64), pdf.iloc[:, 1:].to_numpy(np.float64)), columns=["k", "i", "place", "v"])

    def fill(key, pdf):
        low = key[0] * block
        out = np.full((min(block, n - low), width + len(moves)), np.nan)
        for i, place, v in zip(pdf["i"], pdf["place"], pdf["v"]):
            at, v = np.frombuffer(place, np.int32), np.frombuffer(v, np.float64)
            if i == 0:
                out[at, :width] = v.reshape(-1, width)
            else:
                out[at, width + i - 1] = v
        full = pd.DataFrame(out, columns=[f"c{j}" for j in range(out.shape[1])])
        full.insert(0, "_r", low + np.arange(len(out)))
        return full
    columns = [f"c{j} double" for j in range(width + len(moves))]
    filled = rows.mapInPandas(deal, "k long, i int, place binary, v binary").groupBy("k").applyInPandas(fill, ", ".join(["_r long", *columns]))
    types = dict(ranked.dtypes)
    back = {c: F.col(f"c{j}").cast(types[c]).alias(c) for j, c in enumerate(own)}         # pandas' NaN comes back as null
    return filled.select(*[back.get(c, c) for c in ranked.columns],
                         *[F.col(f"c{width + i}").alias(f"shadow_{f}") for i, f in enumerate(features)])


def _tail(hits: int, trials: int, upper: bool) -> float:
    """P(X >= hits) or P(X <= hits) of a fair binomial."""
    ks = range(hits, trials + 1) if upper else range(hits + 1)
    return sum(math.comb(trials, k) for k in ks) / 2 ** trials


def shadow_feature_selection(spark, df: DataFrame, features: Sequence[str], label: str, key: str,
                             iterations: int = 20, alpha: float = 0.05, seed: int = 42, trees: int = 50, depth: int = 5,
                             importances: DataFrame | None = None) -> DataFrame:
    """All-relevant selection: features that beat the best shuffled copy.

    Every iteration fits a random forest on the features still in play and
    their shuffled copies; a feature scores a hit when its importance exceeds
    every copy's. After each iteration a feature is ``confirmed`` when it has
    significantly more hits than half its trials and ``rejected`` when it has
    significantly fewer (binomial tails at ``alpha / 2`` each, divided by the
    number of features); rejected features leave, with their copies, before the
    next fit. What is undecided in the end is ``tentative``.

    Columns ``feature, hits, trials, p_confirm, p_reject, decision, keep,
    rank``: rank 1 for confirmed features, 2 for tentative ones, rejected ones
    follow by when they left (last first). With ``importances`` (feature,
    importance, rank from ``feature_importance_rank``) the result is merged
    with the contributions by a full outer join, as columns ``importance`` and
    ``contribution_rank``.
    """
    level = alpha / 2 / max(1, len(features))
    if 0.5 ** iterations > level:
        raise ValueError(f"{iterations} iterations cannot decide {len(features)} features at alpha {alpha}")
    ranked = with_global_rank(df.select(key, label, *features).withColumn("_u", hash_unit(key, seed)), [F.col("_u"), F.col(key)], "_r")
    ranked = ranked.drop("_u").fillna(-1.0, subset=list(features)).persist(StorageLevel.MEMORY_AND_DISK)     # read by every iteration
    n = ranked.count()
    hits, left_at, state = {f: 0 for f in features}, {}, {f: "tentative" for f in features}
    ran = 0
    for it in range(iterations):
        if not n or "tentative" not in state.values():
            break
        active = [f for f in features if state[f] != "rejected"]
        data = _shadow(ranked.select("_r", label, *active), n, active, seed + it)
        cols = active + [f"shadow_{f}" for f in active]
        data = VectorAssembler(inputCols=cols, outputCol="_f", handleInvalid="keep").transform(data)
        data = data.select(label, "_f").persist(StorageLevel.MEMORY_AND_DISK)      # a fit reads its rows four times
        imp = RandomForestClassifier(featuresCol="_f", labelCol=label, maxDepth=depth, numTrees=trees,
                                     seed=seed + it).fit(data).featureImportances.toArray()
        data.unpersist()
        ran, best_shadow = it + 1, imp[len(active):].max()
        for i, f in enumerate(active):
            hits[f] += int(imp[i] > best_shadow)
            if state[f] == "tentative":
                if _tail(hits[f], ran, True) <= level:
                    state[f] = "confirmed"
                elif _tail(hits[f], ran, False) <= level:
                    state[f], left_at[f] = "rejected", ran
    ranked.unpersist()
    rows = []
    for f in features:
        trials = left_at.get(f, ran)
        rank = {"confirmed": 1, "tentative": 2}.get(state[f], 3 + sum(t > left_at.get(f, 0) for t in set(left_at.values())))
        rows.append((f, hits[f], trials, float(_tail(hits[f], trials, True)), float(_tail(hits[f], trials, False)), state[f], state[f] == "confirmed", rank))
    out = spark.createDataFrame(rows, "feature string, hits int, trials int, p_confirm double, p_reject double, decision string, keep boolean, rank int")
    if importances is not None:
        out = out.join(importances.select("feature", "importance", F.col("rank").alias("contribution_rank")), "feature", "full_outer")
    return out
