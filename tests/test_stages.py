"""Fitted preprocessing stages and pipelines."""
import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from loanlens.modeling import stages as stg
from loanlens.modeling import training as tr


def _te_rows():
    rows = []
    for i in range(40):
        rows.append(("a", i % 2))          # 40 rows, mean 0.5
    for i in range(5):
        rows.append(("b", 1))              # 5 rows, mean 1
    rows.append(("c", 1))                  # seen once -> prior
    rows.append((None, 0))
    return rows


def test_target_encoder_smoothing_unseen_and_single(spark):
    df = spark.createDataFrame(_te_rows(), "cat string, y int")
    model = stg.SmoothedTargetEncoder(inputCols=["cat"], labelCol="y").fit(df)
    prior = sum(y for _, y in _te_rows()) / len(_te_rows())
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "cat string")
    got = [r["cat"] for r in model.transform(test).collect()]

    def blend(n, m):
        w = 1 / (1 + math.exp(-(n - 20) / 10))
        return prior * (1 - w) + m * w
    assert got[0] == pytest.approx(blend(40, 0.5))
    assert got[1] == pytest.approx(blend(5, 1.0))
    assert got[2] == pytest.approx(prior)            # seen once
    assert got[3] == pytest.approx(prior)            # unseen
    assert got[4] == pytest.approx(prior)            # missing seen once -> prior


def test_target_encoder_ignores_validation_labels(spark):
    train = spark.createDataFrame(_te_rows(), "cat string, y int")
    valid = spark.createDataFrame([("a", 1), ("b", 0)], "cat string, y int")
    flipped = valid.withColumn("y", 1 - F.col("y"))
    m = stg.SmoothedTargetEncoder(inputCols=["cat"], labelCol="y").fit(train)
    assert m.transform(valid).select("cat").collect() == m.transform(flipped).select("cat").collect()


def test_one_hot_binary_unknown_and_missing(spark):
    train = spark.createDataFrame([("N", "x"), ("Y", "y"), ("Y", None)], "flag string, c string")
    m = stg.NamedOneHotEncoder(inputCols=["flag", "c"]).fit(train)
    out = m.transform(spark.createDataFrame([("Y", "q"), ("N", None)], "flag string, c string"))
    assert sorted(out.columns) == ["c_nan", "c_x", "c_y", "flag_Y"]
    rows = out.collect()
    assert rows[0]["flag_Y"] == 1.0 and rows[0]["c_x"] == 0.0 and rows[0]["c_y"] == 0.0 and rows[0]["c_nan"] == 0.0
    assert rows[1]["c_nan"] == 1.0


def test_mode_imputer_replaces_sentinel(spark):
    df = spark.createDataFrame([("M",), ("F",), ("F",), ("XNA",), ("M",)], "g string")
    m = stg.SentinelImputer(inputCols=["g"]).fit(df)   # tie M/F 2:2 -> smallest
    assert [r["g"] for r in m.transform(df).collect()] == ["M", "F", "F", "F", "M"]


def test_gbt_fits_after_null_fill_and_pipeline_round_trips(spark, tmp_path):
    rows = [(i, float(i % 5) if i % 4 else None, "a" if i % 3 else "b", int(i % 5 > 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, x double, c string, y int")
    pipe = Pipeline(stages=list(tr.column_role_pipeline(onehot_cols=["c"], label_col="y",
                                                         exclude_cols=["k"]).getStages())
                    + [tr.boosted_tree_classifier(label="y", max_iter=5, max_depth=2)])
    model = pipe.fit(df)
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r["probability"][1] for r in model.transform(df).orderBy("k").collect()]
    b = [r["probability"][1] for r in again.transform(df).orderBy("k").collect()]
    assert a == b


def test_patience_rule():
    losses = [5, 4, 3, 3.5, 3.6, 3.7, 2.0, 4, 4, 4]
    assert tr.best_round_with_patience(losses, patience=3) == 3
    assert tr.best_round_with_patience(losses, patience=4) == 7


def test_naive_baseline_closed_form(spark):
    df = spark.createDataFrame([(f, y) for f in range(2) for y in ([0, 0, 1, 1] if f == 0 else [0, 1, 1, 1])],
                               "fold int, y int")
    out = {r["fold"]: r for r in tr.naive_baseline_log_loss(df, "y").collect()}
    m0 = 0.75  # fold 0 predicts fold 1's mean
    assert out[0]["train_mean"] == m0
    assert out[0]["log_loss"] == pytest.approx(-(2 * math.log(m0) + 2 * math.log(1 - m0)) / 4)


def test_gbt_beats_naive_baseline_on_planted_signal(spark):
    import numpy as np
    from loanlens.operators import evaluate as ev
    from loanlens.operators.splits import stratified_split
    rng = np.random.default_rng(5)
    x = rng.normal(size=2000)
    y = (rng.random(2000) < 1 / (1 + np.exp(-3 * x))).astype(int)
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(x, y))], "k long, x double, y int")
    parts = stratified_split(df, "y", "k", 0.25)
    train, valid = parts.where("split = 'train'"), parts.where("split = 'test'")
    pipe = Pipeline(stages=list(tr.column_role_pipeline(label_col="y", exclude_cols=["k"]).getStages())
                    + [tr.boosted_tree_classifier(label="y", max_iter=20, max_depth=2)])
    scored = tr.positive_probability(pipe.fit(train.drop("split")).transform(valid.drop("split")))
    model_ll = ev.log_loss(scored.select(F.col("y").alias("label"), "score")).first()[0]
    p = train.agg(F.avg("y")).first()[0]
    naive_ll = ev.log_loss(valid.select(F.col("y").alias("label"), F.lit(p).alias("score"))).first()[0]
    assert model_ll < naive_ll - 0.05


def test_target_encoder_joins_a_table_of_many_categories(spark):
    from loanlens.modeling.stages import SmoothedTargetEncoder, SmoothedTargetModel
    from loanlens.sources.tables import work_dir
    df = spark.range(200_000).select(F.concat(F.lit("c"), (F.col("id") % 60_000).cast("string")).alias("a"), F.lit("x").alias("b"),
                                     (F.col("id") % 2).cast("double").alias("label"))
    model = SmoothedTargetEncoder(inputCols=["a", "b"], labelCol="label").fit(df)
    assert model.has_table() and "mapping" not in model._get_fitted()
    path = work_dir(spark, "encoder-test")
    model.write().overwrite().save(path)
    unseen = spark.createDataFrame([("new", None, 1.0)], "a string, b string, label double")
    out = SmoothedTargetModel.load(path).transform(df.limit(3).unionByName(unseen))
    rows = out.collect()
    assert out.columns == df.columns and len(rows) == 4
    assert 0.5 in [r["a"] for r in rows] and all(0.0 <= r["a"] <= 1.0 for r in rows)


def _drop_folder(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def test_saved_models_hold_their_tables(spark, tmp_path):
    """10,000 categories: saved, scratch removed, loaded and scored equally, alone and inside a pipeline."""
    from pyspark.ml import Pipeline, PipelineModel
    df = spark.range(30_000).select(F.concat(F.lit("c"), (F.col("id") % 10_000).cast("string")).alias("a"),
                                    F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("b"), (F.col("id") % 2).cast("double").alias("label"), "id")
    model = Pipeline(stages=[stg.SmoothedTargetEncoder(inputCols=["a"], labelCol="label"), stg.SparseOneHotEncoder(inputCols=["b"], outputCol="v")]).fit(df)
    unseen = spark.createDataFrame([("new", "new", 1.0, -1), (None, None, 0.0, -2)], "a string, b string, label double, id long")
    every = df.unionByName(unseen)
    want = {r["id"]: tuple(r) for r in model.transform(every).collect()}
    model.write().overwrite().save(str(tmp_path / "m"))
    for stage in model.stages:
        _drop_folder(spark, stage.getOrDefault(stage.tablePath))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    got = {r["id"]: tuple(r) for r in loaded.transform(every).collect()}
    assert got == want and got[-1][0] == 0.5 and got[-1][-1].numNonzeros() == 0
    loaded.write().overwrite().save(str(tmp_path / "again"))
    assert {r["id"]: tuple(r) for r in PipelineModel.load(str(tmp_path / "again")).transform(every).collect()} == want


def test_sparse_one_hot_equals_the_named_columns(spark):
    rows = [(i, ["x", "y", None, "nan?"][i % 4], ["N", "Y"][i % 2], "only") for i in range(40)]
    df = spark.createDataFrame(rows, "k long, `a.b` string, flag string, one string")
    cols, drop = ["a.b", "flag", "one"], ["a.b_y"]
    named = stg.NamedOneHotEncoder(inputCols=cols).fit(df)
    sparse = stg.SparseOneHotEncoder(inputCols=cols, outputCol="v", dropNames=drop).fit(df)
    names = [r["name"] for r in sparse.feature_table().orderBy("idx").collect()]
    assert names == [n for n in named.output_names() if n not in drop] and sparse.size() == len(names)
    new = df.unionByName(spark.createDataFrame([(99, "unseen", "Q", None)], df.schema))
    want = {r["k"]: [r[n] for n in names] for r in named.transform(new).collect()}
    got = sparse.transform(new)
    assert got.columns == ["k", "v"] and {r["k"]: list(r["v"].toArray()) for r in got.collect()} == want
    assert stg.SparseOneHotEncoder(inputCols=["flag"], dropBinary=False).fit(df).size() == 2
    assert stg.SparseOneHotEncoder(inputCols=["flag"]).fit(df.where("k < 0")).size() == 0


def test_sparse_one_hot_of_200_000_categories(spark):
    """Fitted and applied without a cap, a Python worker or a category on the driver; a hot category is a third of the rows."""
    df = spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("c"))
    model = stg.SparseOneHotEncoder(inputCols=["c"], outputCol="v").fit(df)
    assert model.size() == 200_001 and model.feature_table().count() == 200_001
    out = model.transform(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" not in plan
    ends = out.where("id in (0, 3, 1)").collect()
    assert all(r["v"].size == 200_001 and r["v"].numNonzeros() == 1 for r in ends)
    at = {r["id"]: int(r["v"].indices[0]) for r in ends}
    assert at[0] == at[3] == 200_000 and at[1] != at[0]          # 'hot' sorts after every 'c...'


def test_pipeline_with_sparse_one_hot(spark, tmp_path):
    """200,000 categories through the whole pipeline: fitted, saved, loaded, and equal to the named form on a small table."""
    rows = [(i, float(i % 7) if i % 5 else None, ["x", "y", None][i % 3], ["N", "Y"][i % 2], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, a double, c string, flag string, label int")
    kw = dict(onehot_cols=["c", "flag"], label_col="label", exclude_cols=["k"], drop_after=["c_nan"])
    named, sparse = tr.column_role_pipeline(**kw).fit(df), tr.column_role_pipeline(**kw, sparse=True).fit(df)
    names = sparse.stages[-1].feature_names() + [r["name"] for r in sparse.stages[0].feature_table().orderBy("idx").collect()]
    order = [named.stages[-1].feature_names().index(n) for n in names]
    want = {r["k"]: [r["features"].toArray()[i] for i in order] for r in named.transform(df).collect()}
    assert {r["k"]: list(r["features"].toArray()) for r in sparse.transform(df).collect()} == want
    big = spark.range(200_000).select("id", (F.col("id") % 9).cast("double").alias("a"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"),
                                      (F.col("id") % 2).cast("int").alias("label"))
    model = tr.column_role_pipeline(onehot_cols=["c"], label_col="label", exclude_cols=["id"], sparse=True).fit(big)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(big.where("id < 3")).select("features").collect()
    assert {r["features"].size for r in out} == {200_001}
