"""Record validation and batch / stream scoring agree."""
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from loanlens.modeling import training as tr
from loanlens.roles import REQUEST_FIELDS
from loanlens.streaming import scoring as sc


def _requests(spark, n=60):
    rows = []
    for i in range(n):
        rec = {}
        for name, t in REQUEST_FIELDS:
            rec[name] = str(i) if t == "int" else (f"{i * 1.5}" if t == "double" else ("A" if i % 2 else "B"))
        rows.append(rec)
    rows[3]["AMT_CREDIT"] = "lots"           # mistyped amount
    rows[4]["NAME_PORTFOLIO"] = None         # missing field
    return spark.createDataFrame(rows, sc.text_request_schema())


def test_bad_records_are_quarantined_not_failed(spark):
    good, bad = sc.validate_records(_requests(spark))
    errs = {r["SK_ID_PREV"]: r["errors"] for r in bad.collect()}
    assert errs == {"3": "AMT_CREDIT", "4": "NAME_PORTFOLIO"}
    assert good.count() == 58 and dict(good.dtypes)["AMT_CREDIT"] == "double"


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    good, _ = sc.validate_records(_requests(spark))
    train = good.withColumn("y", (F.col("SK_ID_PREV") % 3 == 0).cast("int"))
    pipe = Pipeline(stages=list(tr.column_role_pipeline(onehot_cols=["NAME_PORTFOLIO"], label_col="y",
                                                         exclude_cols=["SK_ID_PREV"]).getStages())
                    + [tr.boosted_tree_classifier(label="y", max_iter=4, max_depth=2)])
    model = pipe.fit(train)
    src = str(tmp_path / "in")
    _requests(spark).repartition(3).write.parquet(src)
    q = sc.score_stream(spark, src, model, str(tmp_path / "out"), str(tmp_path / "ck"),
                        quarantine_dir=str(tmp_path / "bad"))
    q.awaitTermination()
    streamed = {r["SK_ID_PREV"]: (r["refused"], r["probability"])
                for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r["SK_ID_PREV"]: (r["refused"], r["probability"]) for r in sc.score_batch(good, model).collect()}
    assert streamed == batch
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
