"""What the model queries compute once, and what their joins and tree fits shuffle."""
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loanlens.modeling import training as tr
from loanlens.operators import features as fe
from loanlens.plans import model_catalog as mc
from loanlens.sources import standins

LINE = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string, l_shipdate timestamp_ntz"
ORDER = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
CUSTOMER = "c_custkey bigint, c_acctbal double, c_nationkey int, c_mktsegment string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    day = datetime(2000, 1, 1)
    lines = [(i % 40 if i % 23 else None, i, i % 7 + 1, float(i % 50), i * 1.5, (i % 10) / 100, "O" if i % 2 else "F",
              datetime(2000, 1 + i % 12, 3) if i % 11 else None) for i in range(400)]
    lines += lines[:30]
    orders = [(i, i % 30 if i % 9 else None, "FOP"[i % 3], i * 10.0, day if i % 8 else None, "1-URGENT") for i in range(50)]
    orders += orders[:5]                                        # repeated keys
    spark.createDataFrame(lines, LINE).write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame(orders, ORDER).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(i, float(i * 37 % 90 - 20), i % 25, "ABC"[i % 3]) for i in range(60)], CUSTOMER).write.parquet(f"{d}/customer.parquet")
    return d


@pytest.mark.parametrize("query", [mc.q_missing_fill, mc.q_role_pipeline, mc.q_fit_transform_split])
def test_the_mart_is_computed_once(spark, tables, query):
    out = query(spark, tables)
    assert not [f for f in out.inputFiles() if "lineitem" in f or "orders" in f]
    assert out.select("SK_ID_CURR").distinct().count() == out.count() == 60


def _plain(spark, d, view):
    spec = standins.ALL[view]
    left, right = (standins.read_table(spark, d, t) for t in spec.tables)
    return left.join(right, F.expr(spec.join_on)).selectExpr(*[f"{standins.render(e, 'spark')} AS `{c}`" for c, e in spec.columns])


@pytest.mark.parametrize("view", ["v_inst", "v_cash"])
def test_view_columns_computed_before_the_join_give_the_same_rows(spark, tables, view):
    got, want = standins.load(spark, tables, view), _plain(spark, tables, view)
    assert got.dtypes == want.dtypes and want.count() > 400
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_instalment_join_shuffles_only_what_the_features_need(spark, tables):
    t = standins.LoanTables(spark, tables)
    early, late = fe.installment_features_20(t.inst_derived), fe.installment_features_20(t.inst)
    join = early._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    below = join.split("Relation [")[0]
    assert "_early_Amt_deficit" in below and not re.search(r"[\[ ]l_(partkey|shipdate|discount|extendedprice)#\d+L?[,\]]", below)
    a, b = ({r[0]: r[1:] for r in x.collect()} for x in (early, late))
    assert a.keys() == b.keys() and None not in a
    for k, (days, deficit) in a.items():
        assert days == b[k][0] and deficit == pytest.approx(b[k][1])     # sums differ in the last digits with their order


def test_tree_fits_read_few_partitions(spark, monkeypatch):
    df = spark.range(1000).repartition(100)
    few = 2 * spark.sparkContext.defaultParallelism
    assert tr.training_partitions(df).rdd.getNumPartitions() == few
    assert tr.training_partitions(df).count() == 1000
    monkeypatch.setattr(tr, "ROWS_PER_TASK", 20)
    assert tr.training_partitions(df).rdd.getNumPartitions() == 50      # large parts are not packed into few tasks
