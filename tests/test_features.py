"""One test per trap of the feature aggregates (hand-made rows)."""
import math

import pytest
from pyspark.sql import functions as F

from loanlens.functions.columns import nan_to_null
from loanlens.operators import features as fe

BAL = "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"


def _bal(spark, rows):
    return fe.balance_status_features(spark.createDataFrame(rows, BAL))


def test_balance_all_closed_loan_is_absent(spark):
    out = _bal(spark, [(1, -1, "C"), (1, -2, "C")]).collect()
    assert out == []


def test_balance_all_x_gives_row_of_nulls(spark):
    out = _bal(spark, [(2, -1, "X")]).collect()
    assert len(out) == 1
    r = out[0]
    assert r.STATUS_last is None and r.STATUS_mean is None and r.STATUS_std is None and r.STATUS_max is None


def test_balance_single_month_zero(spark):
    r = _bal(spark, [(3, 0, "1")]).collect()[0]
    assert (r.STATUS_last, r.STATUS_mean, r.STATUS_std, r.STATUS_max) == (1.0, 1.0, None, 1.0)


def test_balance_closed_now(spark):
    r = _bal(spark, [(4, 0, "C"), (4, -1, "2")]).collect()[0]
    assert r.STATUS_last == -1.0 and r.STATUS_mean == 2.0


def test_balance_repeated_month_zero_fans_out(spark):
    out = _bal(spark, [(5, 0, "1"), (5, 0, "3"), (5, -1, "2")]).collect()
    assert sorted(r.STATUS_last for r in out) == [1.0, 3.0]


def test_latest_status_uses_latest_month_and_keeps_x(spark):
    df = spark.createDataFrame([(1, -1, "C"), (1, -2, "C"), (2, -3, "1"), (2, -1, "X")], BAL)
    rows = {r.SK_ID_BUREAU: r for r in fe.balance_latest_status(df).collect()}
    assert rows[1].STATUS_latest == -1.0 and rows[1].MONTHS_BALANCE_latest == -1
    assert rows[2].STATUS_latest is None and rows[2].STATUS_mean == 1.0


def test_null_group_key_dropped(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (7, 2, 3.0)],
                               "SK_ID_CURR long, SK_ID_PREV long, CNT_INSTALMENT double")
    out = fe.cash_features_20(df).collect()
    assert [r.SK_ID_CURR for r in out] == [7]


def test_all_null_amounts_mean_null_flag_zero(spark):
    df = spark.createDataFrame([(1, 10, None, None, None, -1, "Completed")],
                               "SK_ID_CURR long, SK_ID_PREV long, CNT_INSTALMENT double, SK_DPD long, "
                               "SK_DPD_DEF long, MONTHS_BALANCE int, NAME_CONTRACT_STATUS string")
    r = fe.cash_features(df).collect()[0]
    assert r.cash_SK_DPD_mean is None and r.cash_Has_overdue_sum == 0


def test_no_active_status_count_is_null(spark):
    df = spark.createDataFrame([(1, 10, 1.0, 0, 0, -1, "Completed"), (2, 11, 1.0, 0, 0, -1, "Active")],
                               "SK_ID_CURR long, SK_ID_PREV long, CNT_INSTALMENT double, SK_DPD long, "
                               "SK_DPD_DEF long, MONTHS_BALANCE int, NAME_CONTRACT_STATUS string")
    rows = {r.SK_ID_CURR: r.cash_Status_Active_count for r in fe.cash_features(df).collect()}
    assert rows == {1: None, 2: 1}


def test_nan_amount_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(1, float("nan")), (1, 1.0)], "SK_ID_CURR long, x double"))
    assert df.groupBy("SK_ID_CURR").agg(F.avg("x")).collect()[0][1] == 1.0


def test_absent_category_counts_zero(spark):
    bur = spark.createDataFrame([(1, 1, "Closed", "Consumer credit")],
                                "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string")
    out = fe.category_counts(bur, "SK_ID_CURR", "CREDIT_ACTIVE", vocab=fe.BUREAU_CREDIT_ACTIVE).collect()[0]
    assert out["CREDIT_ACTIVE_Bad_debt"] == 0 and out["CREDIT_ACTIVE_Closed"] == 1


def test_infrequent_tie_keeps_later_category(spark):
    # 8 categories; counts a:5 b:4 c:3 d:3 e:2 f:2 g:1 h:1; cap 7 keeps 6
    rows, k = [], 0
    for cat, n in zip("abcdefgh", [5, 4, 3, 3, 2, 2, 1, 1]):
        for _ in range(n):
            rows.append((k % 3, cat))
            k += 1
    df = spark.createDataFrame(rows, "SK_ID_CURR long, T string")
    vocab = fe.learn_vocabulary(df, "T", max_categories=7)
    assert vocab == ["a", "b", "d", "c", "f", "e"]
    wide = fe.category_counts(df, "SK_ID_CURR", "T", max_categories=7)
    tot = wide.agg(*[F.sum(c).alias(c) for c in wide.columns if c != "SK_ID_CURR"]).collect()[0].asDict()
    assert tot["T_infrequent"] == 2 and sum(tot.values()) == len(rows)


def test_hyphen_column_names(spark):
    prev = spark.createDataFrame([(1, 1, "x-sell")], "SK_ID_CURR long, SK_ID_PREV long, NAME_PRODUCT_TYPE string")
    out = prev.groupBy("SK_ID_CURR").agg(*fe.one_hot_counts("NAME_PRODUCT_TYPE", ["x-sell"], "prev_"))
    assert out.select("`prev_NAME_PRODUCT_TYPE_x-sell_sum`").collect()[0][0] == 1


def test_std_single_row_null(spark):
    df = spark.createDataFrame([(1, 1, 0, "2")], "SK_ID_CURR long, SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    r = fe.balance_status_features(df.drop("SK_ID_CURR")).collect()[0]
    assert r.STATUS_std is None and not (isinstance(r.STATUS_mean, float) and math.isnan(r.STATUS_mean))


def test_sign_flip_keeps_sentinel(spark):
    from loanlens.functions.columns import flip_sign_columns
    df = spark.createDataFrame([(1, 365243), (2, -100)], "k long, DAYS_EMPLOYED long")
    out = {r.k: r.DAYS_EMPLOYED for r in flip_sign_columns(df, ["DAYS_EMPLOYED"]).collect()}
    assert out == {1: -365243, 2: 100}


def test_balance_features_repeat_month_zero_rows_and_count_hot_loans(spark):
    from loanlens.operators import features as fe
    rows = [(1, 0, "0"), (1, 0, "2"), (1, 0, "2"), (1, -1, "X"), (1, -2, "C"),      # three month-0 rows
            (2, -1, "C"),                                                           # closed, no month 0: absent
            (3, 0, "C"), (4, -1, "X"), (5, 0, "X"), (6, -1, "3")]
    df = spark.createDataFrame(rows, "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string")
    got = sorted([tuple(r) for r in fe.balance_status_features(df).collect()], key=repr)
    third = 2 / math.sqrt(3)
    want = sorted([(1, 0.0, 4 / 3, third, 2.0), (1, 2.0, 4 / 3, third, 2.0), (1, 2.0, 4 / 3, third, 2.0),
                   (3, -1.0, None, None, None), (4, None, None, None, None), (5, None, None, None, None),
                   (6, None, 3.0, None, 3.0)], key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == tuple(x if x is None else pytest.approx(x) for x in w)
    hot = spark.range(200_000).selectExpr("cast(9 as long) as SK_ID_BUREAU", "0L as MONTHS_BALANCE", "'1' as STATUS")
    out = fe.balance_status_features(hot)
    assert out.count() == 200_000 and out.distinct().count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_recent_status_takes_the_latest_months(spark):
    rows = [(1, -m, str(m % 4)) for m in range(10)] + [(1, 0, "5"), (1, -1, "X"), (1, -2, "C"), (2, -7, "C"), (2, None, "3"), (3, -4, "X"), (4, None, "1")]
    df = spark.createDataFrame(rows, "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string")
    got = {r.SK_ID_BUREAU: r for r in fe.balance_recent_status(df, 4).collect()}
    assert set(got) == {1, 2, 3}                                    # a loan without any month is absent
    r = got[1]                                                      # months 0 to -3: 0, 5, 1, X, 2, C, 3
    assert (r.RECENT_n, r.RECENT_max, r.RECENT_late, r.RECENT_closed) == (4, 5.0, 4, 1)
    assert r.RECENT_mean == pytest.approx(11 / 5) and r.RECENT_change == pytest.approx(6 / 3 - 5 / 2)
    assert tuple(got[2])[1:] == (1, None, None, 0, 1, None) and tuple(got[3])[1:] == (1, None, None, 0, 0, None)


def test_recent_status_of_a_hot_loan_is_cut_before_the_shuffle(spark):
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 7L, id) as SK_ID_BUREAU", "-(id % 3000) as MONTHS_BALANCE", "cast(id % 3 as string) as STATUS")
    out = fe.balance_recent_status(df, 6)
    got = {r.SK_ID_BUREAU: r for r in out.where("SK_ID_BUREAU in (7, 8)").collect()}
    assert got[7].RECENT_n == 6 and got[7].RECENT_late == 1          # months 0, -3, -6, -9, -12 of status 0 and the loan's own row in month -7
    assert got[7].RECENT_mean == pytest.approx(1 / 151)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") and "partial_count" in plan and "Partial" in plan.split("WindowGroupLimit", 1)[1]


def test_full_outer_merge_splits_a_hot_loan(spark):
    bureau = spark.range(60_000).selectExpr("if(id % 3 = 0, 5L, id) as SK_ID_BUREAU", "id as k", "repeat(cast(id as string), 40) as pad")
    feats = spark.range(40_000, 70_000).selectExpr("id as SK_ID_BUREAU", "1.5D as STATUS_mean").unionByName(
        spark.createDataFrame([(5, 2.5), (None, 3.5)], "SK_ID_BUREAU long, STATUS_mean double"))
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = fe.merge_balance_into_bureau(bureau.repartition(6), feats)
        rows = out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    want = bureau.join(feats, "SK_ID_BUREAU", "full_outer").collect()
    assert out.columns == ["SK_ID_BUREAU", "k", "pad", "STATUS_mean"]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))


def test_few_values_are_counted_by_bits_and_many_by_distinct(spark):
    df = spark.range(4000).selectExpr("id % 7 as k", "if(id % 7 = 3 or id % 5 = 0, null, cast(id % 11 as string)) as a", "cast(id % 64 as string) as b",
                                      "cast(id % 63 as string) as `c.d`", "cast(null as string) as e")
    few = fe.few_values(df, ["a", "b", "c.d", "e"])
    assert sorted(few) == ["a", "c.d"] and len(few["a"]) == 11 and len(few["c.d"]) == 63      # 64 values do not fit
    spec = [(c, ["nunique"]) for c in ("a", "b", "c.d", "e")]
    got, want = [{r["k"]: r for r in df.groupBy("k").agg(*fe.spec_aggs("x", spec, f)).collect()} for f in (few, None)]
    assert got == want and want[3]["x_a_nunique"] == 0 and want[0]["x_c.d_nunique"] == 9
    assert df.groupBy("k").agg(*fe.spec_aggs("x", spec, few)).dtypes == df.groupBy("k").agg(*fe.spec_aggs("x", spec)).dtypes
    assert fe.few_values(df, ["b"]) == {} and fe.few_values(df.where("false"), ["a"]) == {}


def test_mart_repeats_no_bureau_row_for_its_distinct_counts(spark):
    from loanlens.plans import marts
    from loanlens.sources import standins
    from tests.conftest import SF
    t = standins.LoanTables(spark, SF)
    for out in (fe.bureau_and_latest_features(marts.bureau_with_status(t.bureau, t.balance), values=t.bureau), fe.prev_application_features(t.prev)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "distinct" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("hot_rows", [1_000_000, 150])
def test_grouped_medians_by_window_and_by_rank(spark, monkeypatch, hot_rows):
    import numpy as np
    from loanlens.operators import ranking
    ranked = []
    plain = ranking._sorted_checkpoint
    monkeypatch.setattr(ranking, "_sorted_checkpoint", lambda df, order: ranked.append(df.select("k").distinct().count()) or plain(df, order))
    monkeypatch.setattr(fe, "HOT_ROWS", hot_rows)
    rng = np.random.default_rng(3)
    rows = [(int(k), None if i % 9 == 0 else round(float(x), 2), None if k == 4 else i % 6) for i, (k, x) in
            enumerate(zip(np.where(np.arange(900) % 3 == 0, 7, np.arange(900) % 11), rng.normal(size=900)))]
    rows += [(50, None, None), (51, 2.5, None), (52, 1.0, 4), (52, 2.0, 4)]
    df = spark.createDataFrame(rows, "k long, x double, y int")
    got = {r["k"]: (r["mx"], r["my"]) for r in fe.grouped_medians(df, "k", ["x", "y"], ["mx", "my"]).collect()}
    assert ranked == ([] if hot_rows > 900 else [1])              # only the hot key is ranked over the whole table
    by = {}
    for k, x, y in rows:
        for part, v in zip(by.setdefault(k, ([], [])), (x, y)):
            part += [] if v is None else [v]
    want = {k: tuple(pytest.approx(float(np.median(v))) if v else None for v in p) for k, p in by.items() if any(p)}
    assert got == want and 50 not in got and got[52] == (1.5, 4.0)


def test_status_features_with_few_and_many_statuses_agree(spark, monkeypatch):
    df = spark.range(6000).selectExpr("if(id % 4 = 0, 3L, if(id % 97 = 0, null, id % 800)) as SK_ID_BUREAU", "if(id % 13 = 0, null, -(id % 3)) as MONTHS_BALANCE",
                                      "case id % 7 when 0 then 'C' when 1 then 'X' when 2 then null else cast(id % 7 + 0.5 as string) end as STATUS")

    def rows(d):
        return sorted((tuple(None if x is None else round(x, 9) for x in r) for r in fe.balance_status_features(d).collect()), key=repr)
    one = fe.balance_status_features(df)._jdf.queryExecution().executedPlan().toString()
    few, none_now = rows(df), rows(df.where("MONTHS_BALANCE < 0"))
    monkeypatch.setattr(fe, "MONTH_ZERO_STATUSES", 3)
    many = fe.balance_status_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in one and "collect_list" in many
    assert few == rows(df) and len(few) > 1000 and none_now == rows(df.where("MONTHS_BALANCE < 0")) and none_now
