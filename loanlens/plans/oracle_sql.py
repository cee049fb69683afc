"""DuckDB SQL for every SQL-checkable registered query.

Each statement is self-contained: the loan stand-in views are inlined as CTEs
(the same expression text Spark evaluates, see ``sources.standins``), then the
operator's semantics are spelled out in plain SQL following the reference's
pandas behaviour (full outer merges, null handling, fan-out on repeated keys).
"""

from __future__ import annotations

from ..operators import features as fe
from ..roles import APP_COLS_TARGET_20, REFUSED_TARGET_COLUMNS, REQUEST_FIELDS
from ..sources import standins as _S
from ..sources.standins import cte
from . import catalog

SQL: dict[str, str] = {}

_SQL_STAT = {"mean": "avg({})", "std": "stddev_samp({})", "max": "max({})", "min": "min({})",
             "count": "count({})", "nunique": "count(DISTINCT {})", "median": "median({})", "sum": "sum({})"}


def with_views(views, *extra: str) -> str:
    parts = [cte(v) for v in views] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def spec_sql(prefix: str, spec) -> list[str]:
    return [f'{_SQL_STAT[s].format(c)} AS "{(prefix + "_" + c + "_" + s).replace(" ", "_")}"'
            for c, stats in spec for s in stats]


def onehot_sql(column: str, vocab, prefix: str, suffix: str = "_sum") -> list[str]:
    return [f"count(*) FILTER (WHERE {column} = '{v}') AS \"{(prefix + column + '_' + v + suffix).replace(' ', '_')}\""
            for v in vocab]


def cols(*names: str) -> str:
    return ", ".join(names)


# ------------------------------------------------------------------ §E features

BAL_FEAT = """bal_clean AS (
  SELECT SK_ID_BUREAU, MONTHS_BALANCE,
         CASE WHEN STATUS = 'C' THEN CAST(-1 AS DOUBLE) WHEN STATUS = 'X' THEN NULL
              ELSE TRY_CAST(STATUS AS DOUBLE) END AS S
  FROM v_bal
),
bal_stats AS (
  SELECT SK_ID_BUREAU, avg(S) AS STATUS_mean, stddev_samp(S) AS STATUS_std, max(S) AS STATUS_max
  FROM bal_clean WHERE S <> -1 OR S IS NULL GROUP BY SK_ID_BUREAU
),
bal_last AS (SELECT SK_ID_BUREAU, S AS STATUS_last FROM bal_clean WHERE MONTHS_BALANCE = 0),
bal_feat AS (
  SELECT coalesce(l.SK_ID_BUREAU, s.SK_ID_BUREAU) AS SK_ID_BUREAU, STATUS_last, STATUS_mean, STATUS_std, STATUS_max
  FROM bal_last l FULL OUTER JOIN bal_stats s ON l.SK_ID_BUREAU = s.SK_ID_BUREAU
)"""

BUR_MERGED = """bur_m AS (
  SELECT coalesce(b.SK_ID_BUREAU, f.SK_ID_BUREAU) AS SK_ID_BUREAU, b.* EXCLUDE (SK_ID_BUREAU),
         f.STATUS_last, f.STATUS_mean, f.STATUS_std, f.STATUS_max
  FROM v_bur b FULL OUTER JOIN bal_feat f ON b.SK_ID_BUREAU = f.SK_ID_BUREAU
)"""

SQL["balance_status_features"] = with_views(["v_bal"], BAL_FEAT) + "SELECT * FROM bal_feat"

SQL["balance_latest_status"] = with_views(["v_bal"], BAL_FEAT.split(",\nbal_stats")[0]) + """
SELECT SK_ID_BUREAU,
       max(MONTHS_BALANCE) AS MONTHS_BALANCE_latest,
       arg_max_null(S, CAST(MONTHS_BALANCE AS BIGINT) * 100 + CAST(coalesce(S, -2) AS BIGINT)) AS STATUS_latest,
       avg(CASE WHEN S <> -1 THEN S END) AS STATUS_mean,
       stddev_samp(CASE WHEN S <> -1 THEN S END) AS STATUS_std,
       max(CASE WHEN S <> -1 THEN S END) AS STATUS_max
FROM bal_clean GROUP BY SK_ID_BUREAU"""

SQL["balance_recent_status"] = with_views(["v_bal"], BAL_FEAT.split(",\nbal_stats")[0], """recent AS (
  SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY SK_ID_BUREAU ORDER BY MONTHS_BALANCE DESC) AS k
                 FROM bal_clean WHERE MONTHS_BALANCE IS NOT NULL) WHERE k <= 6
)""") + """
SELECT SK_ID_BUREAU, CAST(max(k) AS INTEGER) AS RECENT_n,
       avg(S) FILTER (WHERE S <> -1) AS RECENT_mean, max(S) FILTER (WHERE S <> -1) AS RECENT_max,
       count(*) FILTER (WHERE S >= 1) AS RECENT_late, count(*) FILTER (WHERE S = -1) AS RECENT_closed,
       avg(S) FILTER (WHERE S <> -1 AND k <= 3) - avg(S) FILTER (WHERE S <> -1 AND k > 3) AS RECENT_change
FROM recent GROUP BY SK_ID_BUREAU"""

SQL["merge_balance_into_bureau"] = with_views(["v_bal", "v_bur"], BAL_FEAT, BUR_MERGED) + "SELECT * FROM bur_m"

_BUR_AGGS = (spec_sql("bur", fe.BUREAU_SPEC)
             + onehot_sql("CREDIT_ACTIVE", fe.BUREAU_CREDIT_ACTIVE, "bur_")
             + ['count(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0) AS bur_Has_overdue_sum',
                'count(*) FILTER (WHERE CNT_CREDIT_PROLONG > 0) AS bur_Has_prolong_sum']
             + [s.replace("Loan_for_business_development_sum", "business_sum")
                for s in onehot_sql("CREDIT_TYPE", fe.BUREAU_CREDIT_TYPES, "bur_")]
             + ["count(*) FILTER (WHERE CREDIT_TYPE IS NULL OR CREDIT_TYPE NOT IN ("
                + ", ".join(f"'{v}'" for v in fe.BUREAU_CREDIT_TYPES) + ")) AS bur_CREDIT_TYPE_infrequent_sum",
                "avg(DAYS_CREDIT_ENDDATE) FILTER (WHERE DAYS_CREDIT_ENDDATE > 0) AS bur_DAYS_CREDIT_ENDDATE_mean",
                "max(DAYS_CREDIT_ENDDATE) FILTER (WHERE DAYS_CREDIT_ENDDATE > 0) AS bur_DAYS_CREDIT_ENDDATE_max"])

BUR_FEAT = ("bur_feat AS (\n  SELECT SK_ID_CURR,\n    " + ",\n    ".join(_BUR_AGGS)
            + "\n  FROM bur_m WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR\n)")

BUR_LAT = ("bur_lat AS (\n  SELECT SK_ID_CURR, count(DAYS_CREDIT) AS bur_lat_DAYS_CREDIT, "
           + ", ".join(f"avg({c}) AS bur_lat_{c}" for c in fe.BUREAU_LATEST_SPEC)
           + "\n  FROM bur_m WHERE SK_ID_CURR IS NOT NULL AND DAYS_CREDIT >= -365 GROUP BY SK_ID_CURR\n)")

SQL["bureau_features"] = with_views(["v_bal", "v_bur"], BAL_FEAT, BUR_MERGED, BUR_FEAT) + "SELECT * FROM bur_feat"
SQL["bureau_latest_features"] = with_views(["v_bal", "v_bur"], BAL_FEAT, BUR_MERGED, BUR_LAT) + "SELECT * FROM bur_lat"

_ACTIVE = ("CASE WHEN count(*) FILTER (WHERE MONTHS_BALANCE = -1 AND NAME_CONTRACT_STATUS = 'Active') > 0 "
           "THEN count(SK_ID_PREV) FILTER (WHERE MONTHS_BALANCE = -1 AND NAME_CONTRACT_STATUS = 'Active') END")

CASH_FEAT = ("cash_feat AS (\n  SELECT SK_ID_CURR, "
             + ", ".join(spec_sql("cash", [("SK_ID_PREV", ["nunique", "count"]), ("CNT_INSTALMENT", ["max"]),
                                           ("SK_DPD", ["mean", "max"]), ("SK_DPD_DEF", ["mean", "max"])]))
             + ", count(*) FILTER (WHERE SK_DPD > 0) AS cash_Has_overdue_sum"
             + ", count(*) FILTER (WHERE SK_DPD_DEF > 0) AS cash_Has_overdue_def_sum"
             + f", {_ACTIVE} AS cash_Status_Active_count"
             + "\n  FROM v_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR\n)")
SQL["cash_features"] = with_views(["v_cash"], CASH_FEAT) + "SELECT * FROM cash_feat"

SQL["active_count_at_month"] = with_views(["v_cash"]) + f"""
SELECT SK_ID_CURR, {_ACTIVE} AS cash_Status_Active_count
FROM v_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR"""

INST_FEAT = """inst_feat AS (
  SELECT SK_ID_CURR,
    avg(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT) AS inst_Days_till_deadline_mean,
    max(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT) AS inst_Days_till_deadline_max,
    min(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT) AS inst_Days_till_deadline_min,
    avg(AMT_INSTALMENT - AMT_PAYMENT) AS inst_Amt_deficit_mean,
    max(AMT_INSTALMENT - AMT_PAYMENT) AS inst_Amt_deficit_max,
    avg(AMT_INSTALMENT) AS inst_AMT_INSTALMENT_mean,
    max(AMT_INSTALMENT) AS inst_AMT_INSTALMENT_max
  FROM v_inst WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR
)"""
SQL["installment_features"] = with_views(["v_inst"], INST_FEAT) + "SELECT * FROM inst_feat"

CARD_FEAT = ("card_feat AS (\n  SELECT SK_ID_CURR, "
             + ", ".join(spec_sql("cred", [("SK_ID_PREV", ["nunique", "count"]), ("SK_DPD", ["mean", "max"]),
                                           ("SK_DPD_DEF", ["mean", "max"])] + fe.CARD_SPEC_TAIL))
             + ", count(*) FILTER (WHERE SK_DPD > 0) AS cred_Has_overdue_sum"
             + ", count(*) FILTER (WHERE SK_DPD_DEF > 0) AS cred_Has_overdue_def_sum"
             + f", {_ACTIVE} AS cred_Status_Active_count"
             + "\n  FROM v_cred WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR\n)")
SQL["card_features"] = with_views(["v_cred"], CARD_FEAT) + "SELECT * FROM card_feat"

PREV_FEAT = ("prev_feat AS (\n  SELECT SK_ID_CURR, "
             + ", ".join(onehot_sql("NAME_CONTRACT_TYPE", fe.PREV_CONTRACT_TYPES, "prev_")
                         + onehot_sql("NAME_CONTRACT_STATUS", fe.PREV_CONTRACT_STATUSES, "prev_")
                         + onehot_sql("NAME_PORTFOLIO", fe.PREV_PORTFOLIOS, "prev_")
                         + onehot_sql("NAME_PRODUCT_TYPE", fe.PREV_PRODUCT_TYPES, "prev_")
                         + onehot_sql("NAME_YIELD_GROUP", fe.PREV_YIELD_GROUPS, "prev_")
                         + spec_sql("prev", fe.PREV_SPEC))
             + "\n  FROM (SELECT *, AMT_APPLICATION - AMT_CREDIT AS Credit_diff FROM v_prev) p"
             + "\n  WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR\n)")
SQL["prev_application_features"] = with_views(["v_prev"], PREV_FEAT) + "SELECT * FROM prev_feat"

CASH20 = """cash20 AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS cash_SK_ID_PREV_count,
  max(CNT_INSTALMENT) AS cash_CNT_INSTALMENT_max FROM v_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)"""
INST20 = """inst20 AS (SELECT SK_ID_CURR, min(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT) AS inst_Days_till_deadline_min,
  avg(AMT_INSTALMENT - AMT_PAYMENT) AS inst_Amt_deficit_mean FROM v_inst WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)"""
BUR20 = """bur20 AS (SELECT SK_ID_CURR, avg(DAYS_CREDIT) AS bur_DAYS_CREDIT_mean
  FROM v_bur WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)"""
PREV20 = """prev20 AS (SELECT SK_ID_CURR, avg(AMT_ANNUITY) AS prev_AMT_ANNUITY_mean,
  count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') AS prev_NAME_CONTRACT_STATUS_Refused_sum,
  max(AMT_APPLICATION - AMT_CREDIT) AS prev_Credit_diff_max FROM v_prev WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR)"""

SQL["cash_features_20"] = with_views(["v_cash"], CASH20) + "SELECT * FROM cash20"
SQL["installment_features_20"] = with_views(["v_inst"], INST20) + "SELECT * FROM inst20"
SQL["bureau_features_20"] = with_views(["v_bur"], BUR20) + "SELECT * FROM bur20"
SQL["prev_features_20"] = with_views(["v_prev"], PREV20) + "SELECT * FROM prev20"

MART20 = ("mart20 AS (SELECT a.SK_ID_CURR, " + ", ".join(f"a.{c}" for c in APP_COLS_TARGET_20)
          + """, cash20.* EXCLUDE (SK_ID_CURR), inst20.* EXCLUDE (SK_ID_CURR), bur20.* EXCLUDE (SK_ID_CURR),
  prev20.* EXCLUDE (SK_ID_CURR)
  FROM v_app a LEFT JOIN cash20 USING (SK_ID_CURR) LEFT JOIN inst20 USING (SK_ID_CURR)
  LEFT JOIN bur20 USING (SK_ID_CURR) LEFT JOIN prev20 USING (SK_ID_CURR))""")
SQL["feature_mart_20"] = (with_views(["v_app", "v_cash", "v_inst", "v_bur", "v_prev"], CASH20, INST20, BUR20,
                                     PREV20, MART20) + "SELECT * FROM mart20")

SQL["feature_mart_full"] = with_views(
    ["v_app", "v_bal", "v_bur", "v_cash", "v_inst", "v_cred", "v_prev"],
    BAL_FEAT, BUR_MERGED, BUR_FEAT, BUR_LAT, CASH_FEAT, INST_FEAT, CARD_FEAT, PREV_FEAT) + """
SELECT a.*, bur_feat.* EXCLUDE (SK_ID_CURR), bur_lat.* EXCLUDE (SK_ID_CURR), cash_feat.* EXCLUDE (SK_ID_CURR),
       inst_feat.* EXCLUDE (SK_ID_CURR), card_feat.* EXCLUDE (SK_ID_CURR), prev_feat.* EXCLUDE (SK_ID_CURR)
FROM v_app a LEFT JOIN bur_feat USING (SK_ID_CURR) LEFT JOIN bur_lat USING (SK_ID_CURR)
  LEFT JOIN cash_feat USING (SK_ID_CURR) LEFT JOIN inst_feat USING (SK_ID_CURR)
  LEFT JOIN card_feat USING (SK_ID_CURR) LEFT JOIN prev_feat USING (SK_ID_CURR)"""

SQL["join_feature_tables"] = with_views(["v_app", "v_cash", "v_inst"], CASH_FEAT, INST_FEAT) + """
SELECT a.SK_ID_CURR, TARGET, c.* EXCLUDE (SK_ID_CURR), i.* EXCLUDE (SK_ID_CURR)
FROM v_app a LEFT JOIN cash_feat c ON a.SK_ID_CURR = c.SK_ID_CURR LEFT JOIN inst_feat i ON a.SK_ID_CURR = i.SK_ID_CURR"""

SQL["outer_join_aggregates"] = with_views(["v_bur"]) + """
SELECT COALESCE(a.SK_ID_CURR, e.SK_ID_CURR) AS SK_ID_CURR, a.bur_DAYS_CREDIT_mean,
       e.bur_DAYS_CREDIT_ENDDATE_mean, e.bur_DAYS_CREDIT_ENDDATE_max
FROM (SELECT SK_ID_CURR, avg(DAYS_CREDIT) AS bur_DAYS_CREDIT_mean FROM v_bur
      WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR) a
FULL OUTER JOIN (SELECT SK_ID_CURR, avg(DAYS_CREDIT_ENDDATE) AS bur_DAYS_CREDIT_ENDDATE_mean,
                        max(DAYS_CREDIT_ENDDATE) AS bur_DAYS_CREDIT_ENDDATE_max
                 FROM v_bur WHERE DAYS_CREDIT_ENDDATE > 0 AND SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR) e
ON a.SK_ID_CURR = e.SK_ID_CURR"""

_CT = ", ".join(f"'{v}'" for v in fe.BUREAU_CREDIT_TYPES)
SQL["category_counts"] = with_views(["v_bur"]) + (
    "SELECT SK_ID_CURR, "
    + ", ".join(f"count(*) FILTER (WHERE CREDIT_TYPE = '{v}') AS \"CREDIT_TYPE_{v.replace(' ', '_')}\""
                for v in fe.BUREAU_CREDIT_TYPES)
    + f", count(*) FILTER (WHERE CREDIT_TYPE IS NULL OR CREDIT_TYPE NOT IN ({_CT})) AS CREDIT_TYPE_infrequent"
    + " FROM v_bur WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR")

SQL["one_hot_infrequent"] = with_views(["v_bur"]) + """, ranked AS (
  SELECT CREDIT_TYPE, row_number() OVER (ORDER BY count(*) DESC, CREDIT_TYPE DESC NULLS FIRST) AS rk,
         count(*) OVER () AS n_cat
  FROM v_bur GROUP BY CREDIT_TYPE
), kept AS (SELECT CREDIT_TYPE FROM ranked WHERE n_cat <= 7 OR rk <= 6),
buckets AS (
  SELECT 'CREDIT_TYPE_' || coalesce(replace(CREDIT_TYPE, ' ', '_'), 'nan') AS category FROM kept
  UNION ALL SELECT 'CREDIT_TYPE_infrequent' WHERE (SELECT count(*) FROM ranked) > 7
),
labelled AS (
  SELECT b.SK_ID_CURR,
         CASE WHEN EXISTS (SELECT 1 FROM kept k WHERE k.CREDIT_TYPE IS NOT DISTINCT FROM b.CREDIT_TYPE)
              THEN 'CREDIT_TYPE_' || coalesce(replace(b.CREDIT_TYPE, ' ', '_'), 'nan')
              ELSE 'CREDIT_TYPE_infrequent' END AS category
  FROM v_bur b WHERE b.SK_ID_CURR IS NOT NULL
),
keys AS (SELECT DISTINCT SK_ID_CURR FROM labelled)
SELECT k.SK_ID_CURR, bk.category, CAST(count(l.SK_ID_CURR) AS BIGINT) AS n
FROM keys k CROSS JOIN buckets bk
LEFT JOIN labelled l ON l.SK_ID_CURR = k.SK_ID_CURR AND l.category = bk.category
GROUP BY k.SK_ID_CURR, bk.category"""


# ------------------------------------------------------------------ §A sources, sinks, sampling


def hash_unit_sql(key: str, seed: int) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8)) AS BIGINT)"
            " / CAST(4294967296 AS DOUBLE))")


APP_SPLIT = (f"app_split AS (SELECT *, CASE WHEN {hash_unit_sql('SK_ID_CURR', 42)} < 0.05 THEN 'test' "
             "ELSE 'train' END AS split FROM v_app)")
TEST_IDS = "test_ids AS (SELECT SK_ID_CURR FROM app_split WHERE split = 'test')"
LAB = ("lab AS (SELECT *, CAST(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END AS INT) "
       "AS NAME_CONTRACT_STATUS_Refused FROM v_prev WHERE NAME_CONTRACT_STATUS IS DISTINCT FROM 'Canceled')")

SQL["scan_table"] = "SELECT * FROM orders"
SQL["csv_to_parquet"] = "SELECT * FROM orders"
SQL["holdout_split"] = with_views(["v_app"], APP_SPLIT) + "SELECT SK_ID_CURR, TARGET, split FROM app_split"
SQL["write_split_tables"] = with_views(["v_app", "v_bur", "v_bal", "v_prev", "v_cash", "v_inst", "v_cred"],
                                      APP_SPLIT) + """,
b AS (SELECT x.*, s.split FROM v_bur x JOIN (SELECT DISTINCT SK_ID_CURR, split FROM app_split) s USING (SK_ID_CURR)),
p AS (SELECT x.*, s.split FROM v_prev x JOIN (SELECT DISTINCT SK_ID_CURR, split FROM app_split) s USING (SK_ID_CURR)),
bb AS (SELECT x.*, s.split FROM v_bal x JOIN (SELECT DISTINCT SK_ID_BUREAU, split FROM b) s USING (SK_ID_BUREAU)),
pp AS (SELECT DISTINCT SK_ID_PREV, split FROM p)
SELECT 'application' AS "table", split, count(*) AS rows FROM app_split GROUP BY split
UNION ALL SELECT 'bureau', split, count(*) FROM b GROUP BY split
UNION ALL SELECT 'bureau_balance', split, count(*) FROM bb GROUP BY split
UNION ALL SELECT 'previous_application', split, count(*) FROM p GROUP BY split
UNION ALL SELECT 'pos_cash_balance', s.split, count(*) FROM v_cash x JOIN pp s USING (SK_ID_PREV) GROUP BY s.split
UNION ALL SELECT 'installments_payments', s.split, count(*) FROM v_inst x JOIN pp s USING (SK_ID_PREV) GROUP BY s.split
UNION ALL SELECT 'credit_card_balance', s.split, count(*) FROM v_cred x JOIN pp s USING (SK_ID_PREV) GROUP BY s.split"""
SQL["write_feature_table"] = SQL["bureau_features_20"]
SQL["write_bucketed_tables"] = SQL["feature_mart_20"]
SQL["sample_fraction"] = with_views(["v_app"]) + f"SELECT * FROM v_app WHERE {hash_unit_sql('SK_ID_CURR', 42)} < 0.2"
SQL["sample_n"] = with_views(["v_app"]) + (f"SELECT * FROM v_app ORDER BY {hash_unit_sql('SK_ID_CURR', 42)}, "
                                           "SK_ID_CURR LIMIT 100")

# ------------------------------------------------------------------ §B quality

SQL["duplicate_row_counts"] = with_views(["v_bal"]) + """, g AS (
  SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS, count(*) AS c FROM v_bal GROUP BY ALL
), t AS (SELECT count(*) AS first, CAST(sum(c - 1) AS BIGINT) AS dups FROM g)
SELECT * FROM (SELECT false AS is_dup, first AS n FROM t UNION ALL SELECT true, dups FROM t) WHERE n > 0"""

SQL["key_null_counts"] = with_views(["v_bal", "v_bur", "v_cash", "v_inst", "v_cred", "v_prev"], BAL_FEAT,
                                    BUR_MERGED) + """, u AS (
  SELECT 'bureau_merged' AS "table", count(*) - count(SK_ID_CURR) AS nulls FROM bur_m
  UNION ALL SELECT 'cash', count(*) - count(SK_ID_CURR) FROM v_cash
  UNION ALL SELECT 'inst', count(*) - count(SK_ID_CURR) FROM v_inst
  UNION ALL SELECT 'card', count(*) - count(SK_ID_CURR) FROM v_cred
  UNION ALL SELECT 'prev', count(*) - count(SK_ID_CURR) FROM v_prev
)
SELECT "table", nulls, nulls = 0 AS ok FROM u"""

SQL["superset_check"] = with_views(["v_prev", "v_cash"]) + """
SELECT missing = 0 AS is_superset, missing FROM (
  SELECT count(*) AS missing FROM v_cash c
  WHERE NOT EXISTS (SELECT 1 FROM v_prev p WHERE p.SK_ID_PREV = c.SK_ID_PREV))"""

_PREV_COLS = [c for c, _ in _S.PREVIOUS.columns]
SQL["null_proportions"] = with_views(["v_prev"]) + "SELECT *, 1 - null_share AS filled_share FROM (\n" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CAST({c} IS NULL AS DOUBLE)) AS null_share FROM v_prev" for c in _PREV_COLS) + ")"

SQL["sentinel_audit"] = with_views(["v_app"]) + """
SELECT DAYS_EMPLOYED = 365243 AS is_sentinel, count(*) AS n FROM v_app WHERE DAYS_EMPLOYED > 0 GROUP BY 1"""

_SHAPES = [("application", "v_app", _S.APPLICATION), ("bureau", "v_bur", _S.BUREAU),
           ("bureau_balance", "v_bal", _S.BUREAU_BALANCE), ("previous_application", "v_prev", _S.PREVIOUS),
           ("pos_cash_balance", "v_cash", _S.CASH), ("installments_payments", "v_inst", _S.INSTALLMENTS),
           ("credit_card_balance", "v_cred", _S.CARD)]
SQL["table_shape"] = with_views([v for _, v, _ in _SHAPES]) + "\n  UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows, {len(s.columns)} AS cols FROM {v}" for n, v, s in _SHAPES)


def _profile_sql(cols, numeric, discrete) -> str:
    parts = []
    for c in cols:
        num = c in numeric
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, "
            f"count(DISTINCT {c}) AS \"distinct\", "
            + (f"count(*) FILTER (WHERE {x} = 0) AS zeros, min({x}) AS min, max({x}) AS max, avg({x}) AS mean, "
               f"stddev_samp({x}) AS std, quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, "
               f"quantile_cont({x}, 0.75) AS q75" if num else
               "CAST(NULL AS BIGINT) AS zeros, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
               "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS q25, "
               "CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75")
            + " FROM v_prev")
    tops = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v, count(*) AS n FROM v_prev "
        f"WHERE {c} IS NOT NULL GROUP BY 2" for c in discrete)
    return ("stats AS (" + "\n  UNION ALL ".join(parts) + "),\nfreq AS (" + tops + "),\n"
            "top AS (SELECT \"column\", v AS top, n AS top_freq FROM (SELECT *, row_number() OVER "
            "(PARTITION BY \"column\" ORDER BY n DESC, v ASC) AS r FROM freq) WHERE r = 1)")


_PROFILE_COLS = ["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "RATE_DOWN_PAYMENT",
                 "DAYS_DECISION", "SELLERPLACE_AREA", "HOUR_APPR_PROCESS_START", "CNT_PAYMENT",
                 "NAME_CONTRACT_TYPE", "NAME_CONTRACT_STATUS", "NAME_TYPE_SUITE", "NAME_GOODS_CATEGORY",
                 "NAME_PORTFOLIO", "PRODUCT_COMBINATION"]
_PROFILE_NUM = _PROFILE_COLS[:9]
_PROFILE_DISCRETE = ["DAYS_DECISION", "SELLERPLACE_AREA", "HOUR_APPR_PROCESS_START"] + _PROFILE_COLS[9:]
SQL["table_profile"] = (with_views(["v_prev"], _profile_sql(_PROFILE_COLS, _PROFILE_NUM, _PROFILE_DISCRETE))
                        + "SELECT * FROM stats LEFT JOIN top USING (\"column\")")

SQL["target_rate_by_column"] = with_views(["v_prev"], LAB) + """, mm AS (
  SELECT min(CAST(AMT_APPLICATION AS DOUBLE)) AS lo1, max(CAST(AMT_APPLICATION AS DOUBLE)) AS hi1,
         min(CAST(DAYS_DECISION AS DOUBLE)) AS lo2, max(CAST(DAYS_DECISION AS DOUBLE)) AS hi2 FROM lab
), long AS (
  SELECT 'NAME_CONTRACT_TYPE' AS "column", NAME_CONTRACT_TYPE AS bucket, NAME_CONTRACT_STATUS_Refused AS y FROM lab
  UNION ALL SELECT 'NAME_PORTFOLIO', NAME_PORTFOLIO, NAME_CONTRACT_STATUS_Refused FROM lab
  UNION ALL SELECT 'NAME_YIELD_GROUP', NAME_YIELD_GROUP, NAME_CONTRACT_STATUS_Refused FROM lab
  UNION ALL SELECT 'AMT_APPLICATION', CASE WHEN AMT_APPLICATION IS NOT NULL THEN CAST(CAST(least(floor(
      (CAST(AMT_APPLICATION AS DOUBLE) - lo1) * CAST(10 AS DOUBLE) / (hi1 - lo1)), 9) AS BIGINT) AS VARCHAR) END,
      NAME_CONTRACT_STATUS_Refused FROM lab, mm
  UNION ALL SELECT 'DAYS_DECISION', CASE WHEN DAYS_DECISION IS NOT NULL THEN CAST(CAST(least(floor(
      (CAST(DAYS_DECISION AS DOUBLE) - lo2) * CAST(10 AS DOUBLE) / (hi2 - lo2)), 9) AS BIGINT) AS VARCHAR) END,
      NAME_CONTRACT_STATUS_Refused FROM lab, mm
)
SELECT "column", bucket, count(*) AS n, avg(y) AS rate FROM long GROUP BY ALL"""


def _assoc_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
    CASE WHEN hx > 0 THEN (hx - hxy) / hx ELSE CAST(1 AS DOUBLE) END AS uncertainty_coefficient
  FROM (SELECT -sum(n / tot * ln(nx / tot)) AS hx, -sum(n / tot * ln(n / ny)) AS hxy FROM (
    SELECT n, CAST(sum(n) OVER () AS DOUBLE) AS tot, CAST(sum(n) OVER (PARTITION BY x) AS DOUBLE) AS nx,
           CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE) AS ny
    FROM (SELECT coalesce(CAST({a} AS VARCHAR), '<null>') AS x, coalesce(CAST({b} AS VARCHAR), '<null>') AS y,
                 CAST(count(*) AS DOUBLE) AS n FROM v_prev GROUP BY 1, 2)))"""


_ASSOC = ["NAME_CONTRACT_TYPE", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE", "PRODUCT_COMBINATION"]
SQL["categorical_association"] = with_views(["v_prev"]) + "\nUNION ALL ".join(
    _assoc_sql(a, b) for a in _ASSOC for b in _ASSOC if a != b)

_CORR = ["AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_DOWN_PAYMENT"]
SQL["numeric_correlation"] = with_views(["v_prev"]) + "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM v_prev"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:])

# ------------------------------------------------------------------ §C column operators

SQL["recode_status"] = with_views(["v_bal"]) + """
SELECT *, CASE WHEN STATUS = 'C' THEN CAST(-1 AS DOUBLE) WHEN STATUS = 'X' THEN NULL
               ELSE TRY_CAST(STATUS AS DOUBLE) END AS STATUS_num FROM v_bal"""
SQL["flip_sign_columns"] = with_views(["v_app"]) + \
    "SELECT SK_ID_CURR, -DAYS_BIRTH AS DAYS_BIRTH, -DAYS_EMPLOYED AS DAYS_EMPLOYED FROM v_app"
SQL["null_sentinel"] = with_views(["v_app"]) + \
    "SELECT SK_ID_CURR, CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED_clean FROM v_app"
SQL["difference_feature"] = with_views(["v_inst"]) + """
SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT AS Days_till_deadline,
       AMT_INSTALMENT - AMT_PAYMENT AS Amt_deficit FROM v_inst"""
SQL["overdue_flags"] = with_views(["v_cash"]) + """
SELECT SK_ID_PREV, MONTHS_BALANCE, coalesce(SK_DPD > 0, false) AS Has_overdue,
       coalesce(SK_DPD_DEF > 0, false) AS Has_overdue_def, coalesce(CNT_INSTALMENT > 0, false) AS Has_instalments
FROM v_cash"""
SQL["binary_label"] = with_views(["v_prev"], LAB) + \
    "SELECT SK_ID_PREV, NAME_CONTRACT_STATUS, NAME_CONTRACT_STATUS_Refused FROM lab"
SQL["exclude_values"] = with_views(["v_prev"]) + """
SELECT SK_ID_PREV, NAME_CASH_LOAN_PURPOSE FROM v_prev
WHERE NAME_CASH_LOAN_PURPOSE NOT IN ('XAP', 'XNA') OR NAME_CASH_LOAN_PURPOSE IS NULL"""
SQL["fill_constant"] = with_views(["v_prev"]) + """
SELECT SK_ID_PREV, coalesce(NAME_TYPE_SUITE, 'NONE') AS NAME_TYPE_SUITE,
       coalesce(AMT_DOWN_PAYMENT, -1) AS AMT_DOWN_PAYMENT, coalesce(RATE_DOWN_PAYMENT, -1) AS RATE_DOWN_PAYMENT
FROM v_prev"""
_DROP = [c for c in ["SK_ID_CURR", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "NAME_CONTRACT_STATUS",
                     "NFLAG_INSURED_ON_APPROVAL"] if c in _PREV_COLS]
SQL["select_roles"] = with_views(["v_prev"]) + f"SELECT * EXCLUDE ({', '.join(_DROP)}) FROM v_prev"
SQL["flatten_agg_names"] = with_views(["v_cash"]) + """
SELECT SK_ID_CURR, count(SK_ID_PREV) AS cash_SK_ID_PREV_count, max(CNT_INSTALMENT) AS cash_CNT_INSTALMENT_max,
       avg(SK_DPD) AS cash_dpd_mean FROM v_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR"""
SQL["recency_filter"] = with_views(["v_prev"]) + \
    "SELECT SK_ID_PREV, DAYS_DECISION FROM v_prev WHERE DAYS_DECISION >= -365"
SQL["rank_top_categories"] = with_views(["v_prev"]) + """
SELECT NAME_GOODS_CATEGORY, count(*) AS count FROM v_prev WHERE NAME_GOODS_CATEGORY IS NOT NULL
GROUP BY 1 ORDER BY count DESC, NAME_GOODS_CATEGORY LIMIT 5"""
SQL["write_report_csv"] = SQL["rank_top_categories"]
SQL["entity_history"] = with_views(["v_cash"]) + """, sizes AS (
  SELECT SK_ID_CURR, count(*) AS n FROM v_cash WHERE SK_ID_CURR IS NOT NULL GROUP BY 1)
SELECT * FROM v_cash WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM sizes WHERE n = (SELECT max(n) FROM sizes))
ORDER BY SK_ID_PREV DESC, MONTHS_BALANCE DESC"""

# ------------------------------------------------------------------ §D joins

SQL["split_children"] = with_views(["v_app", "v_bur"], APP_SPLIT, TEST_IDS) + \
    "SELECT * FROM v_bur WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM test_ids)"
SQL["split_grandchildren"] = with_views(["v_app", "v_bur", "v_bal"], APP_SPLIT, TEST_IDS) + """
SELECT * FROM v_bal WHERE SK_ID_BUREAU IN (
  SELECT SK_ID_BUREAU FROM v_bur WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM test_ids))"""
SQL["merge_last_and_stats"] = SQL["balance_status_features"]
SQL["enrich_predictions"] = with_views(["v_prev", "v_app"], LAB) + f""", preds AS (
  SELECT SK_ID_PREV, {hash_unit_sql('SK_ID_PREV', 7)} AS proba_1 FROM lab)
SELECT p.SK_ID_PREV, p.proba_1, l.SK_ID_CURR, l.DAYS_DECISION, l.NAME_CONTRACT_STATUS_Refused,
       a.CODE_GENDER, a.AMT_INCOME_TOTAL, a.DAYS_BIRTH
FROM preds p LEFT JOIN lab l ON p.SK_ID_PREV = l.SK_ID_PREV LEFT JOIN v_app a ON l.SK_ID_CURR = a.SK_ID_CURR"""
SQL["compare_importances"] = with_views(["v_prev"], LAB) + """, a AS (
""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS col_name, abs(corr(CAST(NAME_CONTRACT_STATUS_Refused AS DOUBLE), {c})) AS importance FROM lab"
    for c in _CORR) + """), b AS (
""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS col_name, 1 - avg(CAST({c} IS NULL AS DOUBLE)) AS importance FROM lab"
    for c in _CORR + ["DAYS_DECISION"]) + """)
SELECT coalesce(a.col_name, b.col_name) AS col_name, a.importance AS importance_a, b.importance AS importance_b
FROM a FULL OUTER JOIN b ON a.col_name = b.col_name"""


# ------------------------------------------------------------------ §E group tables, §F reports

POP = ("pop AS (SELECT * FROM lab WHERE NAME_CASH_LOAN_PURPOSE NOT IN ('XAP', 'XNA') "
       "OR NAME_CASH_LOAN_PURPOSE IS NULL)")

SQL["group_rate_and_median"] = with_views(["v_prev"], LAB, POP) + """
SELECT NAME_CASH_LOAN_PURPOSE, avg(NAME_CONTRACT_STATUS_Refused) AS NAME_CONTRACT_STATUS_Refused_mean,
       quantile_cont(AMT_APPLICATION, 0.5) AS AMT_APPLICATION_median
FROM pop GROUP BY 1"""

SQL["filter_groups_by_median"] = with_views(["v_prev"], LAB) + """, gp AS (
  SELECT *, CAST(floor(AMT_APPLICATION / 100000) AS BIGINT) * 100000 AS AMT_BAND FROM lab
  WHERE NAME_GOODS_CATEGORY NOT IN ('XNA') OR NAME_GOODS_CATEGORY IS NULL
), med AS (SELECT NAME_GOODS_CATEGORY, quantile_cont(AMT_BAND, 0.5) AS m FROM gp GROUP BY 1),
pick AS (SELECT m FROM med GROUP BY m ORDER BY count(*) DESC, m ASC LIMIT 1)
SELECT SK_ID_PREV, NAME_GOODS_CATEGORY, AMT_BAND, NAME_CONTRACT_STATUS_Refused FROM gp
WHERE NAME_GOODS_CATEGORY IN (SELECT NAME_GOODS_CATEGORY FROM med WHERE m IN (SELECT m FROM pick))"""

SQL["crosstab_counts"] = with_views(["v_prev"], LAB, POP) + """
SELECT NAME_CASH_LOAN_PURPOSE, count(*) FILTER (WHERE NAME_CONTRACT_STATUS_Refused = 0) AS "0",
       count(*) FILTER (WHERE NAME_CONTRACT_STATUS_Refused = 1) AS "1"
FROM pop WHERE NAME_CASH_LOAN_PURPOSE IS NOT NULL GROUP BY 1"""

SQL["grouped_describe"] = with_views(["v_score"]) + """
SELECT label, count(*) AS count, avg(score) AS mean, stddev_samp(score) AS std, CAST(min(score) AS DOUBLE) AS min,
       CAST(max(score) AS DOUBLE) AS max, quantile_cont(score, 0.25) AS q25, quantile_cont(score, 0.5) AS q50,
       quantile_cont(score, 0.75) AS q75
FROM v_score WHERE score IS NOT NULL GROUP BY label"""

SQL["category_percent"] = with_views(["v_bal"]) + """
SELECT STATUS, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct
FROM v_bal WHERE STATUS IS NOT NULL GROUP BY STATUS"""

SQL["histogram"] = with_views(["v_bur"]) + """, mm AS (
  SELECT min(CAST(DAYS_CREDIT AS DOUBLE)) AS lo, max(CAST(DAYS_CREDIT AS DOUBLE)) AS hi FROM v_bur
), b AS (
  SELECT CAST(least(floor((CAST(DAYS_CREDIT AS DOUBLE) - lo) * CAST(20 AS DOUBLE) / (hi - lo)), 19) AS INTEGER) AS bin,
         count(*) AS n
  FROM v_bur CROSS JOIN mm WHERE DAYS_CREDIT IS NOT NULL GROUP BY 1
), g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT g.bin, lo + g.bin * ((hi - lo) / 20) AS bin_lo,
       CASE WHEN g.bin = 19 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 20) END AS bin_hi, coalesce(b.n, 0) AS n
FROM g CROSS JOIN mm LEFT JOIN b ON g.bin = b.bin"""

SQL["class_density"] = with_views(["v_score"]) + """, base AS (
  SELECT label AS cls, score AS x FROM v_score WHERE score IS NOT NULL AND label IS NOT NULL
), st AS (
  SELECT cls, count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd FROM base GROUP BY cls
), st2 AS (
  SELECT *, sd * pow(CAST(n AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS bw FROM st
), pts AS (
  SELECT cls, CAST(t.g AS INTEGER) AS g, n, bw,
         lo - CAST(3 AS DOUBLE) * bw + t.g * (hi - lo + CAST(6 AS DOUBLE) * bw) / CAST(199 AS DOUBLE) AS x
  FROM st2 CROSS JOIN range(200) t(g)
)
SELECT pts.cls AS label, g AS point, pts.x AS score,
       sum(exp(CAST(-0.5 AS DOUBLE) * ((pts.x - base.x) / bw) * ((pts.x - base.x) / bw))) / (n * bw * sqrt(2 * pi())) AS density
FROM pts JOIN base ON pts.cls = base.cls GROUP BY pts.cls, g, pts.x, n, bw"""

SQL["within_group_percent"] = with_views(["v_app"]) + """
SELECT ORGANIZATION_TYPE, TARGET, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER (PARTITION BY ORGANIZATION_TYPE) AS DOUBLE) AS percent
FROM v_app WHERE ORGANIZATION_TYPE IS NOT NULL AND TARGET IS NOT NULL GROUP BY 1, 2"""

SQL["overall_positive_rate"] = with_views(["v_app"]) + """
SELECT CAST(count(*) FILTER (WHERE TARGET = 1) AS DOUBLE) * 100 / count(*) AS positive_percent FROM v_app"""

SQL["group_outcome_report"] = with_views(["v_app"]) + """, w AS (
  SELECT NAME_EDUCATION_TYPE, TARGET, count(*) AS n,
         CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER (PARTITION BY NAME_EDUCATION_TYPE) AS DOUBLE) AS percent
  FROM v_app WHERE NAME_EDUCATION_TYPE IS NOT NULL AND TARGET IS NOT NULL GROUP BY 1, 2
), s AS (
  SELECT NAME_EDUCATION_TYPE, CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) AS group_percent
  FROM v_app WHERE NAME_EDUCATION_TYPE IS NOT NULL GROUP BY 1
), r AS (SELECT CAST(count(*) FILTER (WHERE TARGET = 1) AS DOUBLE) * 100 / count(*) AS positive_percent FROM v_app)
SELECT w.*, s.group_percent, r.positive_percent FROM w LEFT JOIN s USING (NAME_EDUCATION_TYPE) CROSS JOIN r"""


def _qcut_sql(col: str, labels, src: str, edges: str) -> str:
    q = len(labels)
    parts = [f"WHEN {col} IS NULL THEN NULL"]
    for i, lab in enumerate(labels):
        parts.append(f"WHEN {col} <= {edges}[{i + 2}] AND {col} >= {edges}[1] THEN '{lab}'")
    probs = ", ".join(f"{i}/{q}" for i in range(q + 1))
    return f"(SELECT quantile_cont({col}, [{probs}]) FROM {src})", "CASE " + " ".join(parts) + " END"


_inc_edges, _inc_case = _qcut_sql("AMT_INCOME_TOTAL", ["Low", "Medium", "High"], "v_app", "e")
SQL["quantile_groups"] = with_views(["v_app"]) + f""", eq AS (SELECT {_inc_edges} AS e)
SELECT SK_ID_CURR, AMT_INCOME_TOTAL, {_inc_case} AS "Income Group" FROM v_app CROSS JOIN eq"""

_yr_inc_edges, _yr_inc_case = _qcut_sql("AMT_INCOME_TOTAL", ["Low", "Medium", "High"], "yr", "ei")
_yr_age_edges, _yr_age_case = _qcut_sql("DAYS_BIRTH", ["Lower Quantile", "Middle Quantile", "Upper Quantile"],
                                        "yr", "ea")
IMPACT = f"""preds AS (SELECT SK_ID_PREV, {hash_unit_sql('SK_ID_PREV', 7)} AS proba_1 FROM lab),
enr AS (
  SELECT p.SK_ID_PREV, p.proba_1, l.SK_ID_CURR, l.DAYS_DECISION, l.NAME_CONTRACT_STATUS_Refused,
         a.CODE_GENDER, a.AMT_INCOME_TOTAL, a.DAYS_BIRTH
  FROM preds p LEFT JOIN lab l ON p.SK_ID_PREV = l.SK_ID_PREV LEFT JOIN v_app a ON l.SK_ID_CURR = a.SK_ID_CURR
),
yr AS (SELECT *, CASE WHEN proba_1 > CAST(0.35 AS DOUBLE) THEN 1 ELSE 0 END AS Prediction FROM enr
       WHERE DAYS_DECISION >= -365),
edges AS (SELECT {_yr_inc_edges} AS ei, {_yr_age_edges} AS ea),
impact AS (SELECT yr.*, {_yr_inc_case} AS "Income Group", {_yr_age_case} AS "Age Group" FROM yr CROSS JOIN edges)"""


def _within_sql(grouping: str, outcome: str) -> str:
    return f"""SELECT '{grouping}' AS grouping, CAST("{grouping}" AS VARCHAR) AS "group", '{outcome}' AS outcome_kind,
    CAST({outcome} AS INTEGER) AS outcome, count(*) AS n,
    CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER (PARTITION BY "{grouping}") AS DOUBLE) AS percent
  FROM impact WHERE "{grouping}" IS NOT NULL AND {outcome} IS NOT NULL GROUP BY "{grouping}", {outcome}"""


SQL["group_impact_report"] = with_views(["v_prev", "v_app"], LAB, IMPACT) + "\nUNION ALL ".join(
    _within_sql(g, o) for g in ["CODE_GENDER", "Income Group", "Age Group"]
    for o in ["Prediction", "NAME_CONTRACT_STATUS_Refused"])

# ------------------------------------------------------------------ §G chi-square

def _chi2_sql(pop_filter: str = "") -> str:
    return f"""cells0 AS (
  SELECT NAME_CASH_LOAN_PURPOSE AS x, count(*) FILTER (WHERE NAME_CONTRACT_STATUS_Refused = 0) AS o0,
         count(*) FILTER (WHERE NAME_CONTRACT_STATUS_Refused = 1) AS o1
  FROM pop WHERE NAME_CASH_LOAN_PURPOSE IS NOT NULL {pop_filter} GROUP BY 1
), cells AS (SELECT x, '0' AS y, o0 AS observed FROM cells0 UNION ALL SELECT x, '1', o1 FROM cells0),
e AS (
  SELECT x, y, observed, CAST(sum(observed) OVER (PARTITION BY x) AS DOUBLE) * sum(observed) OVER (PARTITION BY y)
         / sum(observed) OVER () AS expected FROM cells
), shape AS (SELECT count(DISTINCT x) AS r, count(DISTINCT y) AS c FROM cells)"""


_CHI2_SELECT = """
SELECT sum(power(CASE WHEN (r - 1) * (c - 1) = 1
                      THEN observed + sign(expected - observed) * least(0.5, abs(expected - observed))
                      ELSE observed END - expected, 2) / expected) AS chi2,
       CAST((r - 1) * (c - 1) AS BIGINT) AS dof, count(*) AS n_cells
FROM e CROSS JOIN shape GROUP BY r, c"""

SQL["chi2_independence"] = with_views(["v_prev"], LAB, POP, _chi2_sql()) + _CHI2_SELECT
SQL["chi2_drop_group"] = with_views(["v_prev"], LAB, POP, _chi2_sql("AND NAME_CASH_LOAN_PURPOSE <> 'Other'")) \
    + _CHI2_SELECT
# for an even number of degrees of freedom the tail is a Poisson sum
SQL["chi2_p_value"] = with_views(["v_prev"], LAB, POP, _chi2_sql()) + f"""
SELECT chi2, dof, n_cells, list_sum([exp(-chi2 / 2) * power(chi2 / 2, k) / gamma(k + 1) for k in range(0, dof // 2)]) AS p
FROM ({_CHI2_SELECT})"""
SQL["chi2_expected_counts"] = with_views(["v_prev"], LAB, POP, _chi2_sql()) + """
SELECT x AS NAME_CASH_LOAN_PURPOSE, y AS NAME_CONTRACT_STATUS_Refused, observed, expected,
       avg(CAST(expected >= 5 AS DOUBLE)) OVER () AS share_expected_ge5 FROM e"""

# ------------------------------------------------------------------ §H splits


def _strat_sql(seed: int) -> str:
    return f"""r AS (
  SELECT SK_ID_CURR, TARGET,
         row_number() OVER (PARTITION BY TARGET ORDER BY {hash_unit_sql('SK_ID_CURR', seed)}, SK_ID_CURR) - 1 AS pos,
         count(*) OVER (PARTITION BY TARGET) AS n
  FROM v_app)"""


SQL["stratified_split"] = with_views(["v_app"], _strat_sql(42)) + """
SELECT SK_ID_CURR, TARGET, CASE WHEN pos < floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split
FROM r"""
SQL["stratified_folds"] = with_views(["v_app"], _strat_sql(0)) + \
    "SELECT SK_ID_CURR, TARGET, CAST((pos * 5) // n AS INTEGER) AS fold FROM r"
SQL["recency_split"] = with_views(["v_prev"]) + """
SELECT SK_ID_PREV, DAYS_DECISION,
       CASE WHEN DAYS_DECISION > (SELECT quantile_cont(DAYS_DECISION, 0.8) FROM v_prev) THEN 'test' ELSE 'train' END
       AS split
FROM v_prev"""

# ------------------------------------------------------------------ §K evaluation

SQL["log_loss"] = with_views(["v_score"]) + """
SELECT avg(-(label * ln(p) + (1 - label) * ln(1 - p))) AS log_loss FROM (
  SELECT CAST(label AS DOUBLE) AS label,
         least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM v_score)"""

CURVE = """g AS (
  SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS tp_at, count(*) AS n_at FROM v_score GROUP BY 1
), c AS (
  SELECT threshold, tp_at, n_at, n_at - tp_at AS neg_at,
         CAST(sum(tp_at) OVER w AS BIGINT) AS ctp, CAST(sum(n_at) OVER w AS BIGINT) AS cn,
         CAST(sum(n_at - tp_at) OVER w AS BIGINT) AS cneg
  FROM g WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), t AS (SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) AS N FROM v_score)"""

SQL["precision_recall_curve"] = with_views(["v_score"], CURVE) + """
SELECT threshold, ctp AS tp, cn - ctp AS fp, CAST(ctp AS DOUBLE) / cn AS precision,
       CAST(ctp AS DOUBLE) / CAST(P AS DOUBLE) AS recall, CAST(P AS DOUBLE) / N AS chance_level
FROM c CROSS JOIN t"""
SQL["average_precision"] = with_views(["v_score"], CURVE) + """
SELECT sum((CAST(tp_at AS DOUBLE) / CAST(P AS DOUBLE)) * (CAST(ctp AS DOUBLE) / cn)) AS average_precision
FROM c CROSS JOIN t"""
SQL["cumulative_gain"] = with_views(["v_score"], CURVE) + """
SELECT threshold, CAST(cn AS DOUBLE) / CAST(N AS DOUBLE) AS population_share,
       CAST(ctp AS DOUBLE) / CAST(P AS DOUBLE) AS gain_1, CAST(cneg AS DOUBLE) / CAST(N - P AS DOUBLE) AS gain_0
FROM c CROSS JOIN t"""
SQL["lift_at_fraction"] = with_views(["v_score"], CURVE) + """
SELECT CAST(0.2 AS DOUBLE) AS fraction, coalesce(max(CAST(cn AS DOUBLE) / CAST(N AS DOUBLE)), 0) AS population_share,
       coalesce(max(CAST(ctp AS DOUBLE) / CAST(P AS DOUBLE)), 0) AS gain_1
FROM c CROSS JOIN t WHERE CAST(cn AS DOUBLE) / CAST(N AS DOUBLE) <= CAST(0.2 AS DOUBLE)"""
SQL["apply_threshold"] = with_views(["v_score"]) + """
SELECT l_orderkey, l_linenumber, score, CASE WHEN score > CAST(0.2 AS DOUBLE) THEN 1 ELSE 0 END AS prediction
FROM v_score"""

CM = """cm AS (
  SELECT count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp
  FROM (SELECT label, CASE WHEN score > CAST(0.35 AS DOUBLE) THEN 1 ELSE 0 END AS pred FROM v_score))"""
SQL["confusion_matrix"] = with_views(["v_score"], CM) + "SELECT * FROM cm"


def _div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


SQL["classification_report"] = with_views(["v_score"], CM) + f""", m AS (
  SELECT *, {_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1, {_div('tn', 'tn + fn')} AS p0,
         {_div('tn', 'tn + fp')} AS r0, tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n FROM cm
), f AS (SELECT *, {_div('2 * p0 * r0', 'p0 + r0')} AS f0, {_div('2 * p1 * r1', 'p1 + r1')} AS f1,
         {_div('tn + tp', 'n')} AS acc FROM m)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM f"""


def _profit_sql(tn, fp, fn, tp) -> str:
    return (f"CAST({tn} AS DOUBLE) * CAST(0.2 AS DOUBLE) + CAST({fp} AS DOUBLE) * CAST(-0.2 AS DOUBLE) "
            f"+ CAST({fn} AS DOUBLE) * CAST(-0.8 AS DOUBLE) + CAST({tp} AS DOUBLE) * CAST(0.0 AS DOUBLE)")


SQL["profit_at_threshold"] = with_views(["v_score"], CM) + \
    f"SELECT CAST(0.35 AS DOUBLE) AS threshold, tn, fp, fn, tp, {_profit_sql('tn', 'fp', 'fn', 'tp')} AS profit FROM cm"

SWEEP = f"""sw AS (
  SELECT k * CAST(0.01 AS DOUBLE) AS threshold,
         count(*) FILTER (WHERE label <> 1) - count(*) FILTER (WHERE label <> 1 AND score > k * CAST(0.01 AS DOUBLE)) AS tn,
         count(*) FILTER (WHERE label <> 1 AND score > k * CAST(0.01 AS DOUBLE)) AS fp,
         count(*) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1 AND score > k * CAST(0.01 AS DOUBLE)) AS fn,
         count(*) FILTER (WHERE label = 1 AND score > k * CAST(0.01 AS DOUBLE)) AS tp
  FROM v_score CROSS JOIN (SELECT range AS k FROM range(100)) ks GROUP BY k
), swp AS (SELECT *, {_profit_sql('tn', 'fp', 'fn', 'tp')} AS profit FROM sw)"""
SQL["profit_sweep"] = with_views(["v_score"], SWEEP) + "SELECT * FROM swp"
SQL["best_threshold"] = with_views(["v_score"], SWEEP) + """
SELECT b.threshold AS best_threshold, b.profit AS best_profit, (SELECT profit FROM swp
        WHERE abs(threshold - 0.5) < 1e-9) AS base_profit, CAST(0.5 AS DOUBLE) AS base_threshold,
       b.profit * 100 / (SELECT profit FROM swp WHERE abs(threshold - 0.5) < 1e-9) - 100 AS profit_increase_pct
FROM (SELECT * FROM swp ORDER BY profit DESC, threshold ASC LIMIT 1) b"""
SQL["decision_certainty"] = with_views(["v_score"]) + """
SELECT l_orderkey, l_linenumber, score,
       CASE WHEN score > CAST(0.35 AS DOUBLE) THEN (score - CAST(0.35 AS DOUBLE)) / (1 - CAST(0.35 AS DOUBLE))
            ELSE (CAST(0.35 AS DOUBLE) - score) / CAST(0.35 AS DOUBLE) END * 100 AS certainty_pct
FROM v_score"""


# ------------------------------------------------------------------ §I fitted preprocessing


PREV_SPLIT = f"""prev_split AS (
  SELECT *, CASE WHEN pos < floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY NAME_CONTRACT_STATUS_Refused
                                 ORDER BY {hash_unit_sql('SK_ID_PREV', 42)}, SK_ID_PREV) - 1 AS pos,
           count(*) OVER (PARTITION BY NAME_CONTRACT_STATUS_Refused) AS n
    FROM lab)
), ptrain AS (SELECT * FROM prev_split WHERE split = 'train')"""

SQL["mode_impute_sentinel"] = with_views(["v_app"], _strat_sql(42)) + """, split AS (
  SELECT r.*, CASE WHEN pos < floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS part FROM r
), mode AS (
  SELECT CODE_GENDER AS v FROM v_app WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM split WHERE part = 'train')
    AND CODE_GENDER IS NOT NULL AND CODE_GENDER <> 'XNA'
  GROUP BY 1 ORDER BY count(*) DESC, v ASC LIMIT 1
)
SELECT SK_ID_CURR, CASE WHEN CODE_GENDER = 'XNA' THEN (SELECT v FROM mode) ELSE CODE_GENDER END AS CODE_GENDER
FROM v_app"""

SQL["constant_impute_sentinel"] = with_views(["v_app"]) + """
SELECT SK_ID_CURR, CASE WHEN ORGANIZATION_TYPE = 'XNA' THEN 'missing_value' ELSE ORGANIZATION_TYPE END
       AS ORGANIZATION_TYPE FROM v_app"""

_ONEHOT = [
    ("FLAG_LAST_APPL_PER_CONTRACT", ["Y"]),
    ("NAME_CONTRACT_TYPE", ["Cash loans", "Consumer loans", "Revolving loans", "XNA"]),
    ("NAME_TYPE_SUITE", ["Family", "Group of people", "Spouse, partner", "Unaccompanied", None]),
]


def _onehot_cols(drop=()):
    out = []
    for c, cats in _ONEHOT:
        for v in cats:
            name = f"{c}_{'nan' if v is None else v}"
            if name in drop:
                continue
            cond = f"{c} IS NULL" if v is None else f"coalesce({c} = '{v}', false)"
            out.append(f'CAST({cond} AS DOUBLE) AS "{name}"')
    return ", ".join(out)


SQL["one_hot_encode"] = with_views(["v_prev"], LAB) + f"SELECT SK_ID_PREV, {_onehot_cols()} FROM lab"
SQL["drop_after_encoding"] = with_views(["v_prev"], LAB) + \
    f"SELECT SK_ID_PREV, {_onehot_cols(('NAME_CONTRACT_TYPE_XNA', 'NAME_TYPE_SUITE_Group of people'))} FROM lab"


def _te_sql() -> str:
    parts, sel, joins = [], [], []
    for i, c in enumerate(REFUSED_TARGET_COLUMNS):
        parts.append(f"""st{i} AS (
  SELECT coalesce(CAST({c} AS VARCHAR), '<null>') AS k, count(*) AS n,
         avg(CAST(NAME_CONTRACT_STATUS_Refused AS DOUBLE)) AS m FROM ptrain GROUP BY 1),
enc{i} AS (
  SELECT k, CASE WHEN n = 1 THEN p ELSE p * (1 - w) + m * w END AS e
  FROM (SELECT *, 1 / (1 + exp(-(CAST(n AS DOUBLE) - 20) / 10)) AS w FROM st{i} CROSS JOIN prior))""")
        sel.append(f"coalesce(enc{i}.e, (SELECT p FROM prior)) AS {c}")
        joins.append(f"LEFT JOIN enc{i} ON coalesce(CAST(l.{c} AS VARCHAR), '<null>') = enc{i}.k")
    return (",\nprior AS (SELECT avg(CAST(NAME_CONTRACT_STATUS_Refused AS DOUBLE)) AS p FROM ptrain),\n"
            + ",\n".join(parts) + "\nSELECT l.SK_ID_PREV, " + ", ".join(sel) + " FROM lab l " + " ".join(joins))


SQL["target_encode"] = with_views(["v_prev"], LAB, PREV_SPLIT) + _te_sql()

_MART_NUMERIC = ["EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "OWN_CAR_AGE", "AMT_ANNUITY",
                 "cash_CNT_INSTALMENT_max", "inst_Days_till_deadline_min", "inst_Amt_deficit_mean",
                 "bur_DAYS_CREDIT_mean", "prev_AMT_ANNUITY_mean", "prev_Credit_diff_max"]
SQL["missing_value_fill"] = (with_views(["v_app", "v_cash", "v_inst", "v_bur", "v_prev"], CASH20, INST20, BUR20,
                                        PREV20, MART20)
                             + "SELECT SK_ID_CURR, " + ", ".join(
                                 f"coalesce(CAST({c} AS DOUBLE), (SELECT min(CAST({c} AS DOUBLE)) FROM mart20) - 1) AS {c}"
                                 for c in _MART_NUMERIC) + " FROM mart20")


def _role_sql(parts: str, fit: str) -> str:
    """Named features of the payment-difficulty pipeline, fitted on the rows of ``parts`` (SK_ID_CURR, part) where ``fit`` holds."""
    encoded, joins = "", ""
    for i, c in enumerate(["ORGANIZATION_TYPE", "NAME_EDUCATION_TYPE"]):
        encoded += f""", st{i} AS (
  SELECT coalesce({c}, '<null>') AS k, count(*) AS n, avg(CAST(TARGET AS DOUBLE)) AS m FROM imputed WHERE {fit} GROUP BY 1
), enc{i} AS (
  SELECT k, CASE WHEN n = 1 THEN p ELSE p * (1 - w) + m * w END AS e
  FROM (SELECT *, 1 / (1 + exp(-(CAST(n AS DOUBLE) - 20) / 10)) AS w FROM st{i} CROSS JOIN prior))"""
        joins += f" LEFT JOIN enc{i} ON coalesce(l.{c}, '<null>') = enc{i}.k"
    rest = "COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET, part))"
    return f"""parts AS ({parts}), imputed AS (
  SELECT m.* EXCLUDE (CODE_GENDER) REPLACE (
    CASE WHEN ORGANIZATION_TYPE = 'XNA' THEN 'missing_value' ELSE ORGANIZATION_TYPE END AS ORGANIZATION_TYPE,
    CASE WHEN NAME_EDUCATION_TYPE = 'XNA' THEN 'missing_value' ELSE NAME_EDUCATION_TYPE END AS NAME_EDUCATION_TYPE), part
  FROM mart20 m JOIN parts USING (SK_ID_CURR)
), prior AS (SELECT avg(CAST(TARGET AS DOUBLE)) AS p FROM imputed WHERE {fit}){encoded}, encoded AS (
  SELECT l.* REPLACE (coalesce(enc0.e, (SELECT p FROM prior)) AS ORGANIZATION_TYPE,
                      coalesce(enc1.e, (SELECT p FROM prior)) AS NAME_EDUCATION_TYPE) FROM imputed l{joins}
), filled AS (
  SELECT SK_ID_CURR, TARGET, part,
         coalesce(CAST({rest} AS DOUBLE), min(CASE WHEN {fit} THEN CAST({rest} AS DOUBLE) END) OVER () - 1, -1)
  FROM encoded)"""


_MART20_VIEWS = (["v_app", "v_cash", "v_inst", "v_bur", "v_prev"], CASH20, INST20, BUR20, PREV20, MART20)
SQL["column_role_pipeline"] = with_views(*_MART20_VIEWS, _role_sql("SELECT SK_ID_CURR, 'all' AS part FROM v_app", "true")) \
    + "SELECT * EXCLUDE (part) FROM filled"
SQL["fit_transform_split"] = with_views(*_MART20_VIEWS, _strat_sql(42), _role_sql(
    "SELECT SK_ID_CURR, CASE WHEN pos < floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'valid' ELSE 'train' END AS part FROM r",
    "part = 'train'")) + "SELECT * FROM filled"

# ------------------------------------------------------------------ §J naive baseline

SQL["naive_baseline_log_loss"] = with_views(["v_app"], _strat_sql(0)) + """, f AS (
  SELECT CAST((pos * 5) // n AS INTEGER) AS fold, count(*) AS n, sum(CAST(TARGET AS DOUBLE)) AS s FROM r GROUP BY 1
), t AS (SELECT sum(n) AS tot_n, sum(s) AS tot_s FROM f),
m AS (SELECT fold, n, s, (tot_s - s) / CAST(tot_n - n AS DOUBLE) AS train_mean FROM f CROSS JOIN t),
c AS (SELECT *, least(greatest(train_mean, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM m)
SELECT fold, train_mean, -(s * ln(p) + (n - s) * ln(1 - p)) / n AS log_loss FROM c"""

# ------------------------------------------------------------------ §M validation


def _validate_sql() -> str:
    texts, checks = [], []
    for n, t in REQUEST_FIELDS:
        txt = f"CAST({n} AS VARCHAR)"
        if t == "double":
            txt = f"coalesce({txt}, 'n/a')"
        texts.append(f"{txt} AS {n}")
        target = {"int": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}[t]
        checks.append(f"CASE WHEN {n} IS NULL OR TRY_CAST({n} AS {target}) IS NULL THEN '{n}' END")
    return ("req AS (SELECT " + ", ".join(texts) + " FROM v_prev)\n"
            "SELECT CAST(SK_ID_PREV AS BIGINT) AS SK_ID_PREV, concat_ws(',', " + ", ".join(checks)
            + ") AS errors FROM req")


SQL["validate_records"] = with_views(["v_prev"], _validate_sql())

# ------------------------------------------------------------------ §J leaderboard metrics, §L contributions of a given table

SQL["prediction_metrics"] = with_views(["v_score"], "preds AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, CAST(l_orderkey % 3 AS INTEGER) AS fold, label, {e} AS score FROM v_score"
    for name, e in catalog.PREDICTION_MODELS.items()) + """), ranked AS (
  SELECT *, CASE WHEN score > CAST(0.45 AS DOUBLE) THEN 1 ELSE 0 END AS pred,
         rank() OVER w + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2.0 AS r
  FROM preds WINDOW w AS (PARTITION BY model, fold ORDER BY score)
), cells AS (
  SELECT model, fold, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS P, CAST(count(*) - sum(label) AS DOUBLE) AS N0,
         sum(CASE WHEN label = 1 THEN r END) AS ranks,
         CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS DOUBLE) AS tn
  FROM ranked GROUP BY model, fold
), chance AS (SELECT *, ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n) AS pe FROM cells),
folds AS (
  SELECT model, n, (tp + tn) / n AS accuracy, (ranks - P * (P + 1) / 2) / (P * N0) AS auc,
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(((tp + tn) / n - pe) / nullif(1 - pe, 0), 0) AS kappa,
         coalesce((tp * tn - fp * fn) / nullif(sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn), 0), 0) AS mcc
  FROM chance
)""") + """
SELECT model, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_folds, avg(accuracy) AS accuracy, avg(auc) AS auc, avg(recall) AS recall,
       avg("precision") AS "precision", avg(f1) AS f1, avg(kappa) AS kappa, avg(mcc) AS mcc
FROM folds GROUP BY model"""

_CONTRIB = "contrib AS (" + " UNION ALL ".join(
    f"SELECT SK_ID_CURR, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"coalesce((CAST({c} AS DOUBLE) - CAST({at} AS DOUBLE)) * CAST({per} AS DOUBLE), CAST({miss} AS DOUBLE)) AS contribution FROM v_app"
    for c, (at, per, miss) in catalog.CONTRIBUTION_RULES.items()) + """), ranking AS (
  SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) - 1 AS INTEGER) AS rank
  FROM (SELECT feature, avg(abs(contribution)) AS importance FROM contrib GROUP BY feature))"""
SQL["feature_importance_rank"] = with_views(["v_app"], _CONTRIB) + "SELECT * FROM ranking"
SQL["top_and_tail"] = with_views(["v_app"], _CONTRIB) + """
(SELECT * FROM ranking ORDER BY rank LIMIT 2) UNION ALL (SELECT * FROM ranking ORDER BY rank DESC LIMIT 2)"""
SQL["contribution_summary"] = with_views(["v_app"], _CONTRIB, """binned AS (
  SELECT *, CASE WHEN value IS NOT NULL THEN CAST(floor((rank() OVER (PARTITION BY feature, value IS NULL ORDER BY value) - 1) * 10
                 / CAST(count(*) OVER (PARTITION BY feature, value IS NULL) AS DOUBLE)) AS INTEGER) END AS bin
  FROM contrib)""") + """
SELECT feature, bin, count(*) AS n, min(value) AS value_min, max(value) AS value_max, avg(contribution) AS mean_contribution,
       min(contribution) AS min_contribution, max(contribution) AS max_contribution, quantile_cont(contribution, 0.25) AS q25,
       quantile_cont(contribution, 0.5) AS q50, quantile_cont(contribution, 0.75) AS q75
FROM binned GROUP BY feature, bin"""
