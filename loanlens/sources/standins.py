"""Loan-shaped views over the driver's TPC-H-like tables.

The credit-risk operators expect seven linked loan tables (application,
bureau, bureau balance, previous applications, cash balance, instalments,
card balance). The test data holds no loans, so each view below derives a
loan table from a TPC-H-like table with plain column expressions. Nulls,
sentinels and unmatched keys are planted on purpose so every trap of the
operators is exercised.

Every view is declared once as a list of ``(column, SQL expression)`` pairs
written in the SQL subset that Spark SQL and DuckDB share. Two date helpers
differ between the dialects and are written as tokens:

* ``DAYS[x]``   -> whole days from the reference date 2002-01-01 to ``x``
* ``DIFF[a,b]`` -> whole days from ``b`` to ``a``

Spark evaluates the expressions with ``selectExpr`` (Catalyst still prunes
and pushes filters into the parquet scan); the DuckDB oracle inlines the same
text as CTEs, so both engines read exactly the same derived table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..roles import INST_DERIVED

REF_DATE = "2002-01-01"


@dataclass(frozen=True)
class StandIn:
    name: str
    tables: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    join_on: str | None = None          # equi-join condition when two tables
    where: str | None = None
    extra: dict = field(default_factory=dict)


def _cols(*pairs: tuple[str, str]) -> tuple[tuple[str, str], ...]:
    return tuple(pairs)


APPLICATION = StandIn(
    "v_app", ("customer",),
    _cols(
        ("SK_ID_CURR", "c_custkey"),
        ("TARGET", "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT)"),
        ("NAME_CONTRACT_TYPE", "CASE WHEN c_custkey % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END"),
        ("CODE_GENDER", "CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END"),
        ("FLAG_OWN_CAR", "CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END"),
        ("AMT_INCOME_TOTAL", "CAST(50000 + (c_custkey * 7919) % 200000 AS DOUBLE)"),
        ("AMT_CREDIT", "(c_acctbal + 1000) * 50"),
        ("AMT_ANNUITY", "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_acctbal + 1000) * 2.5 END"),
        ("AMT_GOODS_PRICE", "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_acctbal + 1000) * 45 END"),
        ("NAME_EDUCATION_TYPE", "CASE c_nationkey % 5 WHEN 0 THEN 'Secondary / secondary special' "
                                "WHEN 1 THEN 'Higher education' WHEN 2 THEN 'Incomplete higher' "
                                "WHEN 3 THEN 'Lower secondary' ELSE 'Academic degree' END"),
        ("DAYS_BIRTH", "CAST(-(7000 + (c_custkey * 7919) % 18000) AS BIGINT)"),
        ("DAYS_EMPLOYED", "CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey % 4000) END AS BIGINT)"),
        ("OWN_CAR_AGE", "CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 20 AS DOUBLE) ELSE NULL END"),
        ("ORGANIZATION_TYPE", "CASE WHEN c_custkey % 11 = 0 THEN 'XNA' ELSE c_mktsegment END"),
        ("HOUR_APPR_PROCESS_START", "CAST(c_custkey % 24 AS INT)"),
        ("EXT_SOURCE_1", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (CAST(c_nationkey AS DOUBLE) + 0.5) / 25 END"),
        ("EXT_SOURCE_2", "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE (c_acctbal + 1000) / 11000 END"),
        ("EXT_SOURCE_3", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 37) % 1000 AS DOUBLE) / 1000 END"),
    ),
)

BUREAU = StandIn(
    "v_bur", ("orders",),
    _cols(
        ("SK_ID_BUREAU", "o_orderkey"),
        ("SK_ID_CURR", "o_custkey * (1 - 2 * CAST(o_custkey % 10 = 3 AS INT))"),
        ("CREDIT_ACTIVE", "CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active' "
                          "WHEN o_orderkey % 5 = 0 THEN 'Bad debt' ELSE 'Sold' END"),
        ("CREDIT_CURRENCY", "CASE WHEN o_orderkey % 37 = 0 THEN 'currency 2' WHEN o_orderkey % 101 = 0 "
                            "THEN 'currency 3' ELSE 'currency 1' END"),
        ("CREDIT_TYPE", "CASE WHEN o_orderkey % 17 = 0 THEN NULL "
                        "WHEN o_orderkey % 12 < 4 THEN 'Consumer credit' "
                        "WHEN o_orderkey % 12 < 6 THEN 'Credit card' "
                        "WHEN o_orderkey % 12 = 6 THEN 'Car loan' "
                        "WHEN o_orderkey % 12 = 7 THEN 'Mortgage' "
                        "WHEN o_orderkey % 12 = 8 THEN 'Microloan' "
                        "WHEN o_orderkey % 12 = 9 THEN 'Loan for business development' "
                        "WHEN o_orderkey % 12 = 10 THEN 'Another type of loan' "
                        "WHEN o_orderpriority = '1-URGENT' THEN 'Cash loan (non-earmarked)' "
                        "ELSE 'Unknown type of loan' END"),
        ("DAYS_CREDIT", "DAYS[o_orderdate]"),
        ("DAYS_CREDIT_ENDDATE", "CASE WHEN o_orderkey % 15 = 0 THEN NULL "
                                "ELSE DAYS[o_orderdate] + o_orderkey % 3000 - 500 END"),
        ("DAYS_ENDDATE_FACT", "CASE WHEN o_orderstatus = 'F' THEN DAYS[o_orderdate] + o_orderkey % 700 ELSE NULL END"),
        ("DAYS_CREDIT_UPDATE", "DAYS[o_orderdate] + o_orderkey % 90"),
        ("CREDIT_DAY_OVERDUE", "CAST(CASE WHEN o_orderkey % 19 = 0 THEN o_orderkey % 90 ELSE 0 END AS BIGINT)"),
        ("CNT_CREDIT_PROLONG", "CAST(CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS BIGINT)"),
        ("AMT_CREDIT_MAX_OVERDUE", "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice * 0.02 END"),
        ("AMT_CREDIT_SUM", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END"),
        ("AMT_CREDIT_SUM_DEBT", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice * 0.3 END"),
        ("AMT_CREDIT_SUM_LIMIT", "CASE WHEN o_orderkey % 3 <> 0 THEN NULL ELSE o_totalprice * 0.1 END"),
        ("AMT_CREDIT_SUM_OVERDUE", "CASE WHEN o_orderkey % 19 = 0 THEN o_totalprice * 0.05 ELSE CAST(0 AS DOUBLE) END"),
        ("AMT_ANNUITY", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 36 END"),
    ),
)

BUREAU_BALANCE = StandIn(
    "v_bal", ("lineitem",),
    _cols(
        ("SK_ID_BUREAU", "l_orderkey"),
        ("MONTHS_BALANCE", "CAST(1 - l_linenumber AS INT)"),
        ("STATUS", "CASE WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'N' THEN 'X' "
                   "ELSE CAST(l_linenumber % 6 AS STRING) END"),
    ),
)

INSTALLMENTS = StandIn(
    "v_inst", ("lineitem", "orders"),
    _cols(
        ("SK_ID_PREV", "o_orderkey"),
        ("SK_ID_CURR", "o_custkey * (1 - 2 * CAST(o_custkey % 10 = 4 AS INT))"),
        ("NUM_INSTALMENT_VERSION", "CAST(l_linenumber % 2 AS DOUBLE)"),
        ("NUM_INSTALMENT_NUMBER", "l_linenumber"),
        ("DAYS_INSTALMENT", "DAYS[o_orderdate]"),
        ("DAYS_ENTRY_PAYMENT", "CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE DAYS[l_shipdate] END"),
        ("AMT_INSTALMENT", "l_extendedprice"),
        ("AMT_PAYMENT", "CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) END"),
    ),
    join_on="l_orderkey = o_orderkey",
)

CASH = StandIn(
    "v_cash", ("lineitem", "orders"),
    _cols(
        ("SK_ID_PREV", "o_orderkey"),
        ("SK_ID_CURR", "o_custkey * (1 - 2 * CAST(o_custkey % 10 = 5 AS INT))"),
        ("MONTHS_BALANCE", "CAST(-l_linenumber AS INT)"),
        ("CNT_INSTALMENT", "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Completed' END"),
        ("SK_DPD", "CAST(greatest(DIFF[l_shipdate,o_orderdate] - 1500, 0) AS BIGINT)"),
        ("SK_DPD_DEF", "CAST(greatest(DIFF[l_shipdate,o_orderdate] - 1900, 0) AS BIGINT)"),
    ),
    join_on="l_orderkey = o_orderkey",
)

CARD = StandIn(
    "v_cred", ("events",),
    _cols(
        ("SK_ID_PREV", "event_id % 7"),
        ("SK_ID_CURR", "user_id"),
        ("MONTHS_BALANCE", "CAST(-(event_id % 5) AS INT)"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'Active' ELSE 'Completed' END"),
        ("SK_DPD", "CASE WHEN event_type = 'error' THEN event_id % 40 ELSE 0 END"),
        ("SK_DPD_DEF", "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN event_id % 10 ELSE 0 END"),
        ("AMT_BALANCE", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END"),
        ("AMT_CREDIT_LIMIT_ACTUAL", "value * 10"),
        ("AMT_DRAWINGS_ATM_CURRENT", "CASE WHEN event_type = 'click' THEN value ELSE NULL END"),
        ("AMT_DRAWINGS_CURRENT", "CASE WHEN event_type IN ('click', 'purchase') THEN value ELSE CAST(0 AS DOUBLE) END"),
        ("AMT_DRAWINGS_OTHER_CURRENT", "CASE WHEN event_id % 11 = 0 THEN value ELSE NULL END"),
        ("AMT_DRAWINGS_POS_CURRENT", "CASE WHEN event_type = 'purchase' THEN value ELSE NULL END"),
        ("AMT_INST_MIN_REGULARITY", "value * 0.05"),
        ("AMT_PAYMENT_CURRENT", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 0.5 END"),
        ("AMT_PAYMENT_TOTAL_CURRENT", "value * 0.5"),
        ("AMT_RECEIVABLE_PRINCIPAL", "value * 0.8"),
        ("AMT_RECIVABLE", "value * 0.9"),
        ("AMT_TOTAL_RECEIVABLE", "value * 0.95"),
        ("CNT_DRAWINGS_ATM_CURRENT", "CASE WHEN event_type = 'click' THEN CAST(event_id % 3 AS DOUBLE) ELSE NULL END"),
        ("CNT_DRAWINGS_CURRENT", "CAST(event_id % 4 AS DOUBLE)"),
        ("CNT_DRAWINGS_OTHER_CURRENT", "CASE WHEN event_id % 11 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"),
        ("CNT_DRAWINGS_POS_CURRENT", "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 5 AS DOUBLE) ELSE NULL END"),
    ),
)

PREVIOUS = StandIn(
    "v_prev", ("orders",),
    _cols(
        ("SK_ID_PREV", "o_orderkey"),
        ("SK_ID_CURR", "o_custkey * (1 - 2 * CAST(o_custkey % 10 = 6 AS INT))"),
        ("NAME_CONTRACT_TYPE", "CASE WHEN o_orderkey % 41 = 0 THEN 'XNA' WHEN o_orderkey % 3 = 0 THEN 'Consumer loans' "
                               "WHEN o_orderkey % 3 = 1 THEN 'Cash loans' ELSE 'Revolving loans' END"),
        ("NAME_CONTRACT_STATUS", "CASE WHEN o_orderkey % 13 = 0 THEN 'Unused offer' WHEN o_orderstatus = 'F' "
                                 "THEN 'Refused' WHEN o_orderstatus = 'O' THEN 'Approved' ELSE 'Canceled' END"),
        ("AMT_ANNUITY", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 24 END"),
        ("AMT_APPLICATION", "o_totalprice"),
        ("AMT_CREDIT", "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice * 0.9 END"),
        ("AMT_DOWN_PAYMENT", "CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 0.1 ELSE NULL END"),
        ("AMT_GOODS_PRICE", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice * 0.95 END"),
        ("WEEKDAY_APPR_PROCESS_START", "CASE o_orderkey % 7 WHEN 0 THEN 'MONDAY' WHEN 1 THEN 'TUESDAY' "
                                       "WHEN 2 THEN 'WEDNESDAY' WHEN 3 THEN 'THURSDAY' WHEN 4 THEN 'FRIDAY' "
                                       "WHEN 5 THEN 'SATURDAY' ELSE 'SUNDAY' END"),
        ("HOUR_APPR_PROCESS_START", "CAST(o_orderkey % 24 AS INT)"),
        ("FLAG_LAST_APPL_PER_CONTRACT", "CASE WHEN o_orderkey % 50 = 0 THEN 'N' ELSE 'Y' END"),
        ("NFLAG_LAST_APPL_IN_DAY", "CAST(CASE WHEN o_orderkey % 60 = 0 THEN 0 ELSE 1 END AS INT)"),
        ("RATE_DOWN_PAYMENT", "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 100 AS DOUBLE) / 1000 ELSE NULL END"),
        ("RATE_INTEREST_PRIMARY", "CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_orderkey % 50 AS DOUBLE) / 100 ELSE NULL END"),
        ("RATE_INTEREST_PRIVILEGED", "CASE WHEN o_orderkey % 89 = 0 THEN CAST(o_orderkey % 40 AS DOUBLE) / 100 ELSE NULL END"),
        ("NAME_CASH_LOAN_PURPOSE", "CASE WHEN o_orderkey % 3 <> 1 THEN 'XAP' WHEN o_orderkey % 29 = 0 THEN 'XNA' "
                                   "WHEN o_orderpriority = '1-URGENT' THEN 'Repairs' "
                                   "WHEN o_orderpriority = '2-HIGH' THEN 'Urgent needs' "
                                   "WHEN o_orderpriority = '3-MEDIUM' THEN 'Other' "
                                   "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Buying a used car' "
                                   "ELSE 'Payments on other loans' END"),
        ("DAYS_DECISION", "DAYS[o_orderdate]"),
        ("NAME_PAYMENT_TYPE", "CASE o_orderkey % 4 WHEN 0 THEN 'Cash through the bank' WHEN 1 THEN 'XNA' "
                              "WHEN 2 THEN 'Non-cash from your account' "
                              "ELSE 'Cashless from the account of the employer' END"),
        ("CODE_REJECT_REASON", "CASE WHEN o_orderstatus <> 'F' THEN 'XAP' WHEN o_orderkey % 3 = 0 THEN 'HC' "
                               "WHEN o_orderkey % 3 = 1 THEN 'LIMIT' ELSE 'SCO' END"),
        ("NAME_TYPE_SUITE", "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'Family' "
                            "WHEN o_orderkey % 6 = 2 THEN 'Spouse, partner' WHEN o_orderkey % 6 = 3 "
                            "THEN 'Group of people' ELSE 'Unaccompanied' END"),
        ("NAME_CLIENT_TYPE", "CASE o_orderkey % 5 WHEN 0 THEN 'New' WHEN 1 THEN 'Refreshed' WHEN 2 THEN 'XNA' "
                             "ELSE 'Repeater' END"),
        ("NAME_GOODS_CATEGORY", "CASE WHEN o_orderkey % 3 = 1 THEN 'XNA' WHEN o_orderkey % 8 = 0 THEN 'Mobile' "
                                "WHEN o_orderkey % 8 = 1 THEN 'Consumer Electronics' "
                                "WHEN o_orderkey % 8 = 2 THEN 'Computers' WHEN o_orderkey % 8 = 3 THEN 'Audio/Video' "
                                "WHEN o_orderkey % 8 = 4 THEN 'Furniture' "
                                "WHEN o_orderkey % 8 = 5 THEN 'Photo / Cinema Equipment' "
                                "WHEN o_orderkey % 8 = 6 THEN 'Construction Materials' "
                                "ELSE 'Clothing and Accessories' END"),
        ("NAME_PORTFOLIO", "CASE WHEN o_orderkey % 3 = 0 THEN 'POS' WHEN o_orderkey % 3 = 1 THEN 'Cash' "
                           "WHEN o_orderkey % 11 = 0 THEN 'Cars' WHEN o_orderkey % 7 = 0 THEN 'XNA' ELSE 'Cards' END"),
        ("NAME_PRODUCT_TYPE", "CASE WHEN o_orderkey % 4 = 0 THEN 'x-sell' WHEN o_orderkey % 4 = 1 THEN 'walk-in' "
                              "ELSE 'XNA' END"),
        ("CHANNEL_TYPE", "CASE o_orderkey % 5 WHEN 0 THEN 'Credit and cash offices' WHEN 1 THEN 'Country-wide' "
                         "WHEN 2 THEN 'Stone' WHEN 3 THEN 'Regional / Local' ELSE 'AP+ (Cash loan)' END"),
        ("SELLERPLACE_AREA", "CAST(CASE WHEN o_orderkey % 9 = 0 THEN -1 ELSE o_orderkey % 500 END AS INT)"),
        ("NAME_SELLER_INDUSTRY", "CASE o_orderkey % 6 WHEN 0 THEN 'XNA' WHEN 1 THEN 'Consumer electronics' "
                                 "WHEN 2 THEN 'Connectivity' WHEN 3 THEN 'Furniture' WHEN 4 THEN 'Construction' "
                                 "ELSE 'Clothing' END"),
        ("CNT_PAYMENT", "CAST(6 * (1 + o_orderkey % 8) AS DOUBLE)"),
        ("NAME_YIELD_GROUP", "CASE o_orderkey % 5 WHEN 0 THEN 'middle' WHEN 1 THEN 'low_action' WHEN 2 THEN 'high' "
                             "WHEN 3 THEN 'low_normal' ELSE 'XNA' END"),
        ("PRODUCT_COMBINATION", "CASE o_orderkey % 6 WHEN 0 THEN 'POS mobile with interest' "
                                "WHEN 1 THEN 'Cash X-Sell: low' WHEN 2 THEN 'Cash Street: high' "
                                "WHEN 3 THEN 'Card Street' WHEN 4 THEN 'POS household without interest' "
                                "ELSE 'Cash' END"),
        ("NFLAG_INSURED_ON_APPROVAL", "CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey % 2 AS DOUBLE) ELSE NULL END"),
    ),
)

SCORES = StandIn(
    "v_score", ("lineitem",),
    _cols(
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
        ("label", "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT)"),
        ("score", "CAST(0.05 AS DOUBLE) + 9 * l_discount"),
    ),
)

ALL = {s.name: s for s in (APPLICATION, BUREAU, BUREAU_BALANCE, INSTALLMENTS, CASH, CARD, PREVIOUS, SCORES)}

_DAYS = re.compile(r"DAYS\[(\w+)\]")
_DIFF = re.compile(r"DIFF\[(\w+),(\w+)\]")


def render(expr: str, dialect: str) -> str:
    """Expand the two date tokens for ``spark`` or ``duckdb``."""
    if dialect == "spark":
        expr = _DAYS.sub(rf"CAST(datediff(CAST(\1 AS DATE), DATE'{REF_DATE}') AS BIGINT)", expr)
        return _DIFF.sub(r"CAST(datediff(CAST(\1 AS DATE), CAST(\2 AS DATE)) AS BIGINT)", expr)
    expr = _DAYS.sub(rf"CAST(date_diff('day', DATE '{REF_DATE}', CAST(\1 AS DATE)) AS BIGINT)", expr)
    return _DIFF.sub(r"CAST(date_diff('day', CAST(\2 AS DATE), CAST(\1 AS DATE)) AS BIGINT)", expr)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, view: str, derived: Mapping[str, str] | None = None) -> DataFrame:
    """Spark DataFrame of one stand-in view, plus ``derived`` columns: SQL expressions over the view's columns."""
    spec = ALL[view]
    frames = [read_table(spark, sf_dir, t) for t in spec.tables]
    df = frames[0]
    exprs = {c: render(e, "spark") for c, e in spec.columns}
    derived = derived or {}
    whole = exprs | {c: _inlined(e, exprs) for c, e in derived.items()}
    if len(frames) == 2:
        # what one table alone decides is computed before the join, which then shuffles no raw column only it reads
        for i, frame in enumerate(frames):
            own = {c: e for c, e in whole.items() if _reads_only(e, frame, frames[1 - i])}
            frames[i] = frame.selectExpr("*", *[f"{e} AS `{_EARLY}{c}`" for c, e in own.items()])
            exprs |= {c: f"`{_EARLY}{c}`" for c in own}
        df = frames[0].join(frames[1], on=_join_expr(spec.join_on, frames[0], frames[1]), how="inner")
    if spec.where:
        df = df.where(spec.where)
    exprs = {c: _inlined(e, exprs) for c, e in derived.items()} | exprs      # what both tables decide reads the early columns
    return df.selectExpr(*[f"{exprs[c]} AS `{c}`" for c in whole])


_EARLY = "_early_"      # a view's column computed before its join


def _inlined(expr: str, exprs: Mapping[str, str]) -> str:
    """``expr`` over columns of a view, with their expressions in place of their names."""
    return re.sub(r"\w+", lambda w: f"({exprs[w[0]]})" if w[0] in exprs else w[0], expr)


def _reads_only(expr: str, frame: DataFrame, other: DataFrame) -> bool:
    words = set(re.findall(r"\w+", expr))
    if expr in words:       # a column as it is
        return False
    return bool(words & set(frame.columns)) and not words & set(other.columns)


def _join_expr(cond: str, left: DataFrame, right: DataFrame):
    a, b = [s.strip() for s in cond.split("=")]
    return left[a] == right[b]


def cte(view: str) -> str:
    """DuckDB CTE body for one stand-in view."""
    spec = ALL[view]
    cols = ",\n    ".join(f'{render(e, "duckdb")} AS "{c}"' for c, e in spec.columns)
    src = spec.tables[0]
    if len(spec.tables) == 2:
        src = f"{spec.tables[0]} JOIN {spec.tables[1]} ON {spec.join_on}"
    where = f"\n  WHERE {spec.where}" if spec.where else ""
    return f"{view} AS (\n  SELECT\n    {cols}\n  FROM {src}{where}\n)"


class LoanTables:
    """Lazy accessors for the seven loan tables plus the score table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _get(self, view, derived=None):
        return load(self.spark, self.sf_dir, view, derived)

    app = property(lambda self: self._get("v_app"))
    bureau = property(lambda self: self._get("v_bur"))
    balance = property(lambda self: self._get("v_bal"))
    inst = property(lambda self: self._get("v_inst"))
    inst_derived = property(lambda self: self._get("v_inst", INST_DERIVED))     # derived before the view's join
    cash = property(lambda self: self._get("v_cash"))
    card = property(lambda self: self._get("v_cred"))
    prev = property(lambda self: self._get("v_prev"))
    scores = property(lambda self: self._get("v_score"))
