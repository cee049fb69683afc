"""Child-to-parent feature aggregation.

Every operator here is one ``groupBy(key).agg(...)`` with conditional
aggregates in place of the reference's "filter, aggregate, join back"
pattern: one scan and one shuffle per table. Spark plans the aggregation as
partial (map-side) + final, so a client holding a third of all rows is
combined on every mapper before the shuffle and never lands whole in one task.
Null grouping keys are dropped first (pandas ``groupby`` drops them).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import agg_name, positive_flag, recode_status
from ..roles import INST_DERIVED
from ..session import ensure_checkpoint_dir
from .ranking import exact_quantiles

KEY = "SK_ID_CURR"
LOAN = "SK_ID_BUREAU"

# Fixed vocabularies of the one-hot families the reference sums (text as in the data).
BUREAU_CREDIT_ACTIVE = ["Closed", "Active", "Sold", "Bad debt"]
BUREAU_CREDIT_TYPES = ["Consumer credit", "Credit card", "Mortgage", "Car loan", "Microloan",
                       "Loan for business development"]
PREV_CONTRACT_TYPES = ["Consumer loans", "Cash loans", "Revolving loans"]
PREV_CONTRACT_STATUSES = ["Approved", "Refused", "Canceled", "Unused offer"]
PREV_PORTFOLIOS = ["POS", "Cash", "Cards"]
PREV_PRODUCT_TYPES = ["x-sell", "walk-in"]
PREV_YIELD_GROUPS = ["middle", "low_action", "high", "low_normal"]

_STATS = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
    "count": F.count,
    "nunique": F.count_distinct,
    "median": F.median,
    "sum": F.sum,
}


def stat(column: str | Column, how: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return _STATS[how](c)


def spec_aggs(prefix: str, spec: Sequence[tuple[str, Sequence[str]]], few: Mapping[str, list] | None = None) -> list[Column]:
    """``[(column, [stats])]`` -> aliased aggregates ``prefix_column_stat``; distinct counts of the columns in ``few``
    (``few_values``) take no shuffle of their own."""
    few = few or {}
    return [(distinct_of_few(c, few[c]) if s == "nunique" and c in few else stat(F.col(f"`{c}`"), s)).alias(agg_name(prefix, c, s))
            for c, stats in spec for s in stats]


FEW = 63  # distinct values that the bits of one long stand for


def few_values(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """The distinct values (no NULL) of every column that has at most ``FEW``, from one scan; other columns are left out.
    At most ``FEW`` values a column reach the driver."""
    found = {}
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(cols)])).alias("r"))
    rows = cells.select("r.*").where("v is not null").distinct().limit(FEW * len(cols) + 1).collect()
    if len(rows) > FEW * len(cols):                     # which columns have few is not known
        return found
    for i, c in enumerate(cols):
        values = sorted(r["v"] for r in rows if r["i"] == i)
        if 0 < len(values) <= FEW:
            found[c] = values
    return found


def distinct_of_few(column: str, values: Sequence) -> Column:
    """Exact distinct count of a column that holds no value outside ``values``: one bit a value, or-ed. A plain
    aggregate, where ``count(distinct)`` of several columns repeats every row once a column with all its buffers."""
    c = F.col(f"`{column}`")
    bit = F.coalesce(*[F.when(c == v, F.lit(1 << i).cast("bigint")) for i, v in enumerate(values)])
    return F.coalesce(F.bit_count(F.bit_or(bit)).cast("bigint"), F.lit(0).cast("bigint"))


def keyed(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def count_true(cond: Column) -> Column:
    """Count of rows where ``cond`` holds; 0 (not NULL) when none do."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def one_hot_counts(column: str, vocab: Iterable[str], prefix: str, suffix: str = "_sum",
                   infrequent: str | None = None) -> list[Column]:
    """Per-key counts of each category of a fixed vocabulary; optionally one more
    count for every row outside it (missing included)."""
    vocab = list(vocab)
    c = F.col(column)
    out = [count_true(c == v).alias(f"{prefix}{column}_{v}{suffix}".replace(" ", "_")) for v in vocab]
    if infrequent:
        out.append(count_true(~c.isin(vocab) | c.isNull()).alias(infrequent))
    return out


def active_count_at_month(key_col: str = "SK_ID_PREV", month: int = -1, status: str = "Active",
                          name: str = "Status_Active_count") -> Column:
    """Non-null ``key_col`` count of rows at ``month`` with ``status``; NULL when
    the client has no such row (the reference left-joins a filtered count)."""
    cond = (F.col("MONTHS_BALANCE") == month) & (F.col("NAME_CONTRACT_STATUS") == status)
    return F.when(count_true(cond) > 0, F.count(F.when(cond, F.col(key_col)))).alias(name)


# ---------------------------------------------------------------- bureau balance

def _status_stats(s: Column) -> list[Column]:
    open_s = F.when(s != -1, s)  # closed months (C) excluded; X (NULL) adds nothing
    return [F.avg(open_s).alias("STATUS_mean"), F.stddev_samp(open_s).alias("STATUS_std"),
            F.max(open_s).alias("STATUS_max")]


MONTH_ZERO_STATUSES = 16  # statuses of month 0 that each take a count of their own


def balance_status_features(balance: DataFrame) -> DataFrame:
    """Per loan: status at month 0 (``STATUS_last``) plus mean/std/max of the
    status over months that were not closed.

    A loan whose rows are all closed and which has no month-0 row is absent; a
    loan with several month-0 rows yields one row per month-0 row (the
    reference's outer merge). A loan of any length becomes a few counts on the
    map side; the statistics and the month-0 rows both follow from them. The
    statuses that month 0 holds are read first: when they are few, each has its
    count per loan in one aggregate, else rows are counted by (loan, status, is
    month 0) and the counts of a loan collected.
    """
    s, n = F.col("S"), F.col("n")
    is_open = s.isNotNull() & (s != -1)                  # X (NULL) counts as open but adds no value
    rows = balance.select(LOAN, recode_status("STATUS").alias("S"), F.coalesce(F.col("MONTHS_BALANCE") == 0, F.lit(False)).alias("now"))
    statuses = [r["S"] for r in rows.where("now").select("S").distinct().limit(MONTH_ZERO_STATUSES + 1).collect()]
    if 0 < len(statuses) <= MONTH_ZERO_STATUSES:
        rows = rows.withColumn("n", F.lit(1).cast("bigint"))
        held = [F.lit(v).cast("double") for v in statuses]
        last = [count_true(F.col("now") & s.eqNullSafe(v)).alias(f"n{i}") for i, v in enumerate(held)]
        listed = F.filter(F.array(*[F.struct(v.alias("S"), F.col(f"n{i}").alias("n")) for i, v in enumerate(held)]), lambda x: x["n"] > 0)
    else:
        rows = rows.groupBy(LOAN, "S", "now").agg(F.count(F.lit(1)).alias("n"))
        last = [F.collect_list(F.when(F.col("now"), F.struct("S", "n"))).alias("n0")]       # at most one entry per status
        listed = F.col("n0")
    loans = rows.groupBy(LOAN).agg(
        F.sum(F.when(is_open, n)).alias("N"), F.sum(F.when(is_open, n * s)).alias("T"),
        F.sum(F.when(is_open, n * s * s)).alias("Q"), F.max(F.when(is_open, s)).alias("STATUS_max"),
        count_true(is_open | s.isNull()).alias("open"), *last).withColumn("last", listed)
    N, total = F.col("N"), F.col("T")
    loans = loans.where((F.col("open") > 0) | (F.size("last") > 0)).select(
        LOAN, F.explode_outer("last").alias("l"), (total / N).alias("STATUS_mean"),
        F.when(N > 1, F.sqrt(F.greatest(N * F.col("Q") - total * total, F.lit(0.0)) / N / (N - 1))).alias("STATUS_std"), "STATUS_max")
    block = 1 << 16                                      # repeats come in blocks, so no array grows with a loan
    times = F.coalesce(F.col("l.n"), F.lit(1))
    loans = loans.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / block))))
    loans = loans.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(block).cast("bigint"), times - F.col("b") * block))))
    return loans.select(LOAN, F.col("l.S").alias("STATUS_last"), "STATUS_mean", "STATUS_std", "STATUS_max")


def balance_latest_status(balance: DataFrame) -> DataFrame:
    """Author's stated fix: status of the latest month instead of month 0.

    One aggregation: ``max_by`` over an order key of (month, status) gives a
    deterministic pick when months repeat, and keeps a NULL (X) status.
    Every loan with any row appears.
    """
    clean = balance.select(LOAN, "MONTHS_BALANCE", recode_status("STATUS").alias("S"))
    order = F.col("MONTHS_BALANCE").cast("bigint") * 100 + F.coalesce(F.col("S"), F.lit(-2.0)).cast("bigint")
    return (clean.groupBy(LOAN)
            .agg(F.max("MONTHS_BALANCE").alias("MONTHS_BALANCE_latest"),
                 F.max_by(F.col("S"), order).alias("STATUS_latest"),
                 *_status_stats(F.col("S"))))


def balance_recent_status(balance: DataFrame, months: int = 6) -> DataFrame:
    """Per loan: status features over its latest ``months`` months.

    ``RECENT_n`` months found, ``RECENT_mean`` / ``RECENT_max`` of the status
    over open rows, ``RECENT_late`` rows one month late or more,
    ``RECENT_closed`` rows of closed months, ``RECENT_change`` mean status of
    the newer half of those months minus that of the older half (NULL where a
    half holds no status).

    Rows are counted by (loan, month, status) first, combined map-side. The
    dense rank of the months is cut at ``months`` before the shuffle too, so a
    loan of any length sends a few counts from each task and no window sees its
    rows. Rows without a month are left out.
    """
    s, n = F.col("S"), F.col("n")
    counts = (balance.where(F.col("MONTHS_BALANCE").isNotNull()).select(LOAN, "MONTHS_BALANCE", recode_status("STATUS").alias("S"))
              .groupBy(LOAN, "MONTHS_BALANCE", "S").agg(F.count(F.lit(1)).alias("n")))
    latest = Window.partitionBy(LOAN).orderBy(F.desc("MONTHS_BALANCE"))
    recent = counts.withColumn("k", F.dense_rank().over(latest)).where(F.col("k") <= months)
    is_open = s.isNotNull() & (s != -1)

    def mean(cond: Column) -> Column:
        return F.sum(F.when(cond, n * s)) / F.sum(F.when(cond, n))
    half = F.col("k") <= months // 2
    return recent.groupBy(LOAN).agg(
        F.max("k").alias("RECENT_n"), mean(is_open).alias("RECENT_mean"), F.max(F.when(is_open, s)).alias("RECENT_max"),
        F.sum(F.when(s >= 1, n).otherwise(0)).alias("RECENT_late"), F.sum(F.when(s == -1, n).otherwise(0)).alias("RECENT_closed"),
        (mean(is_open & half) - mean(is_open & ~half)).alias("RECENT_change"))


def outer_merge(left: DataFrame, right: DataFrame, key: str = LOAN) -> DataFrame:
    """The rows of a full outer join on ``key``, as a left outer join and an anti
    join, which AQE can split at a hot key (it cannot split a full outer join).
    That takes a bare shuffle on both sides, so ``right``, the narrow aggregated
    side, is written first (reliable checkpoint) and computed once for both."""
    ensure_checkpoint_dir(left.sparkSession)
    features = right.checkpoint()
    known = left.join(features, on=key, how="left")
    unknown = features.join(left.select(key), on=key, how="left_anti")
    return known.unionByName(unknown, allowMissingColumns=True)


def month_zero_status(balance: DataFrame) -> DataFrame:
    """Per row of month 0 the loan and its status (``STATUS_last``)."""
    return balance.where(F.col("MONTHS_BALANCE") == 0).select(LOAN, recode_status("STATUS").alias("STATUS_last"))


def open_status_stats(balance: DataFrame) -> DataFrame:
    """Per loan mean/std/max of the status over months that were not closed."""
    clean = balance.select(LOAN, recode_status("STATUS").alias("S")).where("S <> -1 or S is null")
    return clean.groupBy(LOAN).agg(*_status_stats(F.col("S")))


def merge_last_and_stats(last: DataFrame, stats: DataFrame) -> DataFrame:
    """Month-0 rows with the statistics of their loan, and the statistics of
    loans without a month-0 row (``balance_status_features`` gives the same from
    one scan)."""
    return outer_merge(last, stats, LOAN)


def merge_balance_into_bureau(bureau: DataFrame, balance_features: DataFrame) -> DataFrame:
    """Bureau loans with per-loan status features, and the features of loans the
    bureau table does not hold."""
    return outer_merge(bureau, balance_features, LOAN)


# ---------------------------------------------------------------- bureau

BUREAU_SPEC = [
    ("CREDIT_CURRENCY", ["nunique"]),
    ("DAYS_CREDIT", ["min", "mean"]),
    ("AMT_CREDIT_SUM", ["mean", "max"]),
    ("AMT_CREDIT_SUM_DEBT", ["mean", "max"]),
    ("AMT_CREDIT_SUM_LIMIT", ["mean", "max"]),
    ("AMT_CREDIT_SUM_OVERDUE", ["mean", "max"]),
    ("CREDIT_TYPE", ["nunique"]),
    ("AMT_ANNUITY", ["mean", "max"]),
    ("STATUS_mean", ["mean"]),
    ("STATUS_std", ["mean"]),
    ("STATUS_max", ["mean"]),
    ("STATUS_last", ["mean"]),
]


def bureau_features(bureau_merged: DataFrame, prefix: str = "bur", extra: Sequence[Column] = (),
                    values: DataFrame | None = None) -> DataFrame:
    """Per client: 33 bureau features (amount stats, distinct counts, status
    means, category counts, overdue/prolong flags, positive end-date stats).

    ``values``: the bureau rows before the merge, which hold every value of the
    columns counted distinct. With it those with few values are counted by bits."""
    few = few_values(values, [c for c, stats in BUREAU_SPEC if "nunique" in stats]) if values is not None else {}
    end = F.col("DAYS_CREDIT_ENDDATE")
    end_pos = F.when(end > 0, end)
    aggs = spec_aggs(prefix, BUREAU_SPEC, few)
    aggs += one_hot_counts("CREDIT_ACTIVE", BUREAU_CREDIT_ACTIVE, f"{prefix}_")
    aggs += [count_true(positive_flag("CREDIT_DAY_OVERDUE")).alias(f"{prefix}_Has_overdue_sum"),
             count_true(positive_flag("CNT_CREDIT_PROLONG")).alias(f"{prefix}_Has_prolong_sum")]
    types = one_hot_counts("CREDIT_TYPE", BUREAU_CREDIT_TYPES, f"{prefix}_",
                           infrequent=f"{prefix}_CREDIT_TYPE_infrequent_sum")
    renamed = {f"{prefix}_CREDIT_TYPE_Loan_for_business_development_sum": f"{prefix}_CREDIT_TYPE_business_sum"}
    aggs += types
    aggs += [F.avg(end_pos).alias(f"{prefix}_DAYS_CREDIT_ENDDATE_mean"),
             F.max(end_pos).alias(f"{prefix}_DAYS_CREDIT_ENDDATE_max")]
    return keyed(bureau_merged).groupBy(KEY).agg(*aggs, *extra).withColumnsRenamed(renamed)


def bureau_and_latest_features(bureau_merged: DataFrame, days: int = 365, prefix: str = "bur",
                               lat_prefix: str = "bur_lat", values: DataFrame | None = None) -> DataFrame:
    """``bureau_features`` and ``bureau_latest_features`` in one scan and one
    shuffle: the last-year features become conditional aggregates, NULL for a
    client without a last-year loan (what the left join onto the application
    gives when the two tables are built apart)."""
    recent = F.col("DAYS_CREDIT") >= -days
    has_recent = count_true(recent) > 0
    lat = [F.when(has_recent, F.count(F.when(recent, F.col("DAYS_CREDIT")))).alias(f"{lat_prefix}_DAYS_CREDIT")]
    lat += [F.avg(F.when(recent, F.col(c))).alias(f"{lat_prefix}_{c}") for c in BUREAU_LATEST_SPEC]
    return bureau_features(bureau_merged, prefix, extra=lat, values=values)


BUREAU_LATEST_SPEC = ["CREDIT_DAY_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM",
                      "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE"]


def bureau_latest_features(bureau_merged: DataFrame, days: int = 365, prefix: str = "bur_lat") -> DataFrame:
    """Last-year loans only; names carry no stat suffix (``bur_lat_DAYS_CREDIT``
    is a count). The day filter reaches the parquet scan."""
    recent = keyed(bureau_merged).where(F.col("DAYS_CREDIT") >= -days)
    return recent.groupBy(KEY).agg(
        F.count("DAYS_CREDIT").alias(f"{prefix}_DAYS_CREDIT"),
        *[F.avg(c).alias(f"{prefix}_{c}") for c in BUREAU_LATEST_SPEC])


# ---------------------------------------------------------------- cash, instalments, card

def cash_features(cash: DataFrame, prefix: str = "cash") -> DataFrame:
    return keyed(cash).groupBy(KEY).agg(
        *spec_aggs(prefix, [("SK_ID_PREV", ["nunique", "count"]), ("CNT_INSTALMENT", ["max"]),
                            ("SK_DPD", ["mean", "max"])]),
        count_true(positive_flag("SK_DPD")).alias(f"{prefix}_Has_overdue_sum"),
        *spec_aggs(prefix, [("SK_DPD_DEF", ["mean", "max"])]),
        count_true(positive_flag("SK_DPD_DEF")).alias(f"{prefix}_Has_overdue_def_sum"),
        active_count_at_month(name=f"{prefix}_Status_Active_count"),
    )


def _inst_derived(inst: DataFrame) -> DataFrame:
    """Adds the derived columns that ``inst`` does not bring along."""
    return keyed(inst).withColumns({c: F.expr(e) for c, e in INST_DERIVED.items() if c not in inst.columns})


def installment_features(inst: DataFrame, prefix: str = "inst") -> DataFrame:
    return _inst_derived(inst).groupBy(KEY).agg(*spec_aggs(prefix, [
        ("Days_till_deadline", ["mean", "max", "min"]),
        ("Amt_deficit", ["mean", "max"]),
        ("AMT_INSTALMENT", ["mean", "max"]),
    ]))


CARD_SPEC_TAIL = [
    ("AMT_BALANCE", ["median", "max"]),
    ("AMT_CREDIT_LIMIT_ACTUAL", ["median", "max"]),
    ("AMT_DRAWINGS_ATM_CURRENT", ["min", "max", "mean"]),
    ("AMT_DRAWINGS_CURRENT", ["min", "max", "mean"]),
    ("AMT_DRAWINGS_OTHER_CURRENT", ["mean", "max"]),
    ("AMT_DRAWINGS_POS_CURRENT", ["mean", "max"]),
    ("AMT_INST_MIN_REGULARITY", ["mean", "max"]),
    ("AMT_PAYMENT_CURRENT", ["mean", "max"]),
    ("AMT_PAYMENT_TOTAL_CURRENT", ["mean", "max"]),
    ("AMT_RECEIVABLE_PRINCIPAL", ["min", "max", "mean"]),
    ("AMT_RECIVABLE", ["min", "max", "mean"]),
    ("AMT_TOTAL_RECEIVABLE", ["min", "max", "mean"]),
    ("CNT_DRAWINGS_ATM_CURRENT", ["mean", "max"]),
    ("CNT_DRAWINGS_CURRENT", ["mean", "max"]),
    ("CNT_DRAWINGS_OTHER_CURRENT", ["mean", "max"]),
    ("CNT_DRAWINGS_POS_CURRENT", ["mean", "max"]),
]


HOT_ROWS = 1_000_000  # rows of one key that one task may sort


def grouped_medians(df: DataFrame, key: str, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of several columns per key. The rows of a key
    are ranked by windows in one task; keys with more than ``HOT_ROWS`` rows (at
    most one per that many rows of the table) go through one global ranking of
    (column, key, value) instead, which spreads a key over many tasks."""
    df = df.select(F.col(key), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    df = df.where(F.coalesce(*[F.col(n) for n in names]).isNotNull())
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(key)
    if hot.isEmpty():
        return _window_medians(df, key, names)
    hot = F.broadcast(hot)
    return _window_medians(df.join(hot, key, "left_anti"), key, names).unionByName(
        _ranked_medians(df.join(hot, key, "left_semi"), key, names))


def _window_medians(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    whole = Window.partitionBy(key)
    df = df.withColumns({f"_n{i}": F.count(n).over(whole) for i, n in enumerate(names)})
    for i, n in enumerate(names):
        df = df.withColumn(f"_r{i}", F.row_number().over(whole.orderBy(F.col(n).asc_nulls_last())) - 1)

    def median(i: int, n: str) -> Column:
        pos = F.lit(0.5) * (F.col(f"_n{i}") - 1)
        low, high = [F.max(F.when(F.col(f"_r{i}") == side(pos), F.col(n))) for side in (F.floor, F.ceil)]
        return (low + (high - low) * F.max(pos - F.floor(pos))).alias(n)
    return df.groupBy(key).agg(*[median(i, n) for i, n in enumerate(names)])


def _ranked_medians(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(n).alias("_c"), F.col(n).alias("_x")) for n in names])).alias("r")).select(key, "r.*")
    q = exact_quantiles(long, "_x", [0.5], groups=["_c", key])
    return q.groupBy(key).pivot("_c", list(names)).agg(F.first("q"))


def card_features(card: DataFrame, prefix: str = "cred", exact_skew_safe_median: bool = True) -> DataFrame:
    """45 card features + active count. The two medians are exact and
    interpolated; by default they come from ranks (skew-safe), else from
    Spark's ``median`` aggregate (one buffer of distinct values per key)."""
    keyed_card = keyed(card)
    medians = [(c, agg_name(prefix, c, "median")) for c, stats in CARD_SPEC_TAIL if "median" in stats]
    tail = CARD_SPEC_TAIL
    if exact_skew_safe_median:
        tail = [(c, [s for s in stats if s != "median"]) for c, stats in CARD_SPEC_TAIL]
    out = keyed_card.groupBy(KEY).agg(
        *spec_aggs(prefix, [("SK_ID_PREV", ["nunique", "count"]), ("SK_DPD", ["mean", "max"])]),
        count_true(positive_flag("SK_DPD")).alias(f"{prefix}_Has_overdue_sum"),
        *spec_aggs(prefix, [("SK_DPD_DEF", ["mean", "max"])]),
        count_true(positive_flag("SK_DPD_DEF")).alias(f"{prefix}_Has_overdue_def_sum"),
        *spec_aggs(prefix, tail),
        active_count_at_month(name=f"{prefix}_Status_Active_count"),
    )
    if exact_skew_safe_median and medians:
        med = grouped_medians(keyed_card, KEY, [c for c, _ in medians], [n for _, n in medians])
        out = out.join(med, on=KEY, how="left")
    return out


PREV_SPEC = [
    ("AMT_ANNUITY", ["mean", "max"]),
    ("AMT_APPLICATION", ["mean", "max"]),
    ("Credit_diff", ["mean", "max"]),
    ("AMT_DOWN_PAYMENT", ["mean", "max", "min"]),
    ("AMT_GOODS_PRICE", ["mean", "max"]),
    ("NFLAG_LAST_APPL_IN_DAY", ["mean"]),
    ("RATE_DOWN_PAYMENT", ["mean", "max", "min"]),
    ("RATE_INTEREST_PRIMARY", ["mean", "max", "min"]),
    ("RATE_INTEREST_PRIVILEGED", ["mean", "max", "min"]),
    ("DAYS_DECISION", ["mean", "count"]),
    ("NAME_GOODS_CATEGORY", ["nunique"]),
    ("CNT_PAYMENT", ["mean"]),
    ("NFLAG_INSURED_ON_APPROVAL", ["mean"]),
]


def prev_application_features(prev: DataFrame, prefix: str = "prev") -> DataFrame:
    """Five one-hot families summed per client plus amount/rate statistics."""
    p = f"{prefix}_"
    df = keyed(prev).withColumn("Credit_diff", F.col("AMT_APPLICATION") - F.col("AMT_CREDIT"))
    few = few_values(df, [c for c, stats in PREV_SPEC if "nunique" in stats])
    return df.groupBy(KEY).agg(
        *one_hot_counts("NAME_CONTRACT_TYPE", PREV_CONTRACT_TYPES, p),
        *one_hot_counts("NAME_CONTRACT_STATUS", PREV_CONTRACT_STATUSES, p),
        *one_hot_counts("NAME_PORTFOLIO", PREV_PORTFOLIOS, p),
        *one_hot_counts("NAME_PRODUCT_TYPE", PREV_PRODUCT_TYPES, p),
        *one_hot_counts("NAME_YIELD_GROUP", PREV_YIELD_GROUPS, p),
        *spec_aggs(prefix, PREV_SPEC, few),
    )


# ---------------------------------------------------------------- generic category counts

MAX_VOCABULARY = 10_000  # one output column per category: the learned vocabulary is size-checked


def learn_vocabulary(df: DataFrame, column: str, max_categories: int | None = None) -> list:
    """Categories to keep. With a cap of N, keep the N-1 most frequent; ties
    keep the later category in sort order, missing sorting last. The result is
    one row per distinct category, a bounded fitted parameter."""
    counts = df.groupBy(column).count()
    if max_categories is None:
        rows = counts.orderBy(F.col(column).asc_nulls_last()).limit(MAX_VOCABULARY + 1).collect()
        if len(rows) > MAX_VOCABULARY:
            raise ValueError(f"{column}: more than {MAX_VOCABULARY} categories; give a cap or a vocabulary")
        return [r[0] for r in rows]
    ranked = counts.orderBy(F.desc("count"), F.col(column).desc_nulls_first())
    rows = ranked.limit(max_categories + 1).collect()  # only the kept ones and one more are needed
    if len(rows) <= max_categories:
        return [r[0] for r in rows]
    return [r[0] for r in rows[: max_categories - 1]]


def category_counts_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, column, n)``: per-key count of each category that occurs, for any
    number of categories: no vocabulary is learned and nothing reaches the driver."""
    return keyed(df, key).groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, key: str, column: str, vocab: Sequence | None = None,
                    max_categories: int | None = None, prefix: str = "") -> DataFrame:
    """Per-key count of each category (a pivot without a pivot shuffle):
    the vocabulary is fixed or learned, and rows outside a capped vocabulary
    go to one ``<column>_infrequent`` count."""
    learned = vocab is None
    if learned:
        vocab = learn_vocabulary(df, column, max_categories)
    vocab = list(vocab)
    c = F.col(column)
    aggs = []
    for v in vocab:
        name = f"{prefix}{column}_{'nan' if v is None else v}".replace(" ", "_")
        aggs.append(count_true(c.isNull() if v is None else c == v).alias(name))
    if max_categories is not None or not learned:
        kept = [v for v in vocab if v is not None]
        in_vocab = F.coalesce(c.isin(kept), F.lit(False)) if kept else F.lit(False)
        if None in vocab:
            in_vocab = in_vocab | c.isNull()
        aggs.append(count_true(~in_vocab).alias(f"{prefix}{column}_infrequent"))
    return keyed(df, key).groupBy(key).agg(*aggs)


# ---------------------------------------------------------------- 20-feature model

def cash_features_20(cash: DataFrame) -> DataFrame:
    return keyed(cash).groupBy(KEY).agg(F.count("SK_ID_PREV").alias("cash_SK_ID_PREV_count"),
                                        F.max("CNT_INSTALMENT").alias("cash_CNT_INSTALMENT_max"))


def installment_features_20(inst: DataFrame) -> DataFrame:
    return _inst_derived(inst).groupBy(KEY).agg(F.min("Days_till_deadline").alias("inst_Days_till_deadline_min"),
                                                F.avg("Amt_deficit").alias("inst_Amt_deficit_mean"))


def bureau_features_20(bureau: DataFrame) -> DataFrame:
    return keyed(bureau).groupBy(KEY).agg(F.avg("DAYS_CREDIT").alias("bur_DAYS_CREDIT_mean"))


def prev_features_20(prev: DataFrame) -> DataFrame:
    return keyed(prev).groupBy(KEY).agg(
        F.avg("AMT_ANNUITY").alias("prev_AMT_ANNUITY_mean"),
        count_true(F.col("NAME_CONTRACT_STATUS") == "Refused").alias("prev_NAME_CONTRACT_STATUS_Refused_sum"),
        F.max(F.col("AMT_APPLICATION") - F.col("AMT_CREDIT")).alias("prev_Credit_diff_max"),
    )
