"""Mixing sources to target weights by hierarchical token budgets.

The tree is domain -> language -> source; every node has an integer weight among its siblings. A budget
of tokens flows down from the root. A node can take at most what its leaves hold times ``max_epochs``;
where a child's share exceeds that, the shortage goes to its siblings in proportion to their weights, and
only what they cannot take goes to the node's own siblings (the node's limit tells the level above). Each
leaf then emits the prefix of seeded epochs that its budget pays for: every epoch is the leaf's documents
in another pseudo-random order, and the prefix ends with the first document that reaches the budget.

Everything is DataFrame operations. The order inside an epoch is cut into 65,536 hash slots; the slot totals
say which slots lie wholly inside the prefix, and only the one slot that holds the end is ordered by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loanlens.llm.common import Scratch, few

LEVELS = ("domain", "lang", "source")
#: Weights of the registered query; anything else weighs 1.
DOMAIN_WEIGHTS = {"reference": 3, "web": 2, "forum": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
BUDGET_SHARE = (6, 10)         # budget = 6/10 of the tokens of the input
MAX_EPOCHS = 3
LEAVES = 100_000               # plans of more leaves are shuffled instead of broadcast
#: Tokens: runs of characters other than blank, tab, line feed, vertical tab, form feed, carriage return.
_TOKEN, _BETWEEN = r"[^ \t\n\x0B\f\r]+", r"[ \t\n\x0B\f\r]+"
#: The domain of a source, by its trailing number (none: web).
DOMAIN = "case cast(coalesce(nullif(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1), ''), '0') as int) % 4 when 1 then 'reference' when 2 then 'forum' else 'web' end"


def _weights(column: str, table: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.col(column)], F.lit(1)).cast("long") if pairs else F.lit(1).cast("long")


def _pour(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """(children's columns, budget): each parent's budget poured over its children by weight, up to their limits.

    In order of limit / weight, a child is full if its limit is below its weight's share of what is left; from the
    first child that is not full on (whose level is the highest of the children not full), the rest is divided
    by weight and rounded down. ``keys`` name the parent.
    """
    joined = children.join(parents.select(*keys, F.col("budget").alias("poured")), keys) if keys else children.crossJoin(
        F.broadcast(parents.select(F.col("budget").alias("poured"))))
    order = Window.partitionBy(*keys).orderBy(F.col("cap") / F.col("weight"), *LEVELS)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("poured") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    whole = Window.partitionBy(*keys)
    return (joined.withColumn("level", level).withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
            .withColumn("rate", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))
            .withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.floor(F.col("weight") * F.col("rate")))))
            .drop("level", "full", "rate", "poured"))


def leaf_budgets(leaves: DataFrame, share: tuple[int, int], max_epochs: int,
                 weights: tuple[dict, dict, dict] = (DOMAIN_WEIGHTS, LANG_WEIGHTS, {})) -> DataFrame:
    """(domain, lang, source, tokens, budget) of each leaf (domain, lang, source, tokens)."""
    level3 = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("weight", _weights("source", weights[2]))
    level2 = level3.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("source", F.lit("")).withColumn("weight", _weights("lang", weights[1]))
    level1 = level2.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("source", F.lit("")).withColumn("lang", F.lit("")).withColumn(
        "weight", _weights("domain", weights[0]))
    root = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {share[0]} div {share[1]}").alias("budget"))
    b1 = _pour(level1, root, [])
    b2 = _pour(level2, b1, ["domain"])
    return _pour(level3, b2, ["domain", "lang"]).select(*LEVELS, "tokens", "budget")


def _slot(seed: int, epoch: Column) -> Column:
    """First 16 bits (as a number) of the document's place in an epoch."""
    return F.conv(F.substring(_place(seed, epoch), 1, 4), 16, 10).cast("int")


def _place(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), epoch.cast("string"), F.lit("|"), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               share: tuple[int, int] = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """One row per selected copy of a document: id, domain, lang, source, tokens, epoch (1, 2, ...).

    Null languages and sources count as the value ''. A document without tokens costs nothing; it is in every
    whole epoch its leaf emits and in the last one as far as its place goes. Rows with equal ids share their places and are
    ordered by token count, then text digest. Leaves without tokens, and an empty table, give no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", F.expr(DOMAIN).alias("domain"), "lang", "source", F.length(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), _TOKEN, "x"), _BETWEEN, "")).cast("long").alias("tokens"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    rows = scratch.save(rows, "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    budgets = scratch.save(leaf_budgets(leaves, share, max_epochs).filter("budget > 0"), "budgets")
    # whole epochs, and what is left for the last one
    plan = budgets.withColumns({"whole": F.expr("budget div tokens"), "left": F.expr("budget % tokens")}).drop("tokens", "budget")
    # one row per leaf at most in the plan and in the ends
    hint = F.broadcast if few(budgets, LEAVES) else (lambda df: df)

    # last epoch: slot totals (combined map-side) locate the end, one slot is ordered by document
    last = rows.join(hint(plan.filter("left > 0")), list(LEVELS)).withColumn(
        "slot", _slot(seed, F.col("whole") + 1))
    totals = last.groupBy(*LEVELS, "left", "slot").agg(F.sum("tokens").alias("t"))
    upto = Window.partitionBy(*LEVELS).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    ends = totals.withColumn("before", F.coalesce(F.sum("t").over(upto), F.lit(0))).filter("before < left and before + t >= left").select(
        *LEVELS, F.col("slot").alias("end_slot"), "before")
    ends = scratch.save(ends, "ends")
    last = last.join(hint(ends), list(LEVELS))
    inside = last.filter("slot < end_slot")
    order = Window.partitionBy(*LEVELS).orderBy(_place(seed, F.col("whole") + 1), "tokens", "digest").rowsBetween(Window.unboundedPreceding, -1)
    edge = last.filter("slot = end_slot").withColumn("sofar", F.col("before") + F.coalesce(F.sum("tokens").over(order), F.lit(0))).filter("sofar < left")
    keep = ["id", *LEVELS, "tokens"]
    partial = inside.unionByName(edge.drop("sofar")).select(*keep, (F.col("whole") + 1).alias("epoch"))
    whole = rows.join(hint(plan.filter("whole > 0")), list(LEVELS)).select(
        *keep, F.explode(F.sequence(F.lit(1).cast("long"), "whole")).alias("epoch"))
    out = whole.unionByName(partial).select(F.col("id").alias(id_col), *LEVELS, "tokens", F.col("epoch").cast("int"))
    return scratch.result(out)


def op4_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _pour_sql(name: str, children: str, parents: str, keys: str) -> str:
    part = f"partition by {keys} " if keys else ""
    whole = f"over (partition by {keys})" if keys else "over ()"
    join = f"join {parents} p using ({keys})" if keys else f"cross join {parents} p"
    return f"""
{name}_l as (select c.*, p.budget as poured,
   (p.budget - coalesce(sum(cap) over ({part}order by cap / weight, domain, lang, source rows between unbounded preceding and 1 preceding), 0))
   / cast(sum(weight) over ({part}order by cap / weight, domain, lang, source rows between current row and unbounded following) as double) as level
   from {children} c {join}),
{name}_r as (select *, max(case when not (cap / weight <= level) then level end) {whole} as rate from {name}_l),
{name} as (select domain, lang, source, cap, case when cap / weight <= level then cap else least(cap, cast(floor(weight * rate) as bigint)) end as budget from {name}_r)"""


OP4_SQL = f"""
with d0 as (select doc_id as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
d as (select id, case cast(coalesce(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), ''), '0') as int) % 4
              when 1 then 'reference' when 2 then 'forum' else 'web' end as domain, lang, source,
      cast(length(regexp_replace(regexp_replace(text, '{_TOKEN}', 'x', 'g'), '{_BETWEEN}', '', 'g')) as bigint) as tokens,
      md5(text) as digest from d0),
leaves as (select domain, lang, source, cast(sum(tokens) as bigint) as tokens from d group by all having sum(tokens) > 0),
l3 as (select domain, lang, source, tokens * {MAX_EPOCHS} as cap, 1 as weight from leaves),
l2 as (select domain, lang, '' as source, cast(sum(cap) as bigint) as cap, case lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end as weight from l3 group by domain, lang),
l1 as (select domain, '' as lang, '' as source, cast(sum(cap) as bigint) as cap, case domain when 'reference' then 3 when 'web' then 2 else 1 end as weight from l2 group by domain),
root as (select cast(coalesce(sum(tokens), 0) as bigint) * {BUDGET_SHARE[0]} // {BUDGET_SHARE[1]} as budget from leaves),
{_pour_sql("b1", "l1", "root", "")},
{_pour_sql("b2", "l2", "(select domain, budget from b1)", "domain")},
{_pour_sql("b3", "l3", "(select domain, lang, budget from b2)", "domain, lang")},
plan as (select b3.domain, b3.lang, b3.source, budget // tokens as whole, budget % tokens as rest from b3 join leaves using (domain, lang, source) where budget > 0),
e as (select d.*, whole, rest from d join plan using (domain, lang, source)),
w as (select id, domain, lang, source, tokens, unnest(generate_series(1, whole)) as epoch from e),
o as (select *, coalesce(sum(tokens) over (partition by domain, lang, source order by md5('17|' || (whole + 1) || '|' || coalesce(cast(id as varchar), 'null')), tokens, digest
      rows between unbounded preceding and 1 preceding), 0) as sofar from e)
select id as doc_id, domain, lang, source, tokens, cast(epoch as int) as epoch from w
union all select id, domain, lang, source, tokens, cast(whole + 1 as int) from o where sofar < rest"""
