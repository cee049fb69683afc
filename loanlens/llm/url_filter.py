"""URL filter: hand-made rules, and gradient-boosted trees on lexical features for every other URL.

The trees learn from labelled URLs: a labelled table where there is one, else the URLs that the rules decide.
Features are taken from the URL string alone: lengths, path depth, digit and hyphen ratios, character entropy of
the host, parameter counts, and how often all labelled URLs with the same host suffix were blocked.
Everything is DataFrame operations and Spark ML.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanlens.llm.common import few
from loanlens.session import ensure_checkpoint_dir

FIT_URLS = 20_000              # documented bound of the fitting sample
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "hyphens", "entropy",
            "parameters", "query_length", "has_fragment", "has_extension", "is_https", "suffix_rate", "suffix_seen")


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without '://' or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to '?', '#' or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """``urls`` (with host, path) plus ``rule`` and ``rule_verdict``, both null where no rule fits.

    A rule (host, path) fits its host and all subdomains when the path starts with the rule's; the longest
    rule (host and path together, then the longer host, then the host's order) wins.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[0], r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in reversed(ranked):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _count(c: Column, chars: str) -> Column:
    """Occurrences of any of the characters (a regular-expression class)."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{chars}]", ""))


def _suffix() -> Column:
    return F.substring_index("host", ".", -2)


def lexical(urls: DataFrame) -> DataFrame:
    """Lexical feature columns of (url, host, path); a null or empty URL has zeros."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    n = F.greatest(F.length("host"), F.lit(1))
    chars = F.expr("transform(array_distinct(filter(split(host, ''), x -> x <> '')), x -> (length(host) - length(replace(host, x, ''))) / greatest(length(host), 1))")
    return urls.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": F.length(F.regexp_replace("path", "[^/]", "")).cast("double"),
        "labels": F.length(F.regexp_replace("host", "[^.]", "")).cast("double"),
        "digit_ratio": _count(url, "0-9") / F.greatest(F.length(url), F.lit(1)), "host_digit_ratio": _count(F.col("host"), "0-9") / n,
        "hyphens": _count(F.col("host"), "-").cast("double"),
        "entropy": F.coalesce(F.aggregate(chars, F.lit(0.0), lambda s, p: s - p * F.log2(p)), F.lit(0.0)),
        "parameters": F.when(query == "", 0.0).otherwise(F.length(F.regexp_replace(query, "[^&]", "")) + 1.0), "query_length": F.length(query).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "has_extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "is_https": url.startswith("https://").cast("double"),
        "suffix": _suffix()})


def fit_trees(labelled: DataFrame, limit: int = FIT_URLS, trees: int = 20, depth: int = 4):
    """Boosted trees on (url, label): fitted on at most ``limit`` labelled URLs, the same ones on every run.

    The suffix table counts all labelled URLs. Returns (model, suffix table, rate of label 1), or None where the
    labels hold fewer than two classes.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    rows = labelled.select("url", F.col("label").cast("double").alias("label")).filter("label in (0, 1)").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    seen = rows.groupBy(_suffix().alias("suffix")).agg(F.count("*").alias("n"), F.sum("label").alias("bad")).checkpoint()
    total, bad = seen.agg(F.sum("n"), F.sum("bad")).first()
    if not total or bad in (0, total):
        return None
    prior = bad / total
    sample = rows.withColumn("place", F.xxhash64("url")).orderBy("place", "url").limit(limit).drop("place")
    sample = lexical(sample).checkpoint()
    # block rate smoothed by ten URLs at the prior
    table = seen.select("suffix", ((F.col("bad") + 10 * prior) / (F.col("n") + 10)).alias("suffix_rate"), F.log1p("n").alias("suffix_seen"))
    stages = [VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
              GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=5, maxBins=32)]
    model = Pipeline(stages=stages).fit(_with_suffix(sample, table, prior).coalesce(4))
    return model, table, prior


def _with_suffix(urls: DataFrame, table: DataFrame, prior: float) -> DataFrame:
    return urls.join(F.broadcast(table) if few(table) else table, "suffix", "left").fillna({"suffix_rate": prior, "suffix_seen": 0.0})


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict ('allow' or 'block') and ``block_score``.

    The rule decides where one fits; elsewhere the trees' probability of block from 0.5 on blocks. ``labelled`` is a
    table (url, label 1 = block); without it the URLs that rules decide are the labelled ones. Where fewer than two
    classes are labelled the score is the rate of block among them (0 without any). A null URL, or one without '://',
    has an empty host and path. Repeated rows and null ids stay; other columns are ignored; no rows give no rows.
    """
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = with_rule(urls, rules)
    if labelled is None:
        labelled = judged.filter("rule is not null").select("url", (F.col("rule_verdict") == "block").cast("double").alias("label"))
    fitted = fit_trees(labelled)
    if fitted is None:
        rate = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        scored = judged.withColumn("block_score", F.lit(float(rate)))
    else:
        model, table, prior = fitted
        scored = model.transform(_with_suffix(lexical(judged), table, prior)).withColumn("block_score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce(
        "rule_verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
