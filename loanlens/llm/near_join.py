"""Exact n-gram Jaccard self-join by grouped prefixes, as connected components.

A document's set holds its distinct word shingles. Two documents link when their
Jaccard similarity reaches the threshold. The join runs in five steps:

1. a fixed-size count sketch over all documents orders shingles, rare ones first.
   The order only steers how many candidates arise; any order gives the same links;
2. documents with identical prefixes and set size collapse into one group, documents
   with identical sets into one class of it, so copies cost one row;
3. groups that share a prefix shingle are paired along each shingle's list (each group
   with the list's first and with its predecessor), filtered by size and position;
4. pairs expand to the classes of the groups and are verified on the whole sets;
5. lists that still hold several components pair each group with its neighbours of other
   components in a shuffled order, and then emit all remaining pairs across components.
   Pairs inside one component are never emitted, so a family of thousands of near copies
   costs linear, not quadratic, work. A parity sketch bounds the symmetric difference of
   two sets from below and drops pairs that cannot link before they leave the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanlens.llm.common import Scratch, chunks, components, few, mix, shingle_sets

SKETCH_BITS = 21          # 2 MB of order classes: the only broadcast besides counted tables
SKETCH_CHUNKS = 64
PARITY_WORDS = 8          # 512 parity bits: XOR distance never exceeds the symmetric difference
NEIGHBOURS = 4
_SALT = np.uint64(0xA0761D6478BD642F)


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Order class of each sketch bucket: 0 for rare, else 1 + log2 of the documents counted above chance.

    Every task counts the shingles of all its documents; the counters are summed chunk by chunk in a
    tree, so no task holds more than a few hundred partial chunks and the result has a fixed size.
    """
    chunk = (1 << SKETCH_BITS) // SKETCH_CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)):
                found = [s for s in shingle_sets(data, off, size) if len(s)]
                if found:
                    np.add.at(total, (np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        parts = total.reshape(SKETCH_CHUNKS, chunk)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(np.full(len(used), TaskContext.get().partitionId() // 256), pa.int32()),
             pa.array([parts[i].tobytes() for i in used], pa.binary())], ["chunk", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        for raw in table.column("counts"):
            total += np.frombuffer(raw.as_buffer(), np.int32)
        return pa.table({"chunk": table.column("chunk")[:1], "part": pa.array([int(table.column("part")[0].as_py()) // 256], pa.int32()),
                         "counts": pa.array([np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())})

    schema = "chunk int, part int, counts binary"
    sums = docs.mapInArrow(count, schema)
    parts = max(docs.rdd.getNumPartitions(), 1)
    while True:
        sums = sums.groupBy("chunk", "part").applyInArrow(add, schema)
        if parts <= 256:
            break
        parts = -(-parts // 256)
    total = np.zeros((SKETCH_CHUNKS, chunk), np.int32)
    for r in sums.select("chunk", "counts").toLocalIterator():
        total[r["chunk"]] += np.frombuffer(r["counts"], np.int32)
    mean = float(total.mean())
    klass = np.zeros((SKETCH_CHUNKS, chunk), np.uint8)
    for row, out in zip(total, klass):
        often = row > mean + 4 * np.sqrt(mean) + 4
        out[often] = 1 + np.log2(row[often] - mean).astype(np.uint8)
    return klass.ravel()


def _describe(docs: DataFrame, klass, size: int, percent: int) -> DataFrame:
    """(id, n, node, gkey, prefix, parity) of each document: set size, 128-bit set identity, group identity,
    prefix shingles, and for each of 2n to 4n (512 at least) hash slots whether the set has an odd number there."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = klass.value
        for batch in batches:
            n, node, gkey, prefix, parity = [], [], [], [], []
            for _, _, data, off in chunks(batch.column(1)):
                for s in shingle_sets(data, off, size):
                    m = len(s)
                    n.append(m)
                    if not m:
                        node.append(None)
                        gkey.append(None)
                        prefix.append(None)
                        parity.append(None)
                        continue
                    key = (order[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                    key.sort()
                    head = key[:m - (percent * m + 99) // 100 + 1]
                    node.append(f"{int(s.sum(dtype=np.uint64)):016x}{int(mix(s ^ _SALT).sum(dtype=np.uint64)):016x}")
                    gkey.append(int(mix(mix(head).sum(dtype=np.uint64, keepdims=True) + np.uint64(m)).view(np.int64)[0]))
                    prefix.append(head.view(np.int64))
                    slots = max(64 * PARITY_WORDS, 1 << (2 * m).bit_length())
                    odd = np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
                    parity.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            flat = pa.array(np.concatenate([p for p in prefix if p is not None] or [np.zeros(0, np.int64)]))
            ends = np.cumsum([0] + [0 if p is None else len(p) for p in prefix])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.string()), pa.array(gkey, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(parity, pa.list_(pa.int64()))],
                ["id", "n", "node", "gkey", "prefix", "parity"])

    return docs.mapInArrow(describe, f"id {dict(docs.dtypes)['id']}, n long, node string, gkey long, prefix array<long>, parity array<long>")


def _sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, s): the whole shingle sets of the classes in ``nodes``, recomputed from one text of each.

    ``rows`` has (id, node); the texts are fetched by the smallest id of each class, or by all null ids
    where a class has no other. Repeated ids may bring other texts along; their classes are dropped again.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in chunks(batch.column(1)):
                found = [s for s in shingle_sets(data, off, size) if len(s)]
                if not found:
                    continue
                node = [f"{int(s.sum(dtype=np.uint64)):016x}{int(mix(s ^ _SALT).sum(dtype=np.uint64)):016x}" for s in found]
                flat = pa.array(np.concatenate(found).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in found]), pa.int32()), flat)],
                    ["node", "s"])

    # one id per class, so the count of the classes bounds the ids, too
    hint = F.broadcast if few(nodes) else (lambda df: df)
    wanted = rows.join(hint(nodes), "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")).select("id").distinct()
    texts = docs.join(hint(wanted), docs["id"].eqNullSafe(wanted["id"]), "left_semi")
    return (texts.mapInArrow(whole, "node string, s array<long>").join(hint(nodes), "node", "left_semi")
            .groupBy("node").agg(F.first("s").alias("s")))


def _verified(scratch: Scratch, docs: DataFrame, rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose whole sets reach the threshold."""
    nodes = scratch.save(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    sets = scratch.save(_sets(docs, rows, nodes, size), "sets")
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
            .withColumn("common", F.size(F.array_intersect("a", "b"))))
    links = scratch.save(both.filter(F.expr(f"100 * common >= {percent} * (size(a) + size(b) - common)")).select("u", "v"), "links")
    scratch.drop(sets)
    return links


def _fold(column: str, words: str) -> str:
    """Parity bits folded by halves to ``words`` words: the parity of the coarser slots."""
    once = "zip_with(slice({c}, 1, size({c}) div 2), slice({c}, size({c}) div 2 + 1, size({c}) div 2), (x, y) -> x ^ y)"
    return f"if(size({column}) > {words}, {once.format(c=column)}, {column})"


def _coarse() -> str:
    """The parity bits folded to ``PARITY_WORDS`` words."""
    word = f"transform(filter(parity, (x, j) -> j % {PARITY_WORDS} = i), x -> x)"
    return f"transform(sequence(0, {PARITY_WORDS - 1}), i -> if(parity is null, null, aggregate({word}, 0L, (s, x) -> s ^ x)))"


def _parity_allows(pairs: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
    """Pairs (g, h) of groups whose parity bits differ in no more slots than linked sets can.

    Sizes of paired groups differ by a third at most, so their slot counts by a factor of two at most.
    Groups of several classes have no parity bits of their own and pass.
    """
    a = parity.select(F.col("gkey").alias("g"), F.col("parity").alias("a"), F.col("n").alias("na"))
    b = parity.select(F.col("gkey").alias("h"), F.col("parity").alias("b"), F.col("n").alias("nb"))
    words = "least(size(a), size(b))"
    odd = f"aggregate(zip_with({_fold('a', words)}, {_fold('b', words)}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return (pairs.join(a, "g").join(b, "h")
            .filter(f"a is null or b is null or {100 + percent} * ({odd}) <= {100 - percent} * (na + nb)").select("g", "h"))


def _near_enough(n1: str, p1: str, n2: str, p2: str, percent: int, before: str = "0") -> str:
    """Size and position filter: an upper bound of the overlap still reaches the threshold.

    With ``before`` = 0 it holds at the first shingle two linked sets share, which is enough where
    every shared shingle of a pair is looked at; the smaller of the positions allows any shared shingle.
    """
    return (f"100 * least({n1}, {n2}) >= {percent} * greatest({n1}, {n2}) and "
            f"{100 + percent} * ({before} + 1 + least({n1} - {p1} - 1, {n2} - {p2} - 1)) >= {percent} * ({n1} + {n2})")


_CARRIED = ("gkey", "n", "p", "lo", "hi", "parity")


def _across(percent: int, before: str = "0") -> str:
    """Pairs of list entries (columns ..1 and ..2) of different components that may still link."""
    odd = " + ".join(f"bit_count(parity1[{i}] ^ parity2[{i}])" for i in range(PARITY_WORDS))
    return (f"(not (lo1 = hi1 and lo1 = lo2 and lo2 = hi2) and {_near_enough('n1', 'p1', 'n2', 'p2', percent, before)} "
            f"and coalesce({100 + percent} * ({odd}) <= {100 - percent} * (n1 + n2), true))")


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              shingle: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: its id, ``n_shingles`` (set size) and ``component_id``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer words than
    ``shingle`` has its whole sequence as its one shingle. ``component_id`` is the smallest
    id reachable over links of Jaccard similarity >= ``percent``/100, itself included.
    Null or empty texts (or only whitespace) have no shingles and their own id. Repeated rows
    stay and share a component; a null id is kept but never the smallest unless all ids of
    the component are null. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    klass = spark.sparkContext.broadcast(_sketch(docs.select("text"), shingle))
    rows = scratch.save(_describe(docs, klass, shingle, percent), "rows")
    klass.destroy()
    full = rows.filter("n > 0")
    classes = scratch.save(full.groupBy("gkey", "node").agg(F.min("id").alias("low")).drop("low"), "classes")
    lead = classes.groupBy("gkey").agg(F.min("node").alias("head"), F.count("*").alias("members"))

    # lists of two groups or more, by prefix shingle
    by_token = Window.partitionBy("token")
    groups = full.groupBy("gkey").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    lists = scratch.save(
        groups.select("gkey", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("p", "token"))
        .withColumns({
            "m": F.count("*").over(by_token),
            "g1": F.first("gkey").over(by_token.orderBy("n", "gkey")),
            "n1": F.first("n").over(by_token.orderBy("n", "gkey")),
            "p1": F.first("p").over(by_token.orderBy("n", "gkey")),
            "g0": F.lag("gkey").over(by_token.orderBy("n", "gkey")),
            "n0": F.lag("n").over(by_token.orderBy("n", "gkey")),
            "p0": F.lag("p").over(by_token.orderBy("n", "gkey"))})
        .filter("m > 1").drop("m"), "lists")

    # first round: along each list, and inside each group from its first class
    first = lists.filter("g0 is not null and (" + _near_enough("n", "p", "n0", "p0", percent, "least(p, p0)") + ")").select("gkey", F.col("g0").alias("g"))
    star = lists.filter("g1 <> gkey and (" + _near_enough("n", "p", "n1", "p1", percent, "least(p, p1)") + ")").select("gkey", F.col("g1").alias("g"))
    parity = scratch.save(full.groupBy("gkey").agg(F.first("n").alias("n"), F.first("parity").alias("parity")).join(lead, "gkey")
                          .select("gkey", "n", F.expr("if(members = 1, parity, null)").alias("parity")), "parity")
    pairs = first.unionByName(star).select(F.least("gkey", "g").alias("g"), F.greatest("gkey", "g").alias("h")).distinct()
    pairs = _parity_allows(pairs, parity, percent)
    pairs = (pairs.join(lead.select(F.col("gkey").alias("g"), F.col("head").alias("u")), "g")
             .join(lead.select(F.col("gkey").alias("h"), F.col("head").alias("v")), "h").select("u", "v"))
    inside = classes.join(lead.filter("members > 1"), "gkey").filter("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v"))
    tried = scratch.save(pairs.unionByName(inside).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "tried")
    comp = components(scratch, _verified(scratch, docs, rows, tried, shingle, percent))

    # second round: pairs across components only
    member = scratch.save(classes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")), "member")
    coarse = parity.select("gkey", F.expr(_coarse()).alias("parity"))
    for step in ("neighbours", "all"):
        span = member.groupBy("gkey").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).join(coarse, "gkey")
        open_lists = lists.select("token", "gkey", "n", "p").join(span, "gkey")
        mixed = open_lists.groupBy("token").agg(F.min("lo").alias("a"), F.max("hi").alias("b")).filter("a <> b").select("token")
        open_lists = scratch.save(open_lists.join(mixed, "token", "left_semi"), "open")
        m1 = member.select(F.col("gkey").alias("g"), F.col("node").alias("u"), F.col("component").alias("c1"))
        m2 = member.select(F.col("gkey").alias("h"), F.col("node").alias("v"), F.col("component").alias("c2"))
        if step == "neighbours":
            shuffled = Window.partitionBy("token").orderBy(F.xxhash64("gkey", "token"))
            row = F.struct("gkey", "n", "p", "lo", "hi", "parity")
            near = open_lists.select("token", row.alias("x"), F.array(*[F.lag(row, i).over(shuffled) for i in range(1, NEIGHBOURS + 1)]).alias("y"))
            near = near.select("x", F.explode("y").alias("y")).filter("y is not null")
            cross = near.select(*[F.col(f"x.{c}").alias(c + "1") for c in _CARRIED], *[F.col(f"y.{c}").alias(c + "2") for c in _CARRIED]).filter(
                _across(percent, "least(p1, p2)"))
        else:
            left = open_lists.select("token", *[F.col(c).alias(c + "1") for c in _CARRIED])
            right = open_lists.select("token", *[F.col(c).alias(c + "2") for c in _CARRIED])
            cross = left.join(right, F.expr("gkey1 < gkey2 and " + _across(percent)) & (left["token"] == right["token"]))
        pairs = cross.select(F.least("gkey1", "gkey2").alias("g"), F.greatest("gkey1", "gkey2").alias("h")).distinct()
        pairs = _parity_allows(pairs, parity, percent)
        several = span.filter("lo <> hi").select(F.col("gkey").alias("g"), F.col("gkey").alias("h"))
        more = (pairs.unionByName(several).join(m1, "g").join(m2, "h").filter("c1 <> c2")
                .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
                .join(tried, ["u", "v"], "left_anti"))
        more = scratch.save(more, "more")
        if not more.isEmpty():
            # the new links join whole components: only these are contracted further
            links = _verified(scratch, docs, rows, more, shingle, percent)
            of = member.select("node", "component")
            joined = (links.join(of.withColumnsRenamed({"node": "u", "component": "c1"}), "u")
                      .join(of.withColumnsRenamed({"node": "v", "component": "c2"}), "v").select(F.col("c1").alias("u"), F.col("c2").alias("v")))
            comp = components(scratch, joined).select(F.col("node").alias("component"), F.col("component").alias("onto"))
            member = scratch.save(member.join(comp, "component", "left").select(
                "gkey", "node", F.coalesce("onto", "component").alias("component")), "member")
            tried = tried.unionByName(more)
        scratch.drop(open_lists)

    # smallest id of each component, combined map-side from the rows
    low = rows.filter("n > 0").groupBy("node").agg(F.min("id").alias("low"))
    named = low.join(member.select("node", "component"), "node")
    best = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_node = named.join(best, "component").select("node", "component_id")
    out = (rows.select("id", "n", "node").join(by_node, "node", "left")
           .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                   F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
    return scratch.result(out)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
