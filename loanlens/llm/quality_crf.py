"""Document quality from a linear-chain conditional random field over lines.

Every line (lines over ``PIECE_BYTES`` bytes are cut into pieces at fixed distances) gets a good or
bad label. Its features describe the line's bytes and those of its neighbours; transitions tie
neighbouring labels. Forward-backward gives each line's probability of being good, and the
byte-length-weighted mean over the lines, put through a fitted logistic curve, is the score.

The field is fitted in one task from a bounded sample of labelled documents: lines start with
their document's label, then lines of bad documents that the first field calls good are relabelled
once. Scoring streams over all documents, vectorised over the lines of a chunk.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from loanlens.llm.common import chunks, word_spans

FIT_DOCUMENTS = 2000       # documented bound of the fitting sample
PIECE_BYTES = 400          # longest line piece that is labelled as one
#: Line length (bytes) at which a line's own evidence counts once.
_UNIT = 60.0
_KIND = np.zeros(256, np.int64)          # 0 other
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (1 if _c in " \t\x0b\x0c\r\n" else 2 if "a" <= _c <= "z" else 3 if "A" <= _c <= "Z" else 4 if _c.isascii() and _c.isdigit()
                 else 5 if _c in ".,;:?'\"()-" else 6 if _c in "#%*&$<>{}[]|\\^~=+_@/!" else 7 if _b >= 128 else 0)
_KINDS = 8


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets of the line pieces of a chunk (ascending) and for each row the range of its pieces."""
    starts = np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1])
    starts = np.unique(starts[starts < len(data)])
    if not len(starts):
        return starts, np.zeros(len(offsets), np.int64)
    size = np.diff(np.append(starts, len(data)))
    n = np.maximum(1, -(-size // PIECE_BYTES))
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(starts, n) + step * PIECE_BYTES
    return starts, np.searchsorted(starts, offsets)


def _features(data: np.ndarray, starts: np.ndarray, ranges: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features per line, byte length per line): the line's own statistics and those of its neighbours."""
    n = len(starts)
    size = np.diff(np.append(starts, len(data))).astype(np.float64)
    line = np.repeat(np.arange(n), size.astype(np.int64))
    kinds = np.bincount(line * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    share = kinds / size[:, None]
    # words: mean length, share of words equal to the one before, share of distinct first/last bytes
    begin, end, _ = word_spans(data, offsets)
    of = np.searchsorted(starts, begin, side="right") - 1
    words = np.bincount(of, minlength=n).astype(np.float64)
    letters = np.bincount(of, weights=end - begin, minlength=n)
    crude = (data[begin].astype(np.uint64) * np.uint64(257) + data[end - 1].astype(np.uint64)) * np.uint64(1009) + (end - begin).astype(np.uint64)
    same = np.zeros(len(begin))
    same[1:] = crude[1:] == crude[:-1]
    repeats = np.bincount(of, weights=same, minlength=n)
    # a two-word echo finds runs such as "a b a b"
    echo = np.zeros(len(begin))
    echo[2:] = crude[2:] == crude[:-2]
    echoes = np.bincount(of, weights=echo, minlength=n)
    w = np.maximum(words, 1)
    own = np.stack([
        share[:, 2], share[:, 3], np.minimum(share[:, 4] * 3, 1), share[:, 5] * 5, np.minimum(share[:, 6] * 5, 2), share[:, 7], share[:, 0] * 5,
        np.minimum(letters / w, 15) / 10, repeats / w, echoes / w, np.log1p(size) / 6, np.minimum(words, 3) / 3,
        (share[:, 3] > 0.3) * 1.0, (share[:, 6] > 0.03) * 1.0, (share[:, 4] > 0.2) * 1.0, (repeats / w > 0.3) * 1.0,
    ], axis=1)
    # identical neighbouring pieces, by length and byte sum
    total = np.add.reduceat(data.astype(np.int64), starts)
    key = total * 8191 + size.astype(np.int64)
    row = np.searchsorted(ranges, np.arange(n), side="right")
    before = np.concatenate([[-1], np.arange(n - 1)])
    after = np.concatenate([np.arange(1, n), [-1]])
    before[(before < 0) | (row[before] != row)] = -1
    after[(after < 0) | (row[after] != row)] = -1
    prev = np.where(before[:, None] >= 0, own[before], 0.0)
    nxt = np.where(after[:, None] >= 0, own[after], 0.0)
    edge = np.stack([before < 0, after < 0, (before >= 0) & (key[before] == key), np.ones(n)], axis=1).astype(np.float64)
    return np.concatenate([own, 0.5 * (prev + nxt), edge], axis=1), size


def _marginals(score: np.ndarray, bind: float, stay: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and P(this line and the one before differ), by forward-backward over each row's lines.

    ``score`` is the log-odds of good of each line, ``bind`` what a change of label costs. Lines at the same
    distance from their row's start are one vector step.
    """
    n = len(score)
    good, flip = np.zeros(n), np.zeros(n)
    a, b = ranges[:-1], ranges[1:]
    size = b - a
    longest = int(size.max(initial=0))
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(longest), side="left")
    f = np.zeros((2, n))          # forward log-messages, normalised per line
    back = np.zeros((2, n))
    e = np.stack([np.zeros(n), score])
    for t in range(longest):
        i = (a[order[:alive[t]]] + t)
        if t:
            p0, p1 = f[0, i - 1], f[1, i - 1]
            f[0, i] = np.logaddexp(p0, p1 - bind) + e[0, i]
            f[1, i] = np.logaddexp(p0 - bind, p1) + e[1, i]
        else:
            f[:, i] = e[:, i]
        m = np.maximum(f[0, i], f[1, i])
        f[:, i] -= m
    for t in range(1, longest):
        i = (b[order[:alive[t]]] - 1 - t)
        n0, n1 = back[0, i + 1] + e[0, i + 1], back[1, i + 1] + e[1, i + 1]
        back[0, i] = np.logaddexp(n0, n1 - bind)
        back[1, i] = np.logaddexp(n0 - bind, n1)
        back[:, i] -= np.maximum(back[0, i], back[1, i])
    z = f + back
    good = 1 / (1 + np.exp(np.clip(z[0] - z[1], -700, 700)))
    i = np.flatnonzero(stay)      # lines with a line before them in the same row
    if len(i):
        same0 = f[0, i - 1] + e[0, i] + back[0, i]
        same1 = f[1, i - 1] + e[1, i] + back[1, i]
        d01 = f[0, i - 1] - bind + e[1, i] + back[1, i]
        d10 = f[1, i - 1] - bind + e[0, i] + back[0, i]
        top = np.max([same0, same1, d01, d10], axis=0)
        s0, s1, x, y = (np.exp(v - top) for v in (same0, same1, d01, d10))
        flip[i] = (x + y) / (s0 + s1 + x + y)
    return good, flip


def _has_before(ranges: np.ndarray, n: int) -> np.ndarray:
    has = np.ones(n, bool)
    has[ranges[:-1][np.diff(ranges) > 0]] = False
    return has


class LineField:
    """Fitted field: feature scaling, weights, label-change cost, and the document curve."""

    def __init__(self, mean, scale, weights, bind, slope, shift, empty):
        self.mean, self.scale, self.weights, self.bind = mean, scale, weights, bind
        self.slope, self.shift, self.empty = slope, shift, empty

    def lines(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(P(good) per line, bytes per line, ranges of lines per row)."""
        starts, ranges = _pieces(data, offsets)
        if not len(starts):
            return np.zeros(0), np.zeros(0), ranges
        x, size = _features(data, starts, ranges, offsets)
        score = np.clip((x - self.mean) / self.scale @ self.weights, -30, 30)
        good, _ = _marginals(score, self.bind, _has_before(ranges, len(size)), ranges)
        return good, size, ranges

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each row: the curve over the length-weighted mean marginal."""
        good, size, ranges = self.lines(data, offsets)
        bytes_good = np.concatenate([[0.0], np.cumsum(good * size)])
        bytes_all = np.concatenate([[0.0], np.cumsum(size)])
        have = bytes_all[ranges[1:]] - bytes_all[ranges[:-1]]
        mean = (bytes_good[ranges[1:]] - bytes_good[ranges[:-1]]) / np.maximum(have, 1)
        return np.where(have > 0, _curve(mean, self.slope, self.shift), self.empty)


def _curve(mean: np.ndarray, slope: float, shift: float) -> np.ndarray:
    m = np.clip(mean, 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-np.clip(slope * np.log(m / (1 - m)) + shift, -30, 30)))


def fit_line_field(texts: list[str | None], labels: list[int], rounds: int = 150) -> LineField:
    """Fit the field by gradient ascent on the chain likelihood, relabel lines of bad documents once, fit the curve."""
    column = pa.array([t or "" for t in texts], pa.large_string())
    y_doc = np.array(labels, np.float64)
    feats, sizes, ranges, docs, shift = [], [], [np.zeros(1, np.int64)], [], 0
    for a, b, data, off in chunks(column):
        starts, r = _pieces(data, off)
        if len(starts):
            x, size = _features(data, starts, r, off)
            feats.append(x.astype(np.float32))
            sizes.append(size)
        ranges.append(r[1:] + shift)
        shift += len(starts)
    if not feats:
        p = float(np.clip(y_doc.mean() if len(y_doc) else 0.5, 0.01, 0.99))
        return LineField(0.0, 1.0, np.zeros(36), 0.0, 0.0, float(np.log(p / (1 - p))), p)
    x, size, ranges = np.concatenate(feats), np.concatenate(sizes), np.concatenate(ranges)
    del feats, sizes
    mean, scale = x.mean(axis=0), x.std(axis=0) + np.float32(1e-6)
    mean[-1], scale[-1] = 0.0, 1.0        # the constant
    x = (x - mean) / scale
    doc = np.searchsorted(ranges, np.arange(len(x)), side="right") - 1
    stay = _has_before(ranges, len(x))
    y = y_doc[doc]
    weight = np.minimum(size / _UNIT, 4.0)
    w, bind = np.zeros(x.shape[1]), 0.5
    for step in range(2):
        m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        changed = np.zeros(len(x))
        changed[1:] = stay[1:] * (y[1:] != y[:-1])
        for t in range(1, rounds + 1):
            good, flip = _marginals(np.clip(x @ w, -30, 30), bind, stay, ranges)
            g = np.append(x.T @ (weight * (y - good)) / weight.sum() - 1e-4 * w, (flip - changed)[stay].mean() if stay.any() else 0.0)
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            move = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
            w, bind = w + move[:-1], float(np.clip(bind + move[-1], 0.0, 6.0))
        good, _ = _marginals(np.clip(x @ w, -30, 30), bind, stay, ranges)
        y = np.where((y_doc[doc] == 0) & (good > 0.7), 1.0, y_doc[doc])
    # the document curve, on documents that have lines
    have = np.bincount(doc, weights=size, minlength=len(y_doc))
    m = np.bincount(doc, weights=good * size, minlength=len(y_doc)) / np.maximum(have, 1)
    use = have > 0
    z, target = np.log(np.clip(m[use], 1e-4, 1 - 1e-4) / (1 - np.clip(m[use], 1e-4, 1 - 1e-4))), y_doc[use]
    slope, at = 1.0, 0.0
    for _ in range(200):          # Newton steps with a ridge towards slope 1
        p = 1 / (1 + np.exp(-np.clip(slope * z + at, -30, 30)))
        r, v = target - p, p * (1 - p) + 1e-9
        grad = np.array([(r * z).sum() - 0.1 * (slope - 1), r.sum() - 0.1 * at])
        hess = np.array([[(v * z * z).sum() + 0.1, (v * z).sum()], [(v * z).sum(), v.sum() + 0.1]])
        slope, at = np.array([slope, at]) + np.clip(np.linalg.solve(hess, grad), -1, 1)
    p = float(np.clip(y_doc.mean(), 0.01, 0.99))
    return LineField(mean, scale, w, bind, float(slope), float(at), p)


def fit_on_labels(docs: DataFrame, labels: DataFrame, label_col: str, limit: int, fit, unlabelled: int = 0):
    """``fit(texts, labels)`` of at most ``limit`` labelled rows of (id, text), the same ones on every run (by hash of the id).

    With ``unlabelled`` up to so many rows whose id has no label join them, with label -1. The bounded sample meets in one
    executor task, which returns the fitted model; the driver holds no text.
    """
    # an id with several labels or texts has its largest label and its first text in order
    known = labels.select("id", F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    ids = known.orderBy(F.xxhash64("id"), "id").limit(limit)
    if unlabelled:
        others = docs.select("id").filter("id is not null").join(labels.select("id"), "id", "left_anti").distinct()
        ids = ids.unionByName(others.orderBy(F.xxhash64("id"), "id").limit(unlabelled).withColumn("y", F.lit(-1)))
    sample = docs.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, y))], pa.binary())], ["model"])

    got = sample.repartition(1).sortWithinPartitions("id").select("text", "y").mapInArrow(learn, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([], [])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = 0.7, limit: int = FIT_DOCUMENTS) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 from ``threshold`` on).

    ``labels`` holds the ids and labels to learn from; every one of them may be learned from, so leave
    held-out rows out. Only the text enters a score. Null and empty texts have no lines and score the
    base rate of label 1. Repeated rows and null ids are scored as they come; labels with a null id or label
    are left out; without any usable label every score is 0.5. Columns called score or predicted are replaced.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y"))
    field = spark.sparkContext.broadcast(fit_on_labels(plain, known, "y", limit, fit_line_field))

    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    safe = [f"c{i}" for i in range(len(rest))]          # a name with a dot cannot pass through mapInArrow
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, safe)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(rest.index(text_col))
            parts = [field.value.documents(data, off) for _, _, data, off in chunks(text)]
            value = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value, pa.float64())], [*safe, "score"])

    schema = StructType([*rows.schema.fields]).add("score", DoubleType())
    return rows.mapInArrow(score, schema).toDF(*rest, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str, modulus: int, remainder: int):
    """Whether crc32 of the id's decimal text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id", 4, 2))
    scored = quality_scores(docs, labels)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")
