"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier.

Voters are lexicon voters (one per insult family, plus lists of words and word beginnings induced from the
labelled sample, which reach inflected forms and other languages) and pattern voters
(shouting, exclamation runs, address followed by an insult, insult density, clean prose). The label model is a two-class latent model: the voters' accuracies and the correlations of the voter pairs
that agree beyond independence are estimated by EM on labelled and unlabelled documents together, where
labels anchor which class is which. Its posteriors from the votes alone, for labelled rows too, train the
linear classifier, which alone scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from loanlens.llm.common import LOWER, chunks, word_hashes, word_spans
from loanlens.llm.quality_crf import fit_on_labels, held_out

FIT_DOCUMENTS = 5000       # documented bound of the labelled fitting sample
UNLABELLED_DOCUMENTS = 3000  # and of the documents without a label that join it
EPOCHS = 5                 # passes over the sample that train the classifier
LIFT = 10                  # times as often in toxic documents: words and beginnings for the induced lexicons
INDUCED = 8                # induced lexicons
STEMS = (4, 5, 6, 7, 8)    # bytes of a word's beginning that an induced lexicon may list
HASHES = 1 << 14           # slots of the classifier's word features
# Lexicon families in plain words; the induced lists add what the labelled sample shows.
LEXICONS = {
    "mind": "idiot idiots idiotic moron morons moronic stupid dumb imbecile fool dimwit halfwit brainless",
    "worth": "worthless useless pathetic loser losers nobody failure clown clowns",
    "filth": "trash garbage scum filth filthy disgusting vermin rat pig",
    "hate": "hate hateful despise kill die hang burn",
    "slight": "shut ugly liar coward creep jerk freak",
    "foreign": "dummkopf trottel arschloch idiotas estupido estupida basura imbécil crétin salaud ordure",
}
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:!?\"'()[]{}<>*#%&$|_-=+/\\~^@`"]] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word without punctuation at its ends, hashes of its beginnings, range of words per row).

    Row i of the beginnings belongs to ``STEMS[i]``; a shorter word repeats its whole hash there.
    """
    begin, end, rows = word_spans(data, offsets)
    for _ in range(4):          # strip up to four marks from either end
        strip = (end - begin > 1) & _EDGE[data[begin]] if len(begin) else np.zeros(0, bool)
        begin = begin + strip
        strip = (end - begin > 1) & _EDGE[data[end - 1]] if len(begin) else strip
        end = end - strip
    every = word_hashes(data, np.tile(begin, len(STEMS) + 1), np.concatenate([end, *[np.minimum(end, begin + n) for n in STEMS]]))
    every = every.reshape(len(STEMS) + 1, -1)
    return every[0], every[1:], rows


def _lexicon(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    return np.unique(_words(data, np.array([0, len(data)]))[0])


def _is_in(w: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    if not len(lexicon) or not len(w):
        return np.zeros(len(w), bool)
    return lexicon[np.minimum(np.searchsorted(lexicon, w), len(lexicon) - 1)] == w


def _per_row(flag: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag)])
    return total[rows[1:]] - total[rows[:-1]]


def _votes(data: np.ndarray, offsets: np.ndarray, w: np.ndarray, stems: np.ndarray, rows: np.ndarray, lexicons: list[np.ndarray]) -> np.ndarray:
    """One column per voter: 1 toxic, 0 abstains, -1 clean."""
    size = np.maximum(np.diff(offsets), 1)
    found = [_is_in(w, x) for x in lexicons[:len(LEXICONS)]]
    # the induced lists are looked up once, as one sorted list, and told apart by their value
    induced = np.sort(np.concatenate([np.zeros(0, np.uint64), *lexicons[len(LEXICONS):]]))
    begins = np.zeros(len(w), np.int64)
    if len(induced) and len(w):
        for h in (w, *stems):
            at = np.flatnonzero(_is_in(h, induced))
            begins[at] |= 1 << (h[at] % np.uint64(INDUCED)).astype(np.int64)
    found += [(begins >> i & 1).astype(bool) for i in range(INDUCED)]
    hits = [_per_row(x, rows) for x in found]
    any_hit = _per_row(np.any(found, axis=0) if len(w) else np.zeros(0, bool), rows)
    byte = lambda mask: _per_row(mask, offsets)
    upper = byte((data >= 65) & (data <= 90)) / size
    bang = byte(data == 33) / size
    address = _is_in(w, _lexicon("you your you're he she they tu vous du ihr usted"))
    insult = np.any(found, axis=0) if len(w) else np.zeros(0, bool)
    near = np.zeros(len(w), bool)
    for d in (1, 2, 3):
        near[d:] |= address[:-d] & insult[d:] if len(w) > d else False
    words = rows[1:] - rows[:-1]
    votes = [np.where(h > 0, 1, 0) for h in hits]
    votes += [np.where(any_hit >= 2, 1, 0), np.where(any_hit >= 0.004 * words, any_hit > 0, 0),
              np.where(any_hit < 0.001 * words, -1, 0), np.where(_per_row(near, rows) > 0, 1, 0),
              np.where(upper > 0.5, 1, 0), np.where(bang > 0.03, 1, 0),
              np.where(any_hit == 0, -1, 0), np.where((upper < 0.1) & (bang == 0), -1, 0)]
    return np.stack(votes, axis=1).astype(np.int8)


def _slots(w: np.ndarray) -> np.ndarray:
    return (w >> np.uint64(50)).astype(np.int64)


class LabelModel:
    """Two latent classes; per voter the rates of each vote, per correlated pair a joint table instead of a product."""

    def __init__(self, votes: np.ndarray, known: np.ndarray, rounds: int = 60, pairs: int = 8):
        """``known``: 0 or 1 where a label anchors the class, -1 elsewhere."""
        n, m = votes.shape
        v = votes + 1
        y = known >= 0
        post = np.where(y, known, np.where((votes > 0).any(axis=1), 0.7, 0.1)).astype(np.float64)
        self.pairs = []
        for step in range(2):
            for _ in range(rounds):
                q = np.stack([1 - post, post])
                self.prior = np.clip(q.sum(axis=1) / n, 1e-3, 1)
                self.rate = np.stack([np.stack([(q[:, v[:, j] == a]).sum(axis=1) for a in range(3)], axis=1) for j in range(m)]) + 0.5
                self.rate /= self.rate.sum(axis=2, keepdims=True)
                self.joint = {}
                for i, j in self.pairs:
                    t = np.stack([(q[:, v[:, i] * 3 + v[:, j] == a]).sum(axis=1) for a in range(9)], axis=1) + 0.5
                    self.joint[i, j] = t / t.sum(axis=1, keepdims=True)
                new = np.where(y, known, self.posterior(votes))
                done = np.abs(new - post).max(initial=0) < 1e-4
                post = new
                if done:
                    break
            if step == 0:
                self.pairs = self._correlated(v, post, pairs)

    def _correlated(self, v: np.ndarray, post: np.ndarray, most: int) -> list[tuple[int, int]]:
        """Disjoint pairs of voters with the largest residual correlation given the class."""
        r = np.zeros((v.shape[1],) * 2)
        for c, q in enumerate((1 - post, post)):
            if q.sum() < 10:
                continue
            x = v - (q[:, None] * v).sum(axis=0) / q.sum()
            cov = (x * q[:, None]).T @ x / q.sum()
            d = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            r = np.maximum(r, np.abs(cov / np.outer(d, d)))
        out, used = [], set()
        for k in np.argsort(-np.triu(r, 1), axis=None):
            i, j = divmod(int(k), len(r))
            if i >= j or r[i, j] < 0.2 or len(out) >= most:
                break
            if i not in used and j not in used:
                out.append((i, j))
                used |= {i, j}
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        v = votes + 1
        paired = {k for p in self.pairs for k in p}
        log = np.log(self.prior)[:, None] + sum((np.log(self.rate[j][:, v[:, j]]) for j in range(v.shape[1]) if j not in paired), np.zeros((2, len(v))))
        for i, j in self.pairs:
            log = log + np.log(self.joint[i, j][:, v[:, i] * 3 + v[:, j]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


class ToxicityModel:
    """Linear classifier over word slots and votes; only this part sees the documents at scoring."""

    def __init__(self, lexicons, weights, bias, vote_weights):
        self.lexicons, self.weights, self.bias, self.vote_weights = lexicons, weights, bias, vote_weights

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        low = LOWER[data]
        w, stems, rows = _words(low, offsets)
        votes = _votes(data, offsets, w, stems, rows, self.lexicons)
        # the mean keeps long texts comparable; distinct words would need a set per row and change little
        total = np.concatenate([[0.0], np.cumsum(self.weights[_slots(w)])])
        n = np.maximum(rows[1:] - rows[:-1], 1)
        z = self.bias + votes @ self.vote_weights + (total[rows[1:]] - total[rows[:-1]]) / np.sqrt(n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_toxicity(texts: list[str | None], labels: list[int], epochs: int = EPOCHS) -> ToxicityModel:
    """Induce lexicons, fit the label model, train the classifier on its posteriors. ``labels``: 0, 1, or -1 for none.

    The induced lists split the words and word beginnings that occur in toxic documents far more often, and in
    at least five of them, over ``INDUCED`` voters by their hash. Labels anchor the label model's classes, from which
    it learns the voters' accuracies; the classifier sees none: its target is the posterior of every row, labelled or
    not, from the votes alone.
    """
    base = [_lexicon(x) for x in LEXICONS.values()]
    y = np.array(labels, np.int64)
    column = pa.array([t or "" for t in texts], pa.large_string())

    def parts():                # read again for each use: the words of the whole sample are never held
        for _, _, data, off in chunks(column):
            yield data, off, *_words(LOWER[data], off)

    words = [np.unique(np.concatenate([w[i:j], stems[:, i:j].ravel()])) for _, _, w, stems, rows in parts() for i, j in zip(rows[:-1], rows[1:])]
    bad = [w for w, t in zip(words, y) if t == 1]
    ok = [w for w, t in zip(words, y) if t == 0]
    lexicons = list(base)
    if bad and ok:
        u, n = np.unique(np.concatenate(bad), return_counts=True)
        u2, n2 = np.unique(np.concatenate(ok), return_counts=True)
        k = np.searchsorted(u2, u)
        clean = np.where(u2[np.minimum(k, len(u2) - 1)] == u, n2[np.minimum(k, len(u2) - 1)], 0)
        ratio = ((n + 0.5) / (len(bad) + 1)) / ((clean + 0.5) / (len(ok) + 1))
        pick = u[(n >= 5) & (ratio > LIFT) & (n / len(bad) >= 0.01)]
        lexicons += [pick[pick % np.uint64(INDUCED) == i] for i in range(INDUCED)]
    else:
        lexicons += [np.zeros(0, np.uint64)] * INDUCED
    del words
    votes = [_votes(data, off, w, stems, rows, lexicons) for data, off, w, stems, rows in parts()]
    votes = np.concatenate(votes) if votes else np.zeros((0, len(lexicons) + 8), np.int8)
    empty = ToxicityModel(lexicons, np.zeros(HASHES), float(np.log(0.02 / 0.98)), np.zeros(votes.shape[1]))
    if not bad or not ok:
        return empty
    target = LabelModel(votes, y).posterior(votes)
    # logistic regression by AdaGrad over rows: word slots scaled as in scoring, plus the votes
    weights, bias, vw = np.zeros(HASHES), float(np.log(target.mean() / (1 - target.mean()))), np.zeros(votes.shape[1])
    s_w, s_b, s_v = np.full(HASHES, 1e-3), 1e-3, np.full(len(vw), 1e-3)
    order = np.random.default_rng(7)
    counted = [np.unique(_slots(w[i:j]), return_counts=True) for _, _, w, _, rows in parts() for i, j in zip(rows[:-1].tolist(), rows[1:].tolist())]
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            at, c = counted[i]
            x = c / np.sqrt(max(1, c.sum()))
            z = bias + votes[i] @ vw + weights[at] @ x
            g = target[i] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            gw, gv = g * x - 1e-4 * weights[at], g * votes[i] - 1e-4 * vw
            s_w[at] += gw * gw
            s_v += gv * gv
            s_b += g * g
            weights[at] += 0.03 * gw / np.sqrt(s_w[at])
            vw += 0.1 * gv / np.sqrt(s_v)
            bias += 0.1 * g / np.sqrt(s_b)
    return ToxicityModel(lexicons, weights, bias, vw)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = 0.5, limit: int = FIT_DOCUMENTS,
                    unlabelled: int = UNLABELLED_DOCUMENTS, learn_from: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability of being toxic) and ``predicted`` (1 from ``threshold`` on).

    ``labels`` holds the ids and labels to learn from; leave held-out rows out. ``learn_from`` (``docs`` by default) holds
    the documents the fitting sample is drawn from, ``unlabelled`` of them without a label. Only the text enters a score.
    Null and empty texts score like a text without any word. Repeated rows and null ids are scored as they
    come; labels with a null id or label are left out; without both classes among the labels every score is
    the low base rate 0.02. Columns called score or predicted are replaced.
    """
    spark = docs.sparkSession
    source = docs if learn_from is None else learn_from
    plain = source.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y"))
    model = spark.sparkContext.broadcast(fit_on_labels(plain, known, "y", limit, fit_toxicity, unlabelled))
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    safe = [f"c{i}" for i in range(len(rest))]          # a name with a dot cannot pass through mapInArrow
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, safe)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.scores(data, off) for _, _, data, off in chunks(batch.column(rest.index(text_col)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())], [*safe, "score"])

    schema = StructType([*rows.schema.fields]).add("score", DoubleType())
    return rows.mapInArrow(score, schema).toDF(*rest, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out("doc_id", 5, 0))
    scored = toxicity_scores(docs, labels, learn_from=docs.filter(~held_out("doc_id", 5, 0)))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
