r"""Toxicity categories by a classifier chain.

The categories are predicted in a fixed order; each linear model (logistic
regression) also reads the probabilities of the categories before it. For
training those come from out-of-fold predictions (``FOLDS`` folds), so a later
model never sees an earlier one's answers on its own training rows. In use the
probabilities come from the model fitted on the whole sample.

Features: the set of words of the whole text (letters, lower-cased) and the set
of their five-letter beginnings, hashed to ``WIDTH``. A model keeps those in at
least ``MIN_DOCS`` sampled documents whose share of the category differs from
the sample's by more than ``SCORE`` standard deviations (chance would pass less
than one in a million): labels are noisy, and rare words would learn the noise.

The models are fitted with balanced classes; what they report is moved to the
categories' rates among all labels, so 0.5 is where either answer errs as often.

Sample: at most ``TRAIN_ROWS`` labelled documents, those with the lowest hashes
of the id, half from those with the last category and half from those without.
Only their ids are broadcast (bounded by the sample). A repeated id is one
document of the sample, with its least text.

Categories are columns of the label table: the registered query chains
``low_quality`` (quality 0) and ``toxic``.

Cases: null and empty texts have no words and get the probability of a text
without any known one; they are never toxic. Very long texts are read whole. Equal
hashes of ids go into the sample together; labels with null ids or values are
ignored; a document labelled more than once takes the largest label. Without
labels for a category its probability is 0. Repeated rows get equal results; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import lowest, map_batches, table
from tallyspark.llm.linear import Sparse, sigmoid
from tallyspark.llm.pretokens import Memo
from tallyspark.session import stage

WIDTH = 1 << 20
TRAIN_ROWS = 4000
MIN_DOCS = 4
SCORE = 5.0
L2 = 2e-5
FOLDS = 3
MEMO = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def _hashed(word: str) -> tuple[int, int]:
    return (zlib.crc32(word.encode()) % WIDTH, zlib.crc32(b"^" + word[:5].encode()) % WIDTH)


_features = Memo(_hashed, "", MEMO)  # bounded in entries and their length


def text_features(text: bytes | None) -> np.ndarray:
    words = set(_WORD.findall((text or b"").decode("utf-8", "replace").lower()))
    out = np.array(sorted({f for w in words for f in _features[w]}), np.int32)
    _features.trim()
    return out


def telling(rows: list[np.ndarray], y: np.ndarray, score: float = SCORE) -> np.ndarray:
    """Features, ascending, that occur with ``y`` more or less often than by
    chance: ``score`` standard deviations of the hypergeometric count."""
    found = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    n, rate = len(rows), y.mean() if len(rows) else 0.0
    docs = np.bincount(found, minlength=WIDTH)
    hits = np.bincount(found, np.repeat(y, [len(r) for r in rows]), minlength=WIDTH)
    spread = np.sqrt(docs * rate * (1 - rate) * (1 - docs / max(n, 1)))
    return np.flatnonzero((docs >= MIN_DOCS) & (np.abs(hits - docs * rate) > score * spread) & (spread > 0))


def _places(used: np.ndarray, found: np.ndarray) -> np.ndarray:
    at = np.searchsorted(used, found)
    inside = at < len(used)
    at = at[inside]
    return at[used[at] == found[inside]]


class Linear:
    """One model: its features, their weights, those of the probabilities
    before it, and the intercept."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, before: np.ndarray):
        self.used = telling(rows, y)
        self.w, self.v, self.b = self._sparse(rows, before).fit(y, l2=L2)

    def _sparse(self, rows, before):
        return Sparse([_places(self.used, r) for r in rows], len(self.used), before)

    def many(self, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        return sigmoid(self._sparse(rows, before).dot(self.w, self.v, self.b))

    def one(self, found: np.ndarray, before: list[float]) -> float:
        return float(sigmoid(self.w[_places(self.used, found)].sum() + np.dot(self.v, before) + self.b))


class Chain:
    """Linear models of ``categories``, each fed the probabilities before it."""

    def __init__(self, categories: list[str], rows: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS):
        self.categories, self.models = categories, []
        fold = np.arange(len(rows)) % folds
        before = np.zeros((len(rows), 0))
        for c in range(len(categories)):
            y = labels[:, c]
            if len(np.unique(y)) < 2:
                self.models.append(None)
                before = np.hstack([before, np.full((len(rows), 1), y[0] if len(y) else 0.0)])
                continue
            self.models.append(Linear(rows, y, before))
            if c + 1 < len(categories):
                out = np.zeros((len(rows), 1))
                for f in range(folds):
                    own, other = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                    model = Linear([rows[i] for i in other], y[other], before[other])
                    out[own, 0] = model.many([rows[i] for i in own], before[own])
                before = np.hstack([before, out])
        self.constant = [float(labels[0, c]) if len(labels) else 0.0 for c in range(len(categories))]
        self.shift = [0.0] * len(categories)

    def at_rates(self, rates: list[float]) -> "Chain":
        """Reports probabilities as of categories with these rates."""
        self.shift = [float(np.log(r / (1 - r))) if 0 < r < 1 else 0.0 for r in rates]
        return self

    def predict(self, found: np.ndarray) -> list[float]:
        p: list[float] = []
        for model, constant in zip(self.models, self.constant):
            p.append(constant if model is None else model.one(found, p[:len(model.v)]))
        odds = np.clip(p, 1e-15, 1 - 1e-15)
        moved = sigmoid(np.log(odds / (1 - odds)) + self.shift)
        return [x if m is None else float(y) for x, y, m in zip(p, moved, self.models)]


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS) -> Chain:
    """``labels``: ``doc_id`` and one 0/1 column per category."""
    own = labels.select(F.col("doc_id").alias("id"), *[F.col(c).cast("double").alias(c) for c in categories]).dropna()
    own = own.groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
    own = own.join(docs.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    own = stage(own.withColumn("draw", F.xxhash64("id", F.lit("toxic"))), "toxic-labels")
    last = categories[-1]
    per = own.groupBy(last).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(categories)]).collect()
    counts = {r[last]: r["n"] for r in per}
    rates = [sum(r[f"s{i}"] for r in per) / max(1, sum(counts.values())) for i in range(len(categories))]
    drawn = own.where(lowest(own, last, "draw", counts, max(1, train_rows // 2)) if counts else F.lit(False)).drop("draw")
    # bounded by the sample size, whatever the table's
    sample = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(drawn), "id").groupBy("id", *categories).agg(F.min("text").alias("text"))

    def run(ids, texts, *values):
        return [ids, [text_features(t).tobytes() for t in texts], *values]

    out = map_batches(sample.select(F.col("id").cast("long"), "text", *categories), run,
                      "id long, x binary, " + ", ".join(f"`{c}` double" for c in categories),
                      [("id", pa.int64()), ("x", pa.binary()), *[(c, pa.float64()) for c in categories]]).toArrow()
    ids = np.array(out["id"].to_pylist(), np.int64)
    blobs = out["x"].to_pylist()
    y = np.array([out[c].to_pylist() for c in categories], float).T.reshape(len(ids), len(categories))
    order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(str(ids[i]).encode()), ids[i], blobs[i]))
    return Chain(categories, [np.frombuffer(blobs[i], np.int32) for i in order], y[order]).at_rates(rates)


def judge(docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``p_<category>`` per category and ``<last category>``
    boolean, per row of ``docs``."""
    chain = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, categories, train_rows))

    def run(ids, texts):
        found = [text_features(t) for t in texts]
        p = np.array([chain.value.predict(f) for f in found]).reshape(-1, len(categories))
        return [ids, *p.T, (p[:, -1] >= 0.5) & np.array([len(f) > 0 for f in found], bool)]

    names = [f"p_{c}" for c in categories]
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       "doc_id long, " + ", ".join(f"`{n}` double" for n in names) + f", `{categories[-1]}` boolean",
                       [("doc_id", pa.int64()), *[(n, pa.float64()) for n in names], (categories[-1], pa.bool_())])


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return judge(table(spark, sf_dir, "documents"), labels, ["low_quality", "toxic"])
