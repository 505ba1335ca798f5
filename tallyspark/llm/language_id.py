r"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1 bits. One binary classifier per bit
(logistic regression on the square roots of byte bigram and trigram
frequencies, hashed to ``WIDTH`` features) predicts the bit; loss-weighted
decoding adds up each codeword's logistic losses, a bit counting as much as it
was reliable for that language in training, and takes the codeword with the
least loss. ``ambiguous`` flags a text whose two nearest codewords differ by
less than ``MARGIN`` of loss.

Up to six languages have the exhaustive code (every split of the languages in
two), more have random codewords from a fixed seed.

Learned from text and language only, of documents whose crc32(id as text) mod 3
is not 1, at most ``TRAIN_ROWS`` in all (but one of every language) and as many
from every language: those with the lowest hashes of the id. A repeated id is
one document of the sample, with its least text. Prediction reads the whole text and nothing else.

Cases: a null text or one without a letter is ``und`` with score 0. Without any
labelled document every text is ``und``; with one language that is predicted
with score 1. A null id is not held out and not learned from. Repeated rows get
equal results; an empty table gives an empty result; extra columns are ignored,
and kept by ``known_language``.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import filter_batches, lowest, map_batches, table
from tallyspark.llm.linear import fit_dense, sigmoid
from tallyspark.session import stage, unstage

WIDTH = 4096
TRAIN_ROWS = 3000
MARGIN = 0.02
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """Square roots of the hashed byte bigram and trigram frequencies of a
    whole text; digits and punctuation count as space."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    b = np.where((b >= 128) | ((b >= 97) & (b <= 122)), b, 32).astype(np.uint32)
    b = np.concatenate(([32], b, [32])).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(1009) + b[2:] * np.uint32(40503)
    mix = lambda h: ((h * np.uint32(2654435761)) >> np.uint32(20))  # noqa: E731  top 12 bits: WIDTH
    n = np.bincount(mix(two), minlength=WIDTH) + np.bincount(mix(three ^ np.uint32(0x5bd1)), minlength=WIDTH)
    return np.sqrt(n / n.sum()).astype(np.float32)


def codewords(k: int) -> np.ndarray:
    """``k`` rows of +1 / -1 bits."""
    if k <= 1:
        return np.zeros((k, 0), np.int8)
    if k <= 6:
        columns = [c for c in product((1, -1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T
    bits, rng = 16 + 10 * int(np.ceil(np.log2(k))), np.random.default_rng(17)
    while True:
        code = rng.choice(np.array([1, -1], np.int8), (k, bits))
        if len(np.unique(code, axis=0)) == k and (abs(code.sum(axis=0)) < k).all():
            return code


class Model:
    """Classifiers of the bits and their reliability per language."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        bits = self.code[y] if len(langs) > 1 else np.zeros((len(x), 0))
        self.w = fit_dense(x, (bits > 0).astype(np.float32)) if bits.shape[1] else np.zeros((WIDTH + 1, 0), np.float32)
        right = ((x @ self.w[:-1] + self.w[-1]) * bits) > 0
        trust = np.array([right[y == i].mean(axis=0) if (y == i).any() else np.zeros(right.shape[1])
                          for i in range(len(langs))])
        self.trust = (trust + 1e-6) / (trust + 1e-6).sum(axis=1, keepdims=True) if right.shape[1] else trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        margin = features(text) @ self.w[:-1] + self.w[-1]
        loss = (self.trust * -np.log(sigmoid(self.code * margin))).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        p = np.exp(-(loss - loss[order[0]]) * self.code.shape[1])
        return self.langs[order[0]], float(1.0 / p.sum()), bool(loss[order[1]] - loss[order[0]] < MARGIN)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample; the driver gets one feature row per sampled
    document."""
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                        F.col("doc_id").alias("id")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.withColumn("draw", F.xxhash64("id", F.lit("language")))
    ids = stage(known.select("lang", "id", "draw").distinct(), "lang-ids")
    counts = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, WIDTH), np.float32), np.zeros(0, int))
    drawn = lowest(ids, "lang", "draw", counts, max(1, train_rows // len(langs)))
    unstage(ids)
    sample = known.where(drawn).groupBy("lang", "id").agg(F.min("text").alias("text")).select("text", "lang")

    def run(texts, labels):
        return [labels, [features(t.decode("utf-8", "replace")).tobytes() for t in texts]]

    rows = map_batches(sample, run, "lang binary, x binary", [("lang", pa.binary()), ("x", pa.binary())]).toArrow()
    y = np.array([langs.index(v.decode()) for v in rows["lang"].to_pylist()], int)
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(y), WIDTH)
    order = np.lexsort((*x[:, :8].T, x.max(axis=1), y))  # the same rows in the same order on every run
    return Model(langs, x[order], y[order])


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` per row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, train_rows))

    def run(ids, out, texts):
        found = [model.value.predict(None if t is None else t.decode("utf-8", "replace")) for t in texts]
        return [ids, out, *map(list, zip(*found))]

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return map_batches(
        rows, run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean",
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
         ("ambiguous", pa.bool_())])


def known_language(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` (all its columns) without those rejected: ``und`` or
    ambiguous. When nothing could be learned, only texts without a letter go."""
    fitted = fit(docs, train_rows)
    if not fitted.langs:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def keep(text):
        lang, _, ambiguous = model.value.predict(None if text is None else text.decode("utf-8", "replace"))
        return lang != UNKNOWN and not ambiguous

    return filter_batches(docs, "text", keep)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
