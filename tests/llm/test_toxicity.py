"""Toxicity: held-out labels, the chain against plain sums, and odd rows."""

from __future__ import annotations


import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import toxicity

DATA = "/root/testdata/sf0.1"
NAMES = ["low_quality", "toxic"]


def test_held_out(spark):
    """Half of the labels train, the other half judge."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = (spark.read.parquet(f"{DATA}/labels.parquet").where("toxic is not null and quality is not null").groupBy("doc_id")
              .agg(F.max(1 - F.col("quality")).alias("low_quality"), F.max("toxic").alias("toxic")))
    half = F.crc32(F.concat(F.lit("h"), F.col("doc_id").cast("string"))) % 2
    out = toxicity.judge(docs, labels.where(half == 0), NAMES).select("doc_id", F.col("toxic").alias("said"))
    rows = out.join(labels.where(half == 1), "doc_id").dropDuplicates(["doc_id"]).collect()
    hit = sum(r.said and r.toxic for r in rows)
    # about one toxic label in seven is on a text without any telling word
    assert hit >= 0.8 * sum(r.toxic for r in rows)
    assert hit >= 0.95 * sum(r.said for r in rows)


def test_chain_is_what_its_sums_say():
    rng = np.random.default_rng(5)
    rows = [np.array(sorted(set(rng.integers(0, 300, 30)) | ({1000} if i % 4 == 0 else set())), np.int32) for i in range(400)]
    y = np.array([[i % 2 == 0, i % 4 == 0] for i in range(400)], float)
    assert list(toxicity.telling(rows, y[:, 1])) == [f for f in range(1001) if _score(rows, y[:, 1], f) > toxicity.SCORE]
    chain = toxicity.Chain(NAMES, rows, y).at_rates([0.5, 0.1])
    for row in rows[:20] + [np.zeros(0, np.int32)]:
        first, second = chain.models
        a = sum(w for f, w in zip(first.used, first.w) if f in row) + first.b
        b = sum(w for f, w in zip(second.used, second.w) if f in row) + second.v[0] / (1 + np.exp(-a)) + second.b
        want = [1 / (1 + np.exp(-a)), 1 / (1 + np.exp(-b - np.log(0.1 / 0.9)))]
        assert np.allclose(chain.predict(row), want, atol=1e-9)
    assert all((chain.predict(r)[1] >= 0.5) == (i % 4 == 0) for i, r in enumerate(rows))


def _score(rows, y, f):
    has = np.array([f in r for r in rows])
    k, rate = has.sum(), y.mean()
    spread = np.sqrt(k * rate * (1 - rate) * (1 - k / len(rows)))
    return abs(y[has].sum() - k * rate) / spread if k >= toxicity.MIN_DOCS and spread else 0.0


def test_odd_rows(spark):
    rows = [(i, ("vile " if i % 3 == 0 else "") + f"plain words w{i}", i % 3 == 0) for i in range(150)]
    odd = [(None, "vile thing"), (500, None), (501, ""), (502, "1 2 3"), (503, "x" * 300_000 + " vile"), (504, "vile"), (504, "vile")]
    docs = spark.createDataFrame([(i, t, "e") for i, t, _ in rows] + [(i, t, "e") for i, t in odd], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i % 2), int(x)) for i, _, x in rows] + [(None, 1, 1), (500, None, 1)],
                                   "doc_id long, low_quality int, toxic int")
    got = [(r.doc_id, r.toxic) for r in toxicity.judge(docs, labels, NAMES).collect()]
    assert len(got) == 157
    assert {i: x for i, x in got if i is not None and i < 500} == {i: x for i, _, x in rows}
    assert sorted(map(str, (g for g in got if g[0] is None or g[0] >= 500))) == sorted(map(str, [
        (None, True), (500, False), (501, False), (502, False), (503, True), (504, True), (504, True)]))
    none = toxicity.judge(docs, labels.limit(0), NAMES).collect()
    assert {(r.p_low_quality, r.p_toxic, r.toxic) for r in none} == {(0.0, 0.0, False)}
    assert toxicity.judge(docs.limit(0), labels, NAMES).collect() == []
