"""The whole pipeline against a brute-force version: the fitted language model
applied row by row, plain Python dedup, DuckDB SQL of the mix and tiktoken."""

from __future__ import annotations

import hashlib
import random
import tempfile
from collections import Counter

import corpus_pipeline
import duckdb
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import bpe, language_id, source_mix
from tallyspark.session import BATCH_BYTES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _documents():
    rnd = random.Random(4)
    words = {"en": ["the", "house", "with", "water", "thing", "shout"], "de": ["über", "schön", "nicht", "zwei", "straße", "ich"]}
    texts = [(" ".join(rnd.choice(words[lang]) + rnd.choice(["", "er", "en"]) for _ in range(rnd.randrange(30, 90))), lang)
             for lang in ("en", "de") for _ in range(25)]
    texts += [(t.replace(" ", "  ", 3), lang) for t, lang in texts[:6]]          # equal without white space
    texts += [(t + " end", lang) for t, lang in texts[20:30]]                    # some within the bit distance
    texts += [(None, "en"), ("", None), ("12 34", "de"), (texts[0][0], None)]
    return [(i, t, lang, rnd.choice(["web", "web", "web", "book", None]), len(t or "")) for i, (t, lang) in enumerate(texts)]


def _fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def _brute_force(spark, rows):
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    kept = []
    for r in rows:
        lang, _, ambiguous = model.predict(r[1])
        if lang != "und" and not ambiguous:
            kept.append(r)
    best = {}
    for r in sorted(kept, key=lambda r: (-len(r[1]), r[0])):
        best.setdefault("".join(r[1].split()), r)
    kept = list(best.values())
    fps = {r[0]: _fingerprint(r[1]) for r in kept}
    comp = {i: i for i in fps}
    for _ in fps:
        comp = {i: min(comp[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4) for i in fps}
    kept = [r for r in kept if comp[r[0]] == r[0]]
    db = duckdb.connect()
    db.register("docs", pd.DataFrame(kept, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    copies = dict(db.sql(f"with {source_mix.mix_sql('docs')} select doc_id, copies from mixed").fetchall())
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.read_ranks(bpe.vocabulary_path(bpe.VOCABULARY)))
    out = Counter()
    for r in kept:
        ids = lib.encode_ordinary(r[1])
        out[r[0], tuple(ids), hashlib.sha256(lib.decode_bytes(ids)).hexdigest()] += copies[r[0]]
    return +out


def test_whole_texts_go_to_python_in_small_batches(spark):
    """The pipeline bounds the bytes of a batch, and its run takes the bound back."""
    texts = spark.range(6000).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("words "), 500).alias("text"))

    def most():
        return max(r.n for r in texts.mapInArrow(sizes, "n long").collect())

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    assert BATCH_BYTES[0] not in spark.conf.getAll and most() > 8 << 20
    try:
        corpus_pipeline.encode(spark, texts, "")
        assert most() < 8 << 20
    finally:
        spark.conf.unset(BATCH_BYTES[0])
    folder = tempfile.mkdtemp(prefix="tallyspark-test-", dir="/tmp")
    spark.createDataFrame(_documents(), SCHEMA).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    corpus_pipeline.run(spark, folder)
    assert BATCH_BYTES[0] not in spark.conf.getAll


def test_pipeline(spark):
    rows = _documents()
    folder = tempfile.mkdtemp(prefix="tallyspark-test-", dir="/tmp")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    expected = _brute_force(spark, rows)
    assert 20 < len(expected) < len(rows) - 6
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in found) == expected
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in found)
