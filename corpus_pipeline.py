"""The corpus pipeline: documents to token ids.

Stages, each on all that the one before it kept, written as Parquet to the
shared folder and read again:

1. language identification; rejected documents (no letter, or ambiguous) go
2. exact deduplication; one row of each group of equal texts stays
3. SimHash near-deduplication; one document of each component stays
4. mixing sources to target weights; documents come as often as they are taken
5. byte-level BPE encoding, with a decoding of every document to check it

The functions and their parameters are those of ``tallyspark.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bpe, exact_dedup, language_id, simhash, source_mix
from tallyspark.session import BATCH_BYTES, bound_batches, stage, unstage

# Workers of the last stage run beside executors that the other stages have
# filled, so they keep less than the operator does by default. A piece is worth
# more than a state: it saves the way through all of its states.
KEPT_PIECES = 300_000
KEPT_STATES = 60_000
LEARNED_STEPS = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return language_id.known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return bpe.round_trip(docs, with_ids=True, kept=KEPT_PIECES, states=KEPT_STATES, learned=LEARNED_STEPS)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

# A trained classifier, XXH64 bit votes and the merges have no SQL; the tests
# compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bounded = bound_batches(spark)
    try:
        for name, step in STAGES:
            out = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
            unstage(docs)
            docs = out
    finally:
        if bounded:
            spark.conf.unset(BATCH_BYTES[0])
    return docs
