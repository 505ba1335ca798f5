"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from tallyspark.llm import (bpe, collocations, embedding_dedup, exact_dedup, language_id, piece_bpe, simhash, source_mix, substring_dedup, token_counts,
                            toxicity, url_filter, whitening)

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_source_mix": source_mix.op2_source_mix,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_embedding_near_dedup": embedding_dedup.op4_embedding_near_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_language_id": language_id.op8_language_id,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_sentencepiece": piece_bpe.op12_sentencepiece,
    "op13_collocations": collocations.op13_collocations,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_source_mix": source_mix.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
