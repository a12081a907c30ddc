"""Queries over the whole tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from quarry.llm import bpe, ctph, decontam, huffman, langid, minhash, quality, sharding, substring, toxicity

QUERIES = {
    "op1_sharding": sharding.op1,
    "op2_benchmark_decontamination": decontam.op2,
    "op3_token_huffman": huffman.op3,
    "op4_bpe_encode_decode": bpe.op4,
    "op5_toxicity": toxicity.op5,
    "op6_minhash_near_dedup": minhash.op6,
    "op7_document_fingerprints": ctph.op7,
    "op8_language_id": langid.op8,
    "op9_substring_dedup": substring.op9,
    "op10_quality_classifier": quality.op10,
}

SQL: dict[str, str] = {
    "op2_benchmark_decontamination": decontam.SQL2,
}
