"""Queries of this subpackage and of the pipeline, with the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, cover, divergence, language, license_scan, line_dedup, media, mixing, simhash, suffixes, token_store, url_filter, whitening

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_mixing": mixing.op3_mixing,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_token_store": token_store.op5_token_store,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_simhash": simhash.op7_simhash,
    "op8_embedding_dedup": cover.op8_embedding_dedup,
    "op9_media": media.op9_media,
    "op10_language_id": language.op10_language_id,
    "op11_suffix_dedup": suffixes.op11_suffix_dedup,
    "op12_divergence": divergence.op12_divergence,
    "op13_whitening": whitening.op13_whitening,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op1_line_dedup": line_dedup.ORACLE, "op3_mixing": mixing.ORACLE, "op12_divergence": divergence.ORACLE}
