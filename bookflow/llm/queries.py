"""Queries of the operators for training text, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, chunks, decontaminate, language, licenses, oracles, pii, quality, simhash, token_count, warc


def queries() -> dict:
    return {"op1_byte_bpe": bpe.op1, "op10_chunk_fingerprints": chunks.op10, "op2_simhash": simhash.op2, "op3_pii_surrogates": pii.op3, "op4_decontamination": decontaminate.op4, "op5_language_id": language.op5, "op6_license_scan": licenses.op6, "op7_warc_index": warc.op7, "op8_token_counts": token_count.op8, "op9_quality": quality.op9}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": oracles.decontamination(), "op6_license_scan": oracles.licenses(), "op7_warc_index": oracles.warc()}
