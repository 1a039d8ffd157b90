"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from reelsift.llm import op1_mixing, op2_pii, op3_tiff, op4_pieces, op5_minhash, op6_toxicity, op7_license, op8_quality, op9_language, op10_substring

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_pii": op2_pii.op2_pii,
    "op3_tiff": op3_tiff.op3_tiff,
    "op4_pieces": op4_pieces.op4_pieces,
    "op5_minhash": op5_minhash.op5_minhash,
    "op6_toxicity": op6_toxicity.op6_toxicity,
    "op7_license": op7_license.op7_license,
    "op8_quality": op8_quality.op8_quality,
    "op9_language_id": op9_language.op9_language_id,
    "op10_substring": op10_substring.op10_substring,
}

ORACLES = {"op1_mixing": op1_mixing.ORACLE_SQL, "op10_substring": op10_substring.ORACLE_SQL}
