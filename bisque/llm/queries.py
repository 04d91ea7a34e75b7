"""The queries of the operators of this folder, and SQL for those that DuckDB can express."""

from __future__ import annotations

from . import op01_pii, op02_fingerprints, op03_mixing, op04_sentencepiece, op05_html, op06_licenses, op07_chat, op08_toxicity, op09_quality, op10_jaccard

QUERIES = {
    "op1_pii": op01_pii.query,
    "op2_fingerprints": op02_fingerprints.query,
    "op3_mixing": op03_mixing.query,
    "op4_sentencepiece": op04_sentencepiece.query,
    "op5_html": op05_html.query,
    "op6_licenses": op06_licenses.query,
    "op7_chat": op07_chat.query,
    "op8_toxicity": op08_toxicity.query,
    "op9_quality": op09_quality.query,
    "op10_jaccard": op10_jaccard.query,
}

ORACLES = {"op7_chat": op07_chat.SQL, "op9_quality": op09_quality.SQL, "op10_jaccard": op10_jaccard.SQL}
