"""Queries and oracles of this subpackage."""

from __future__ import annotations

from hangar.llm import (
    ann,
    bpe,
    licenses,
    lm,
    mixing,
    neardup,
    preference,
    quality,
    repair,
    runs,
    secrets,
    topk,
    toxicity,
)

QUERIES = {f.__name__: f for f in (
    mixing.op1_mixing,
    neardup.op2_minhash_neardup,
    preference.op3_preference_format,
    ann.op4_ann,
    toxicity.op5_toxicity,
    secrets.op6_secret_scan,
    topk.op7_exact_topk,
    bpe.op8_bpe,
    lm.op9_lm_score,
    licenses.op10_license_scan,
    quality.op11_quality_fm,
    runs.op12_periodic_runs,
    repair.op13_conversation_repair,
)}

ORACLES = {"op3_preference_format": preference.ORACLE, "op7_exact_topk": topk.ORACLE}
