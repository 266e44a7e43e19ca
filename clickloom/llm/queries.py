"""The numbered queries by name, and the SQL that checks them."""

from __future__ import annotations

from clickloom.llm import align, bpe, chat, exact, lm, mixing, neardup, prefix, quality, resample, substring, toxicity, warc

QUERIES = {
    "op1_near_dedup": neardup.op1_near_dedup,
    "op2_chat": chat.op2_chat,
    "op3_warc": warc.op3_warc,
    "op4_bpe": bpe.op4_bpe,
    "op8_lm_scores": lm.op8_lm_scores,
    "op9_token_counts": prefix.op9_token_counts,
    "op5_substring_dedup": substring.op5_substring_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_exact_dedup": exact.op7_exact_dedup,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_resample": resample.op11_resample,
    "op12_align": align.op12_align,
    "op13_toxicity": toxicity.op13_toxicity,
}

ORACLE_SQL = {
    "op2_chat": chat.OP2_SQL,
    "op3_warc": warc.OP3_SQL,
    "op7_exact_dedup": exact.OP7_SQL,
    "op11_resample": resample.OP11_SQL,
}
