"""The registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from clickflow.llm import (
    chat, conversation_repair, decontaminate, exact_dedup, hard_negatives, html_extract, mixing, near_dedup,
    pii, quality_classifier, quality_rules, toxicity, url_filter)

QUERIES = {
    "op1_quality": quality_classifier.op1_quality,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_pii": pii.op3_pii,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_chat": chat.op5_chat,
    "op6_main_text": html_extract.op6_main_text,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_mix": mixing.op9_mix,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}

ORACLES = {
    "op4_url_filter": url_filter.ORACLE,
    "op5_chat": chat.ORACLE,
    "op9_mix": mixing.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
