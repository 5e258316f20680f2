"""The registered queries of the operators, and their SQL where there is some."""

from __future__ import annotations

from . import (
    align,
    bpe,
    chat,
    decontaminate,
    fingerprints,
    linededup,
    neardup,
    negatives,
    pii,
    quality,
    substring,
    toxicity,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality.op1,
    "op2_chat_formatting": chat.op2,
    "op3_decontamination": decontaminate.op3,
    "op4_near_dedup": neardup.op4,
    "op5_substring_dedup": substring.op5,
    "op6_pii": pii.op6,
    "op7_line_dedup": linededup.op7,
    "op8_toxicity": toxicity.op8,
    "op9_byte_bpe": bpe.op9,
    "op10_warc": warc.op10,
    "op11_hard_negatives": negatives.op11,
    "op12_token_alignment": align.op12,
    "op13_fingerprints": fingerprints.op13,
}

ORACLES = {
    "op1_quality_rules": quality.OP1_SQL,
    "op2_chat_formatting": chat.OP2_SQL,
    "op3_decontamination": decontaminate.OP3_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
}
