"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from firesight.llm import bpe, classlm, embeddings, html, merkle, mixing, negatives, quality, secrets, substrings, topk, toxicity
from firesight.llm.simhash import op3_simhash


def queries():
    return {
        "op1_secret_scans": secrets.op1_secret_scans,
        "op2_bpe": bpe.op2_bpe,
        "op3_simhash": op3_simhash,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_embedding_dedup": embeddings.op6_embedding_dedup,
        "op7_class_lm": classlm.op7_class_lm,
        "op8_mixing": mixing.op8_mixing,
        "op9_html": html.op9_html,
        "op10_substring_dedup": substrings.op10_substring_dedup,
        "op11_merkle": merkle.op11_merkle,
        "op12_topk": topk.op12_topk,
        "op13_hard_negatives": negatives.op13_hard_negatives,
    }


def oracle_sql():
    return {"op1_secret_scans": secrets.ORACLE, "op5_quality_rules": quality.ORACLE,
            "op8_mixing": mixing.ORACLE,
            "op10_substring_dedup": substrings.ORACLE, "op11_merkle": merkle.ORACLE,
            "op12_topk": topk.ORACLE, "op13_hard_negatives": negatives.ORACLE}
