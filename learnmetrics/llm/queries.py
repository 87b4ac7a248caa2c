"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from learnmetrics.llm import (
    bpe, hardneg, langid, licenses, linededup, neardup, nndescent, packing, prefixtrie, quality, tokencount, topk, trainorder,
)


def queries() -> dict:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_quality": quality.op2_quality,
        "op3_line_dedup": linededup.op3_line_dedup,
        "op4_license_scan": licenses.op4_license_scan,
        "op5_near_dedup": neardup.op5_near_dedup,
        "op6_training_order": trainorder.op6_training_order,
        "op7_byte_bpe": bpe.op7_byte_bpe,
        "op8_nearest": nndescent.op8_nearest,
        "op9_packing": packing.op9_packing,
        "op10_exact_top_k": topk.op10_exact_top_k,
        "op11_token_counts": tokencount.op11_token_counts,
        "op12_prefix_trie": prefixtrie.op12_prefix_trie,
        "op13_hard_negatives": hardneg.op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": linededup.OP3_SQL, "op5_near_dedup": neardup.OP5_SQL, "op10_exact_top_k": topk.OP10_SQL,
        "op12_prefix_trie": prefixtrie.OP12_SQL, "op13_hard_negatives": hardneg.OP13_SQL,
    }
