"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from fernlink.llm import attention_lm, fertility_rules, packing, piece_codec, quality_classifier, shingle_join, style_tree, suffix_dedup, token_counts, topk_search

QUERIES = {
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_fertility_rules": fertility_rules.op3_fertility_rules,
    "op4_shingle_join": shingle_join.op4_shingle_join,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_piece_codec": piece_codec.op6_piece_codec,
    "op7_style_tree": style_tree.op7_style_tree,
    "op8_attention_lm": attention_lm.op8_attention_lm,
    "op9_topk_search": topk_search.op9_topk_search,
    "op10_packing": packing.op10_packing,
}
SQL: dict[str, str] = {"op9_topk_search": topk_search.SQL}
