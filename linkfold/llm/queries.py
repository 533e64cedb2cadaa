"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, embedding_dedup, line_dedup, minhash_dedup, mixing, substring_dedup, suffix_dedup, token_counts, topk_search, toxicity

QUERIES = {
    "op1_minhash_dedup": minhash_dedup.op1,
    "op2_line_dedup": line_dedup.op2,
    "op3_toxicity": toxicity.op3,
    "op4_substring_dedup": substring_dedup.op4,
    "op5_token_counts": token_counts.op5,
    "op6_topk_search": topk_search.op6,
    "op7_byte_bpe": bpe.op7,
    "op8_mixing": mixing.op8,
    "op9_embedding_dedup": embedding_dedup.op9,
    "op10_suffix_array_dedup": suffix_dedup.op10,
}

ORACLE_SQL = {
    "op1_minhash_dedup": minhash_dedup.OP1_SQL,
    "op4_substring_dedup": substring_dedup.OP4_SQL,
    "op9_embedding_dedup": embedding_dedup.OP9_SQL,
    "op6_topk_search": topk_search.OP6_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op8_mixing": mixing.OP8_SQL,
}
