"""Queries of the document operators, by name, and the SQL that computes the same rows."""

from __future__ import annotations

from wearline.llm import (
    bond,
    centroid_tree,
    exact_dedup,
    lm,
    merkle,
    packing,
    quality,
    secret_scan,
    simhash,
    site_style_tree,
    token_files,
    toxicity,
    trie_bpe,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality": quality.op2_quality,
    "op3_simhash": simhash.op3_simhash,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_packing": packing.op5_packing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_token_files": token_files.op7_token_files,
    "op8_merkle": merkle.op8_merkle,
    "op9_lm_scoring": lm.op9_lm_scoring,
    "op10_trie_bpe": trie_bpe.op10_trie_bpe,
    "op11_bond_negatives": bond.op11_bond_negatives,
    "op12_site_style_tree": site_style_tree.op12_site_style_tree,
    "op13_centroid_tree": centroid_tree.op13_centroid_tree,
}
ORACLES = {"op1_exact_dedup": exact_dedup.OP1_SQL, "op8_merkle": merkle.OP8_SQL}
