"""Queries of the operators, and the SQL that checks those which SQL can express."""

from shelfwise.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    langid,
    licences,
    line_dedup,
    near_vectors,
    ngram_join,
    resampling,
    sharding,
    suffix_dedup,
    toxicity,
    voronoi,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_embedding_near_dedup": near_vectors.query,
    "op3_benchmark_decontamination": decontaminate.query,
    "op4_suffix_array_dedup": suffix_dedup.query,
    "op5_language_id": langid.query,
    "op6_ngram_jaccard_join": ngram_join.query,
    "op7_license_scans": licences.query,
    "op8_sharding": sharding.query,
    "op9_bpe_encoding_and_decoding": bpe.query,
    "op10_line_dedup": line_dedup.query,
    "op11_exact_top_k_search": voronoi.query,
    "op12_importance_resampling": resampling.query,
    "op13_conversation_prefix_trie": conversation_trie.query,
}
SQL = {
    "op3_benchmark_decontamination": decontaminate.SQL,
    "op7_license_scans": licences.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_exact_top_k_search": voronoi.SQL,
    "op12_importance_resampling": resampling.SQL,
    "op13_conversation_prefix_trie": conversation_trie.SQL,
}
