"""The registered queries of this package and their SQL."""

from __future__ import annotations

from motionframes.llm import ctw, hnsw, kdtree, langid, licenses, minhash, mixing, pieces, pivots, sharding, toxicity, trie, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_exact_top_k": kdtree.op2_exact_top_k,
    "op3_warc_index": warc.op3_warc_index,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_language": langid.op5_language,
    "op6_pieces": pieces.op6_pieces,
    "op7_near_vectors": hnsw.op7_near_vectors,
    "op8_near_duplicates": minhash.op8_near_duplicates,
    "op9_prefix_sum_shards": sharding.op9_prefix_sum_shards,
    "op10_context_tree": ctw.op10_context_tree,
    "op11_license_blocks": licenses.op11_license_blocks,
    "op12_pivot_clusters": pivots.op12_pivot_clusters,
    "op13_prefix_trie": trie.op13_prefix_trie,
}
ORACLES = {
    "op2_exact_top_k": kdtree.OP2_SQL,
    "op3_warc_index": warc.OP3_SQL,
    "op4_mix_sources": mixing.OP4_SQL,
    "op7_near_vectors": hnsw.OP7_SQL,
    "op9_prefix_sum_shards": sharding.OP9_SQL,
    "op11_license_blocks": licenses.OP11_SQL,
    "op12_pivot_clusters": pivots.OP12_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}
