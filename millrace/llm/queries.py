"""The registered queries of this subpackage, and SQL where SQL can say the same."""

from __future__ import annotations

from millrace.llm import bpe, centroids, chat, decontaminate, exact_dedup, language, lattice, line_dedup, minhash, planes, prefix_trie, sharding, toxicity

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_bpe_round_trip": bpe.op2_bpe_round_trip,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_byte_shards": sharding.op4_byte_shards,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_id_planes": planes.op7_id_planes,
    "op8_minhash": minhash.op8_minhash,
    "op9_chat_examples": chat.op9_chat_examples,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_centroids": centroids.op12_centroids,
    "op13_lattice_score": lattice.op13_lattice_score,
}

ORACLES = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op5_decontamination": decontaminate.OP5_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_centroids": centroids.OP12_SQL,
}
