"""The queries of this subpackage, by name."""

from __future__ import annotations

from . import divergence, jaccard_join, langid, licenses, link_graph, manifest, mixing, packing, pii, quality, suffix_tree, vectors

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_nearest_neighbours": vectors.op3_nearest_neighbours,
    "op4_suffix_tree_scores": suffix_tree.op4_suffix_tree_scores,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_personal_data": pii.op6_personal_data,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_language_id": langid.op8_language_id,
    "op9_url_filters": link_graph.op9_url_filters,
    "op10_embedding_near_dedup": vectors.op10_embedding_near_dedup,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_quality_scores": quality.op12_quality_scores,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}

#: Where SQL can say the same; the other operators are tested against brute force in tests/llm.
SQL: dict[str, str] = {"op7_ngram_jaccard_join": jaccard_join.SQL, "op10_embedding_near_dedup": vectors.LINKS_SQL, "op11_source_divergence": divergence.SQL, "op13_merkle_manifest": manifest.SQL}
