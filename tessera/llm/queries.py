"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import (centroids, fingerprints, lines, mixing, ngram_join, packing, periods, private_data, repeats, ring,
                         secrets, toxicity, vector_join)

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_repeated_passages": repeats.op2_repeated_passages,
    "op3_private_data": private_data.op3_private_data,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_vector_near_copies": vector_join.op7_vector_near_copies,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_ring_shards": ring.op11_ring_shards,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_centroid_clusters": centroids.op13_centroid_clusters,
}

ORACLE = {
    "op1_ngram_jaccard_join": ngram_join.SQL,
    "op2_repeated_passages": repeats.SQL,
    "op4_mix_sources": mixing.MIX_SQL,
    "op5_line_dedup": lines.SQL,
    "op7_vector_near_copies": vector_join.SQL,
    "op11_ring_shards": ring.SQL,
    "op13_centroid_clusters": centroids.SQL,
}
