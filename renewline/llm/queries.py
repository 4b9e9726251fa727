"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from renewline.llm import (
    langid,
    licenses,
    mainhtml,
    negatives,
    neighbours,
    oracles,
    packing,
    periodic,
    repeats,
    secrets,
    sharding,
    simhash,
    suffixtree,
    tiling,
)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_hilbert_shards": sharding.op2_hilbert_shards,
    "op3_remove_repeats": repeats.op3_remove_repeats,
    "op4_length_buckets": packing.op4_length_buckets,
    "op5_simhash_dedup": simhash.op5_simhash_dedup,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_main_text": mainhtml.op7_main_text,
    "op8_decontamination": tiling.op8_decontamination,
    "op9_nearest_neighbours": neighbours.op9_nearest_neighbours,
    "op10_language_id": langid.op10_language_id,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_lm_scoring": suffixtree.op12_lm_scoring,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
ORACLE_SQL = oracles.ORACLE_SQL
