"""The queries of this folder, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from eventloom.llm import (
    bpe,
    fingerprints,
    jaccard,
    language,
    merkle,
    packing,
    phrases,
    quality,
    repeats,
    scoring,
    sharding,
    urls,
    warc,
)

QUERIES = {
    f.__name__: f
    for f in (
        packing.op1_best_fit_packing,
        urls.op2_temporal_url_list,
        sharding.op3_rendezvous_sharding,
        quality.op4_quality_rules,
        scoring.op5_stupid_backoff,
        bpe.op6_bpe_prefixes,
        repeats.op7_bucket_refinement,
        fingerprints.op8_spot_signatures,
        language.op9_cross_parsing_language,
        jaccard.op10_chosen_path_join,
        warc.op11_arc_to_warc,
        merkle.op12_merkle_manifest,
        phrases.op13_phrase_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op2_temporal_url_list": urls.ORACLE,
    "op3_rendezvous_sharding": sharding.ORACLE,
    "op5_stupid_backoff": scoring.ORACLE,
    "op7_bucket_refinement": repeats.ORACLE,
    "op10_chosen_path_join": jaccard.ORACLE,
    "op11_arc_to_warc": warc.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_phrase_collocations": phrases.ORACLE,
}
