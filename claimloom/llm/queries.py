"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from claimloom.llm import ann, chat, decontaminate, extract, linededup, packing, quality, sharding, simhash, tokencount

QUERIES = {
    "op1_longest_match_counts": tokencount.query,
    "op2_minimum_bin_slack": packing.query,
    "op3_prefix_target_chat": chat.query,
    "op4_multi_index_hashing": ann.query,
    "op5_cuckoo_line_dedup": linededup.query,
    "op6_stratified_interleaving": sharding.query,
    "op7_pairwise_quality": quality.query,
    "op8_simhash_near_dedup": simhash.query,
    "op9_positional_decontamination": decontaminate.query,
    "op10_recurrent_extraction": extract.query,
}
ORACLES: dict[str, str] = {
    "op3_prefix_target_chat": chat.ORACLE,
    "op5_cuckoo_line_dedup": linededup.ORACLE,
    "op9_positional_decontamination": decontaminate.ORACLE,
}
