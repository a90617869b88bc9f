"""The registered corpus queries and the SQL counterparts of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import block_neighbours, byte_bpe, fm_quality, license_scan, lm_score, periodic_runs, poisson_mix, prefix_trie, quality_rules, suffix_dedup, token_store, trie_join, url_filters

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_trie_join": trie_join.op1_trie_join,
    "op2_fm_quality": fm_quality.op2_fm_quality,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_lm_score": lm_score.op4_lm_score,
    "op5_token_store": token_store.op5_token_store,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_block_neighbours": block_neighbours.op7_block_neighbours,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_poisson_mix": poisson_mix.op9_poisson_mix,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op1_trie_join": trie_join.ORACLE,
    "op3_url_filters": url_filters.ORACLE,
    "op7_block_neighbours": block_neighbours.ORACLE,
    "op9_poisson_mix": poisson_mix.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_license_scan": license_scan.ORACLE,
}
