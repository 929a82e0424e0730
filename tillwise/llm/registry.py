"""Queries of this folder by name, and the DuckDB statements of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    katz,
    kneser_ney,
    licenses,
    pii,
    prefix_trie,
    quality_rules,
    token_files,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_backoff": katz.op1_katz_backoff,
    "op2_bpe_encode_decode": bpe.op2_bpe_encode_decode,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pii_surrogates": pii.op7_pii_surrogates,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_kneser_ney_quality": kneser_ney.op9_kneser_ney_quality,
    "op10_token_files": token_files.op10_token_files,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

STATEMENTS: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_quality_rules": quality_rules.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
