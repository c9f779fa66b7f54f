"""The queries of this package by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from credmill.llm import (
    bpe,
    embeddings,
    minhash,
    packing,
    personal,
    phrases,
    quality,
    runs,
    suffixes,
    token_files,
    toxicity,
    turns,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": packing.query,
        "op2_divergence_rules": quality.query,
        "op3_lexicon_automata": toxicity.query,
        "op4_phrase_automata": phrases.query,
        "op5_pca_tiles": embeddings.query,
        "op6_bottom_k": minhash.query,
        "op7_url_filter": urls.query,
        "op8_prefix_free_parsing": suffixes.query,
        "op9_token_files": token_files.query,
        "op10_byte_bpe": bpe.query,
        "op11_integer_repair": turns.query,
        "op12_automaton_runs": runs.query,
        "op13_weak_supervision": personal.query,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the tests hold the others against brute force."""
    return {
        "op4_phrase_automata": phrases.ORACLE_SQL,
        "op5_pca_tiles": embeddings.ORACLE_SQL,
        "op6_bottom_k": minhash.ORACLE_SQL,
        "op7_url_filter": urls.ORACLE_SQL,
        "op8_prefix_free_parsing": suffixes.ORACLE_SQL,
    }
