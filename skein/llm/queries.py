"""The queries of the numbered operators and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skein.llm import divergence, embedding_dedup, hard_negatives, html_extract, line_dedup, minhash, mixing, packing, pieces, quality_classifier, quality_rules, sharding, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_dedup": embedding_dedup.op1,
        "op2_quality_classifier": quality_classifier.op2,
        "op3_sharding": sharding.op3,
        "op4_quality_rules": quality_rules.op4,
        "op5_minhash_dedup": minhash.op5,
        "op6_html_extract": html_extract.op6,
        "op7_line_dedup": line_dedup.op7,
        "op8_mix_sources": mixing.op8,
        "op9_url_filter": url_filter.op9,
        "op10_best_fit_packing": packing.op10,
        "op11_hard_negatives": hard_negatives.op11,
        "op12_source_divergence": divergence.op12,
        "op13_sentencepiece": pieces.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_dedup": embedding_dedup.SQL,
        "op3_sharding": sharding.SQL,
        "op5_minhash_dedup": minhash.SQL,
        "op9_url_filter": url_filter.SQL,
        "op11_hard_negatives": hard_negatives.SQL,
        "op12_source_divergence": divergence.SQL,
    }
