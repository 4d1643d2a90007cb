"""One registered query per training-data operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankforge.llm import (ann_search, bpe, conversation_repair, embedding_dedup, hilbert_shards, line_dedup, merkle, mix_sources,
                           oracles, quality, simhash, suffix_dedup, token_files, unit_dedup)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hilbert_shards": hilbert_shards.query,
        "op2_bpe": bpe.query,
        "op3_mix_sources": mix_sources.query,
        "op4_unit_dedup": unit_dedup.query,
        "op5_line_dedup": line_dedup.query,
        "op6_quality": quality.query,
        "op7_token_files": token_files.query,
        "op8_embedding_dedup": embedding_dedup.query,
        "op9_simhash": simhash.query,
        "op10_ann_search": ann_search.query,
        "op11_suffix_dedup": suffix_dedup.query,
        "op12_merkle": merkle.query,
        "op13_conversation_repair": conversation_repair.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_merkle": oracles.merkle(), "op13_conversation_repair": oracles.repair()}
