"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tempoframe.llm import (
    archives,
    chat,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    lexical,
    licenses,
    line_dedup,
    mixing,
    near_dup,
    quality,
    quality_rules,
    shards,
)

_QUERIES = (
    line_dedup.op1_line_dedup,
    decontaminate.op2_decontamination,
    licenses.op3_license_scan,
    shards.op4_sharding,
    mixing.op5_mixing,
    quality.op6_quality,
    embedding_dedup.op7_embedding_dedup,
    archives.op8_warc,
    chat.op9_chat_format,
    near_dup.op10_near_duplicates,
    hard_negatives.op11_hard_negatives,
    lexical.op12_lexical_search,
    quality_rules.op13_quality_rules,
)
_ORACLES = tuple(
    m.ORACLE for m in (line_dedup, decontaminate, licenses, mixing, embedding_dedup, archives, chat, near_dup, hard_negatives, lexical, quality_rules)
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query functions by name."""
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by the name of its query; left out where SQL cannot express the operator."""
    return {name: sql for part in _ORACLES for name, sql in part.items()}
