"""All queries of the library and the SQL that gives the same rows, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import array_queries, compaction_queries, corpus_queries, exam_queries, layout_queries, order_queries, score_queries, source_queries, token_queries

Query = Callable[[SparkSession, str], DataFrame]
_CORE = (compaction_queries, corpus_queries, layout_queries, array_queries, exam_queries, source_queries, order_queries, token_queries, score_queries)


def queries() -> dict[str, Query]:
    return {name: q for m in _CORE for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in _CORE for name, q in m.SQL.items()}
