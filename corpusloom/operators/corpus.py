"""Corpus statistics and the comparison of two corpora by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import records, text


def _one(condition: Column) -> Column:
    return F.count_if(condition)


def key_counts(keys: DataFrame, key: str = "doi") -> DataFrame:
    """(key, n) of keys that aren't null; partial counts come before the shuffle, so a hot key costs no more."""
    return keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def merged_counts(a: DataFrame, b: DataFrame, key: str = "doi") -> DataFrame:
    """(key, count_a, count_b): rows of each key on both sides, 0 where it is missing; one shuffle for both sides."""
    both = a.select(F.col(key), F.lit(True).alias("is_a")).unionByName(b.select(F.col(key), F.lit(False).alias("is_a")))
    return both.where(F.col(key).isNotNull()).groupBy(key).agg(_one(F.col("is_a")).alias("count_a"), _one(~F.col("is_a")).alias("count_b"))


def comparison(counts: DataFrame) -> DataFrame:
    """One row: distinct, shared and one-sided keys, one-to-one matched lines, and repeats on each side."""
    a, b = F.col("count_a"), F.col("count_b")
    return counts.agg(
        _one(a > 0).alias("unique_a"),
        _one(b > 0).alias("unique_b"),
        _one((a > 0) & (b > 0)).alias("shared"),
        _one((a > 0) & (b == 0)).alias("only_a"),
        _one((a == 0) & (b > 0)).alias("only_b"),
        F.coalesce(F.sum(F.least(a, b)), F.lit(0)).alias("matched"),
        (F.coalesce(F.sum(a), F.lit(0)) - _one(a > 0)).alias("repeats_a"),
        (F.coalesce(F.sum(b), F.lit(0)) - _one(b > 0)).alias("repeats_b"),
    )


def line_statistics(lines: DataFrame, by: str | None = None) -> DataFrame:
    """Counters of record lines: all, empty, malformed, not an object, valid, with DOI, with body, with both, with neither."""
    d = records.classified(lines).withColumn("doi", text.normalize_doi(F.col("raw_doi")))
    valid, has_doi, body = F.col("kind") == "object", F.col("doi").isNotNull(), F.col("has_body")
    counters = [
        F.count("*").alias("lines"),
        _one(F.col("kind") == "empty").alias("empty"),
        _one(F.col("kind") == "malformed").alias("malformed"),
        _one(F.col("kind") == "other").alias("not_object"),
        _one(valid).alias("valid"),
        _one(valid & has_doi).alias("with_doi"),
        _one(valid & body).alias("with_body"),
        _one(valid & has_doi & body).alias("with_both"),
        _one(valid & ~has_doi & ~body).alias("with_neither"),
        F.countDistinct("doi").alias("distinct_dois"),
    ]
    return d.groupBy(by).agg(*counters) if by else d.agg(*counters)


def paper_texts(lines: DataFrame, field: str = "fullText", least: int = 200) -> DataFrame:
    """The columns of ``lines``, ``outcome`` and ``text`` of every line.

    ``outcome`` is ``empty`` (blank line), ``malformed``, ``missing`` (no object or no such field), ``short`` (fewer than ``least`` characters
    of abstract and body together) or ``kept``; ``text`` is null unless kept. A field that is there but null isn't missing.
    """
    d = records.classified(lines, field=field, strict=True).withColumn("text", text.assemble_text(F.col("abstract"), F.col("body")))
    outcome = (
        F.when(F.col("kind") == "empty", "empty")
        .when(F.col("kind") == "malformed", "malformed")
        .when((F.col("kind") == "other") | ~F.col("has_field"), "missing")
        .when(F.length("text") < least, "short")
        .otherwise("kept")
    )
    return d.withColumn("outcome", outcome).withColumn("text", F.when(F.col("outcome") == "kept", F.col("text"))).drop("kind", "raw_doi", "has_body", "has_field", "abstract", "body")


def text_statistics(texts: DataFrame, by: str) -> DataFrame:
    """Counters of ``paper_texts`` for each value of ``by`` and, under ``TOTAL``, for all."""
    o = F.col("outcome")
    return (
        texts.rollup(by)
        .agg(F.count("*").alias("lines"), _one(o == "kept").alias("kept"), _one(o.isin("empty", "short")).alias("empty_or_short"), _one(o == "malformed").alias("malformed"), _one(o == "missing").alias("missing"), F.grouping_id().alias("_gid"))
        .withColumn(by, F.when(F.col("_gid") == 1, "TOTAL").otherwise(F.col(by)))
        .drop("_gid")
    )


def line_counts(texts: DataFrame, by: str, text_column: str) -> DataFrame:
    """Lines of each value of ``by`` and, under ``TOTAL``, of all; a text without line feed is one line, an empty one none."""
    n = F.when(F.length(text_column) > 0, F.size(F.split(F.regexp_replace(F.col(text_column), r"\n\z", ""), "\n"))).otherwise(0)
    counted = texts.rollup(by).agg(F.sum(n).alias("lines"), F.grouping_id().alias("_gid"))
    return counted.withColumn(by, F.when(F.col("_gid") == 1, "TOTAL").otherwise(F.col(by))).drop("_gid")


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def only_first(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def matched_rows(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The keys as often as they can be matched one to one."""
    return a.select(key).intersectAll(b.select(key))
