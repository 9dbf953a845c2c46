"""Queries of the operators for training data, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import chunking, doi_dedup, leakage, mixing, packing, pairs, quality
from corpusloom.session import table, wide_table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return pairs.broken_pairs(wide_table(spark, root, "sft_examples"))


def p2_packed_samples(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed_samples(wide_table(spark, root, "sft_tokens"))


def p2_places(spark: SparkSession, root: str) -> DataFrame:
    return packing.places(wide_table(spark, root, "sft_tokens"))


def p2_totals(spark: SparkSession, root: str) -> DataFrame:
    """What the containers hold in all, and how many containers are over the capacity or have items that overlap or leave a hole."""
    placed = packing.places(wide_table(spark, root, "sft_tokens"))
    packs = placed.groupBy("pack_id").agg(F.count("*").alias("items"), F.sum("n").alias("tokens"), F.sum(F.col("n").cast("bigint") * (2 * F.col("at") + F.col("n"))).alias("covered"), F.max(F.col("at") + F.col("n")).alias("end"))
    # items that lie behind one another from 0 on cover exactly the square of their end
    wrong = (F.col("tokens") > 2048) | (F.col("end") != F.col("tokens")) | (F.col("covered") != F.col("tokens") * F.col("tokens"))
    return packs.agg(F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.count_if(wrong).alias("wrong"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return chunking.split_oversized(wide_table(spark, root, "sft_tokens")).where("piece = 0 AND n_pieces > 1").select("sample_id")


def p4_pieces(spark: SparkSession, root: str) -> DataFrame:
    return chunking.split_oversized(wide_table(spark, root, "sft_tokens"))


def p4_rejoined(spark: SparkSession, root: str) -> DataFrame:
    """Every oversized sample put together again from its pieces, without what they repeat, and its pieces' sizes."""
    pieces = p4_pieces(spark, root)
    own = F.when(F.col("piece") == 0, F.col("input_ids")).otherwise(F.slice("input_ids", 129, F.size("input_ids")))
    whole = pieces.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("piece", own.alias("own")))).alias("p"), F.max(F.size("input_ids")).alias("n"))
    return whole.select("sample_id", F.md5(F.array_join(F.transform(F.flatten("p.own"), lambda x: x.cast("string")), ",")).alias("tokens"), (F.col("n") <= 2048).alias("fits"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return doi_dedup.repeats(wide_table(spark, root, "doi_counts"), doi_dedup.doi_key(F.col("doi")), "row_id")


def p5_records(spark: SparkSession, root: str) -> DataFrame:
    return doi_dedup.records(wide_table(spark, root, "doi_counts"), doi_dedup.doi_key(F.col("doi")), "row_id")


def p6_leaks(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaked_items(wide_table(spark, root, "documents"), table(spark, root, "eval_items"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return p6_leaks(spark, root).select("doc_id", "item_id")


def p7_selected(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mixed(wide_table(spark, root, "documents"), table(spark, root, "mix_targets"), copies=True)[0]


def p7_shares(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mixed(wide_table(spark, root, "documents"), table(spark, root, "mix_targets"), copies=True)[1]


def p8_statistics(spark: SparkSession, root: str) -> DataFrame:
    documents = wide_table(spark, root, "documents")
    return quality.document_quality(documents, quality.train(documents))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return p8_statistics(spark, root).where("kind <> 'prose'").select("doc_id", "kind")


QUERIES = {
    "p1_found": p1_found,
    "p2_packed_samples": p2_packed_samples,
    "p2_places": p2_places,
    "p2_totals": p2_totals,
    "p4_found": p4_found,
    "p4_rejoined": p4_rejoined,
    "p4_pieces": p4_pieces,
    "p5_found": p5_found,
    "p5_records": p5_records,
    "p6_found": p6_found,
    "p6_leaks": p6_leaks,
    "p7_selected": p7_selected,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_statistics": p8_statistics,
}

_BARE = "input_ids[1:COALESCE(list_max(list_filter(range(1, len(input_ids) + 1), lambda i: input_ids[i] IS NULL OR input_ids[i] <> 258)), 0)]"

SQL = {
    "p2_totals": f"WITH t AS (SELECT len({_BARE}) AS n FROM sft_tokens WHERE input_ids IS NOT NULL) SELECT CAST(SUM((n + 2047) // 2048) AS BIGINT) AS items, CAST(SUM(n) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS wrong FROM t",
    "p4_rejoined": f"WITH t AS (SELECT sample_id, {_BARE} AS x FROM sft_tokens WHERE len(input_ids) > 2048) SELECT sample_id, md5(array_to_string(x, ',')) AS tokens, TRUE AS fits FROM t WHERE len(x) > 2048",
    "p4_found": """
        SELECT sample_id FROM sft_tokens
        WHERE COALESCE(len(rtrim(array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = 258 THEN ' ' ELSE 'x' END), ''))), 0) > 2048""",
}
