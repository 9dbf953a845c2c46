"""Queries on keys, records and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import corpus
from corpusloom.plans import source_queries
from corpusloom.session import table, wide_table
from corpusloom.sources import gunzip

_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_STRIP = f"'^{_SPACES}+|{_SPACES}+$'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


_DOI = f"""NULLIF({_strip(f"regexp_replace(lower({_strip('doi')}), '^(https://doi[.]org/|http://doi[.]org/|https://dx[.]doi[.]org/|http://dx[.]doi[.]org/|doi:)', '')")}, '')"""


def _side(spark: SparkSession, root: str, name: str) -> DataFrame:
    return wide_table(spark, root, "doi_counts").where(F.col("shard").startswith(name)).select(text.normalize_doi(F.col("doi")).alias("doi"))


def _merged(spark: SparkSession, root: str) -> DataFrame:
    """Keys of the two corpora, told apart by the names of shards; rows without a shard belong to neither."""
    return corpus.merged_counts(_side(spark, root, "core"), _side(spark, root, "s2orc"))


def key_normalize(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "doi_counts").select("row_id", text.normalize_doi(F.col("doi")).alias("key"))


def key_counts(spark: SparkSession, root: str) -> DataFrame:
    return corpus.key_counts(key_normalize(spark, root), "key")


def cmp_key_counts(spark: SparkSession, root: str) -> DataFrame:
    return _merged(spark, root)


def cmp_summary(spark: SparkSession, root: str) -> DataFrame:
    return corpus.comparison(_merged(spark, root))


def set_shared(spark: SparkSession, root: str) -> DataFrame:
    return corpus.shared_keys(_side(spark, root, "core"), _side(spark, root, "s2orc"), "doi")


def set_only_first(spark: SparkSession, root: str) -> DataFrame:
    return corpus.only_first(_side(spark, root, "core"), _side(spark, root, "s2orc"), "doi")


def set_matched(spark: SparkSession, root: str) -> DataFrame:
    return corpus.matched_rows(_side(spark, root, "core"), _side(spark, root, "s2orc"), "doi")


def text_normalize(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("text"))


def line_counts(spark: SparkSession, root: str) -> DataFrame:
    return corpus.line_counts(table(spark, root, "documents").withColumn("source", F.coalesce("source", F.lit("(none)"))), "source", "text")


def record_statistics(spark: SparkSession, root: str) -> DataFrame:
    by = F.regexp_extract("source", "^/corpus/in/([^/]+)/", 1)
    return corpus.line_statistics(wide_table(spark, root, "job_lines").withColumn("corpus", by), "corpus")


def record_classes(spark: SparkSession, root: str) -> DataFrame:
    from corpusloom.functions.records import classified

    return classified(wide_table(spark, root, "job_lines").select("line_id", "line")).groupBy("kind").agg(F.count("*").alias("n"))


def paper_texts(spark: SparkSession, root: str) -> DataFrame:
    return corpus.paper_texts(wide_table(spark, root, "job_lines")).where("outcome = 'kept'").select("line_id", "text")


def text_filter_statistics(spark: SparkSession, root: str) -> DataFrame:
    return corpus.text_statistics(corpus.paper_texts(wide_table(spark, root, "job_lines")), "source")


def gunzip_layers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "jobs").select("job_id", gunzip.bare_name(F.col("source")).alias("bare"), gunzip.layers_of(F.col("source")).alias("layers"))


def gunzip_collisions(spark: SparkSession, root: str) -> DataFrame:
    return gunzip.collisions(table(spark, root, "jobs"))


def gunzip_status(spark: SparkSession, root: str) -> DataFrame:
    return gunzip.status_counts(table(spark, root, "jobs"))


def code_fences(spark: SparkSession, root: str) -> DataFrame:
    said = table(spark, root, "sft_examples").select("example_id", F.coalesce(F.get("_response", F.lit(0))["content"], F.lit("")).alias("x"))
    return said.select("example_id", text.before_fence(F.col("x")).alias("before"), text.fenced_code(F.col("x")).alias("code"))


def thoughts_removed(spark: SparkSession, root: str) -> DataFrame:
    said = table(spark, root, "sft_examples").select("example_id", F.coalesce(F.get("_response", F.lit(0))["content"], F.lit("")).alias("x"))
    return said.select("example_id", text.remove_thought(text.add_thought(F.col("x"))).alias("text"))


def source_subjects(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "jobs").select("job_id", text.subject_of_file(F.col("destination")).alias("subject"))


def sorted_sources(spark: SparkSession, root: str) -> DataFrame:
    """SRT-01: sources with their rank by falling size, of equal ones by name, dealt out to eight workers in turn."""
    from corpusloom.operators import ordinals

    sizes = table(spark, root, "job_lines").groupBy("source").agg(F.sum(F.octet_length(F.coalesce("line", F.lit("")))).alias("n"))
    placed = ordinals.with_prefix(sizes.withColumn("_s", -F.col("n")), ["_s", "source"], name="rank")
    return placed.select("source", "n", "rank", ordinals.rank_of(F.col("rank"), 8).alias("worker"))


QUERIES = {f.__name__: f for f in (sorted_sources, key_normalize, key_counts, cmp_key_counts, cmp_summary, set_shared, set_only_first, set_matched, text_normalize, line_counts, record_statistics, record_classes, paper_texts, text_filter_statistics, gunzip_layers, gunzip_collisions, gunzip_status, code_fences, thoughts_removed, source_subjects)}

_SIDES = f"WITH a AS (SELECT {_DOI} AS doi FROM doi_counts WHERE shard LIKE 'core%'), b AS (SELECT {_DOI} AS doi FROM doi_counts WHERE shard LIKE 's2orc%')"
_MERGED = f"""{_SIDES}, m AS (SELECT doi, SUM(x) AS count_a, SUM(y) AS count_b FROM (SELECT doi, 1 AS x, 0 AS y FROM a UNION ALL SELECT doi, 0, 1 FROM b) WHERE doi IS NOT NULL GROUP BY doi)"""

#: Class, identifier and body of each line, as ``record_fields`` has them in SQL.
_FIELDS = f"WITH f AS ({source_queries.SQL['record_fields']}), l AS (SELECT f.*, j.source, CASE WHEN j.source LIKE '/corpus/in/%/%' THEN string_split(j.source, '/')[4] ELSE '' END AS corpus FROM f JOIN job_lines j USING (line_id))"
_TEXTS = f"WITH t AS ({source_queries.SQL['record_texts']}), l AS (SELECT t.*, j.source FROM t JOIN job_lines j USING (line_id))"

SQL = {
    "record_statistics": f"""{_FIELDS} SELECT corpus, COUNT(*) AS lines, COUNT(*) FILTER (kind = 'empty') AS empty, COUNT(*) FILTER (kind = 'malformed') AS malformed, COUNT(*) FILTER (kind = 'other') AS not_object, COUNT(*) FILTER (kind = 'object') AS valid,
        COUNT(*) FILTER (kind = 'object' AND doi IS NOT NULL) AS with_doi, COUNT(*) FILTER (kind = 'object' AND has_body) AS with_body, COUNT(*) FILTER (kind = 'object' AND doi IS NOT NULL AND has_body) AS with_both, COUNT(*) FILTER (kind = 'object' AND doi IS NULL AND NOT has_body) AS with_neither, COUNT(DISTINCT doi) AS distinct_dois FROM l GROUP BY corpus""",
    "text_filter_statistics": f"""{_TEXTS} SELECT CASE WHEN GROUPING(source) = 1 THEN 'TOTAL' ELSE source END AS source, COUNT(*) AS lines, COUNT(*) FILTER (outcome = 'kept') AS kept, COUNT(*) FILTER (outcome IN ('empty', 'short')) AS empty_or_short, COUNT(*) FILTER (outcome = 'malformed') AS malformed, COUNT(*) FILTER (outcome = 'missing') AS missing FROM l GROUP BY ROLLUP (source)""",
    "sorted_sources": "SELECT source, n, rank, rank % 8 AS worker FROM (SELECT source, n, row_number() OVER (ORDER BY n DESC, source) - 1 AS rank FROM (SELECT source, CAST(SUM(strlen(COALESCE(line, ''))) AS BIGINT) AS n FROM job_lines GROUP BY source))",
    "paper_texts": source_queries.SQL["record_texts"].replace("md5(t) END AS text FROM r", "t END AS text FROM r WHERE outcome = 'kept'").replace("SELECT line_id, outcome, CASE", "SELECT line_id, CASE"),
    "key_normalize": f"SELECT row_id, {_DOI} AS key FROM doi_counts",
    "key_counts": f"SELECT key, COUNT(*) AS n FROM (SELECT {_DOI} AS key FROM doi_counts) WHERE key IS NOT NULL GROUP BY key",
    "cmp_key_counts": f"{_MERGED} SELECT doi, CAST(count_a AS BIGINT) AS count_a, CAST(count_b AS BIGINT) AS count_b FROM m",
    "cmp_summary": f"""{_MERGED} SELECT COUNT(*) FILTER (count_a > 0) AS unique_a, COUNT(*) FILTER (count_b > 0) AS unique_b, COUNT(*) FILTER (count_a > 0 AND count_b > 0) AS shared,
        COUNT(*) FILTER (count_a > 0 AND count_b = 0) AS only_a, COUNT(*) FILTER (count_a = 0 AND count_b > 0) AS only_b, CAST(SUM(LEAST(count_a, count_b)) AS BIGINT) AS matched,
        CAST(SUM(count_a) - COUNT(*) FILTER (count_a > 0) AS BIGINT) AS repeats_a, CAST(SUM(count_b) - COUNT(*) FILTER (count_b > 0) AS BIGINT) AS repeats_b FROM m""",
    "set_shared": f"{_SIDES} SELECT doi FROM a INTERSECT SELECT doi FROM b",
    "set_only_first": f"{_SIDES} SELECT doi FROM a EXCEPT SELECT doi FROM b",
    "set_matched": f"{_SIDES} SELECT doi FROM a INTERSECT ALL SELECT doi FROM b",
    "text_normalize": f"""SELECT doc_id, NULLIF({_strip("replace(replace(replace(replace(nfc_normalize(text), chr(0), ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10) || '..' || chr(10) || '..' || chr(10) || '..', '')")}, '') AS text FROM documents""",
    "line_counts": """SELECT CASE WHEN GROUPING(s) = 1 THEN 'TOTAL' ELSE s END AS source, CAST(SUM(n) AS BIGINT) AS lines FROM (SELECT COALESCE(source, '(none)') AS s,
        CASE WHEN length(text) > 0 THEN len(string_split(regexp_replace(text, '\\n$', ''), chr(10))) ELSE 0 END AS n FROM documents) GROUP BY ROLLUP (s)""",
    "record_classes": r"""SELECT CASE WHEN line IS NULL OR regexp_full_match(line, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]*') THEN 'empty' WHEN NOT json_valid(line) THEN 'malformed' WHEN json_type(line) = 'OBJECT' THEN 'object' ELSE 'other' END AS kind, COUNT(*) AS n FROM job_lines GROUP BY 1""",
    "gunzip_layers": """SELECT job_id, regexp_replace(source, '(?i)(\\.gz)+$', '') AS bare, CAST((length(source) - length(regexp_replace(source, '(?i)(\\.gz)+$', ''))) / 3 AS INT) AS layers FROM jobs""",
    "gunzip_collisions": "SELECT destination, COUNT(DISTINCT source) AS n, MIN(source) AS first_source, MAX(source) AS last_source FROM jobs GROUP BY destination HAVING COUNT(DISTINCT source) > 1",
    "gunzip_status": "SELECT status, COUNT(*) AS n FROM jobs GROUP BY status",
    "code_fences": f"""WITH s AS (SELECT example_id, COALESCE(_response[1].content, '') AS x FROM sft_examples)
        SELECT example_id, {_strip("string_split(x, '```')[1]")} AS before, CASE WHEN regexp_matches(x, '(?s)```\\w*\\n(.*?)```') THEN regexp_extract(x, '(?s)```\\w*\\n(.*?)```', 1) ELSE x END AS code FROM s""",
    "thoughts_removed": "SELECT example_id, regexp_replace(regexp_replace('<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || COALESCE(_response[1].content, ''), '(?s)<think>\\n.*?\\n</think>\\n\\n', '', 'g'), '^\\n+', '') AS text FROM sft_examples",
    "source_subjects": "SELECT job_id, regexp_replace(regexp_replace(destination, '^.*/', ''), '(?:_test|_val|_dev)?\\.[^.]+$', '') AS subject FROM jobs",
}
