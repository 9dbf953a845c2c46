"""Queries over the decompression jobs and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import compaction
from corpusloom.session import table


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return compaction.small_sources(table(spark, root, "jobs"), table(spark, root, "job_lines"))


def p3_files(spark: SparkSession, root: str) -> DataFrame:
    files = compaction.compacted_files(table(spark, root, "jobs"), table(spark, root, "job_lines"))
    return files.select("corpus", "file_id", "n_blocks", "n_rows", "n_bytes")


def p3_lines(spark: SparkSession, root: str) -> DataFrame:
    files = compaction.compacted_files(table(spark, root, "jobs"), table(spark, root, "job_lines"))
    return compaction.read_files(files).select("corpus", "source", "line_no", "line")


def p3_totals(spark: SparkSession, root: str) -> DataFrame:
    """What the files of each corpus hold, and whether one is larger than allowed without being one line."""
    files = compaction.compacted_files(table(spark, root, "jobs"), table(spark, root, "job_lines"))
    over = F.count_if((F.col("n_bytes") > compaction.FILE_LIMIT) & (F.col("n_rows") > 1))
    return files.groupBy("corpus").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"), over.alias("too_large"))


QUERIES = {"p3_found": p3_found, "p3_files": p3_files, "p3_lines": p3_lines, "p3_totals": p3_totals}

SQL = {
    "p3_found": """
        WITH l AS (SELECT source, line_no, arg_min(line, line_id) AS line FROM job_lines GROUP BY source, line_no),
             s AS (SELECT source, SUM(COALESCE(strlen(line), 0) + 1) AS n FROM l GROUP BY source)
        SELECT j.source FROM (SELECT DISTINCT source FROM jobs WHERE COALESCE(status, '') <> 'failed' AND source IS NOT NULL) j
        LEFT JOIN s ON j.source = s.source WHERE COALESCE(s.n, 0) < 8192""",
    "p3_totals": """
        WITH l AS (SELECT source, line_no, arg_min(line, line_id) AS line FROM job_lines GROUP BY source, line_no),
             c AS (SELECT source, regexp_extract(MIN(destination), '^/corpus/out/([^/]+)/', 1) AS corpus FROM jobs GROUP BY source)
        SELECT COALESCE(c.corpus, '') AS corpus, COUNT(*) AS n_rows, CAST(SUM(COALESCE(strlen(l.line), 0) + 1) AS BIGINT) AS n_bytes, CAST(0 AS BIGINT) AS too_large FROM l LEFT JOIN c ON l.source = c.source GROUP BY 1""",
    "p3_lines": """
        WITH l AS (SELECT source, line_no, arg_min(line, line_id) AS line FROM job_lines GROUP BY source, line_no),
             c AS (SELECT source, regexp_extract(MIN(destination), '^/corpus/out/([^/]+)/', 1) AS corpus FROM jobs GROUP BY source)
        SELECT COALESCE(c.corpus, '') AS corpus, l.source, l.line_no, l.line FROM l LEFT JOIN c ON l.source = c.source""",
}
