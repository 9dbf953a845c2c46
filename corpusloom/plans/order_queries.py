"""Queries on ordinals, splits, orders, sample indexes and blends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import blending, blocks, ordinals
from corpusloom.session import table

LENGTH = 2048
WEIGHTS = [0.5, 0.3, 0.2]
SIZES = [50, 30, 7]


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", F.octet_length("text").alias("n"))


def sequence_pointers(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.prefix_pointers(_documents(spark, root), ["doc_id"], F.col("n"), 4).select("doc_id", "pointer")


def split_ordinals(spark: SparkSession, root: str) -> DataFrame:
    placed = ordinals.with_prefix(table(spark, root, "documents").select("doc_id"), ["doc_id"])
    return ordinals.contiguous_split(placed, ordinals.split_weights("90,7,3"), ("train", "valid", "test"))


def sample_index(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.sample_boundaries(_documents(spark, root), ["doc_id"], F.coalesce("n", F.lit(0)), LENGTH)


def chunk_concat(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.chunks(_documents(spark, root), ["doc_id"], F.coalesce("n", F.lit(0)), LENGTH)


def epoch_shuffle(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.epoch_order(table(spark, root, "documents").select("doc_id"), "doc_id", 2, 7, separate_last=True)


def support_sets(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.support_set(table(spark, root, "documents").select("source", "doc_id"), "source", "doc_id", 5, 11)


def batch_ranks(spark: SparkSession, root: str) -> DataFrame:
    placed = ordinals.with_prefix(table(spark, root, "documents").select("doc_id"), ["doc_id"])
    batch, rank = ordinals.batch_and_rank(F.col("ord"), 4, 8)
    return placed.where("ord >= 64").select("doc_id", batch.alias("batch"), rank.cast("bigint").alias("rank"))


def even_parts(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").select("doc_id")
    placed = ordinals.with_prefix(rows, ["doc_id"])
    return placed.select("doc_id", ordinals.even_part(F.col("ord"), rows.count(), 7).alias("part"))


def blend_weighted(spark: SparkSession, root: str) -> DataFrame:
    return blending.weighted_blend(spark, WEIGHTS, 100)


def blend_exhaustive(spark: SparkSession, root: str) -> DataFrame:
    return blending.exhaustive_blend(spark, SIZES)


def concat_sources(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "documents").select(F.lit(0).alias("part"), F.col("doc_id").alias("id"), "text")
    b = table(spark, root, "eval_items").select(F.lit(1).alias("part"), F.col("item_id").alias("id"), F.col("passage").alias("text"), "task")
    return a.unionByName(b, allowMissingColumns=True)


def sentence_blocks(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", blocks.sentence_sizes(F.col("text")).alias("sizes"))
    return blocks.sentence_blocks(docs, "doc_id", "sizes", 256, short=0.1)


def titled_blocks(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", blocks.sentence_sizes(F.col("text")).alias("sizes"), F.length(F.coalesce("doi", F.lit(""))).alias("title"))
    return blocks.titled_blocks(docs, "doc_id", "sizes", "title", 512)


QUERIES = {f.__name__: f for f in (sequence_pointers, split_ordinals, sample_index, chunk_concat, epoch_shuffle, support_sets, batch_ranks, even_parts, blend_weighted, blend_exhaustive, concat_sources, sentence_blocks, titled_blocks)}

_STREAM = "WITH d AS (SELECT doc_id, strlen(text) AS n FROM documents WHERE strlen(text) > 0), s AS (SELECT doc_id, n, SUM(n) OVER (ORDER BY doc_id) - n AS start FROM d), t AS (SELECT SUM(n) AS total FROM d)"


def _blend(weights: list[float], limits: list[int] | None, size: int) -> str:
    """The greedy schedule as a recursive query over the counts of each dataset."""
    k = range(len(weights))
    error = [f"({w!r} * GREATEST(i, 1) - c[{j + 1}])" for j, w in enumerate(weights)]
    open_ = [f"c[{j + 1}] < {limits[j]}" if limits else "TRUE" for j in k]
    score = ", ".join(f"CASE WHEN {o} THEN {e} ELSE -1e18 END" for o, e in zip(open_, error, strict=True))
    return f"""WITH RECURSIVE r AS (
        SELECT 0 AS i, [{", ".join("0" for _ in k)}] AS c, 0 AS pick, 0 AS sample
        UNION ALL
        SELECT i + 1, list_transform(c, lambda x, j: x + CASE WHEN j = p THEN 1 ELSE 0 END), p, c[p]
        FROM (SELECT i, c, list_position([{score}], list_max([{score}])) AS p FROM r) WHERE i < {size})
        SELECT CAST(i - 1 AS BIGINT) AS pos, CAST(pick - 1 AS SMALLINT) AS dataset_id, CAST(sample AS BIGINT) AS sample_id FROM r WHERE i > 0"""


def _sizes(extra: str) -> str:
    """Sentence sizes of every document, as the blocks' queries split them."""
    marked = r"regexp_replace(text, '([.!?])[ \t\n\x0b\f\r]+', '\1' || chr(1), 'g')"
    return f"SELECT doc_id, list_transform(list_filter(string_split({marked}, chr(1)), lambda x: x <> ''), lambda x: strlen(x)) AS z{extra} FROM documents WHERE text IS NOT NULL"


def _folded(sizes: str, goal: str) -> str:
    """One step a sentence: a block ends when it is long enough and two sentences remain, or with the document; ``b`` is where it began."""
    return f"""WITH RECURSIVE s AS (SELECT * FROM ({sizes}) WHERE len(z) >= 2 AND list_max(z) <= 512),
        r AS (SELECT doc_id, 0 AS i, 0 AS first, 0 AS length, 0 AS b, FALSE AS done FROM s
        UNION ALL SELECT doc_id, i + 1, CASE WHEN e THEN i + 1 ELSE first END, CASE WHEN e THEN 0 ELSE n END, first, e FROM (
            SELECT r.doc_id, i, first, length + z[i + 1] AS n, (length + z[i + 1] >= {goal} AND len(z) - i - 1 >= 2 AND i + 1 - first >= 2) OR i + 1 = len(z) AS e FROM r JOIN s USING (doc_id) WHERE i < len(z)))"""


_DRAWN = lambda what: f"CAST(('0x' || substr(md5(concat_ws('-', '1', '{what}', doc_id, first)), 1, 12)) AS BIGINT)"
_TITLE = ", length(COALESCE(doi, '')) AS t"
_GOAL = f"(CASE WHEN {_DRAWN('short')} % 1000000 < 100000 THEN 2 + {_DRAWN('size')} % 255 ELSE 256 END)"

SQL = {
    "sentence_blocks": f"{_folded(_sizes(''), _GOAL.replace('doc_id', 'r.doc_id'))} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS INT) AS block, CAST(b AS INT) AS first, CAST(i AS INT) AS last, CAST({_GOAL.replace('first', 'b')} AS INT) AS target FROM r WHERE done",
    "titled_blocks": f"{_folded(_sizes(_TITLE), '(512 - t)')} SELECT doc_id, CAST(b AS INT) AS first, CAST(i AS INT) AS last, row_number() OVER (ORDER BY doc_id, b) - 1 AS block_id FROM r WHERE done",
    "sequence_pointers": "SELECT doc_id, CAST(COALESCE(SUM(strlen(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 4 AS BIGINT) AS pointer FROM documents",
    "split_ordinals": "SELECT doc_id, o AS ord, CASE WHEN o < round_even(0.9 * n, 0) THEN 'train' WHEN o < round_even((0.9 + 0.07) * n, 0) THEN 'valid' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, COUNT(*) OVER () AS n FROM documents)",
    "sample_index": f"""{_STREAM}, g AS (SELECT unnest(generate_series(0, CAST((total - 1) // {LENGTH} AS BIGINT))) AS sample FROM t)
        SELECT CAST(g.sample AS BIGINT) AS sample, s.doc_id, CAST(g.sample * {LENGTH} - s.start AS BIGINT) AS "offset" FROM g JOIN s ON g.sample * {LENGTH} >= s.start AND g.sample * {LENGTH} < s.start + s.n""",
    "chunk_concat": f"""{_STREAM}, g AS (SELECT CAST(unnest(generate_series(0, CAST(total // {LENGTH} - 1 AS BIGINT))) AS BIGINT) AS chunk FROM t)
        SELECT chunk, doc_id, CAST(GREATEST(start, chunk * {LENGTH}) - start AS BIGINT) AS "from", CAST(LEAST(start + n, (chunk + 1) * {LENGTH}) - GREATEST(start, chunk * {LENGTH}) AS BIGINT) AS n
        FROM g JOIN s ON chunk * {LENGTH} < start + n AND (chunk + 1) * {LENGTH} > start""",
    "epoch_shuffle": "SELECT epoch, doc_id, row_number() OVER (ORDER BY epoch, md5(concat_ws('-', '7', epoch, doc_id)), doc_id) - 1 AS pos FROM documents, (SELECT CAST(unnest([0, 1]) AS INT) AS epoch)",
    "support_sets": "SELECT source, doc_id, CAST(rank AS INT) AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(concat_ws('-', '11', doc_id)), doc_id) AS rank FROM documents) WHERE rank <= 5",
    "batch_ranks": "SELECT doc_id, o // 32 AS batch, (o % 32) // 4 AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o FROM documents) WHERE o >= 64",
    "even_parts": "SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INT) AS part FROM documents",
    "blend_weighted": _blend(WEIGHTS, None, 100),
    "blend_exhaustive": _blend([n / sum(SIZES) for n in SIZES], SIZES, sum(SIZES)),
    "concat_sources": "SELECT 0 AS part, doc_id AS id, text, NULL AS task FROM documents UNION ALL SELECT 1, item_id, passage, task FROM eval_items",
}
