"""Queries that score predictions and summarise distributions and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import evaluation, ordinals
from corpusloom.session import table
from corpusloom.streaming import streams


def eval_rollup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").withColumn("lang", F.coalesce("lang", F.lit("(none)")))
    return evaluation.accuracy(docs, "lang", F.col("n_chars") == F.length("text"))


def pass_at_k(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.pass_at_k(table(spark, root, "orders").withColumn("passed", F.col("o_orderstatus") == "O"), "o_orderpriority", "passed", [1, 2, 10])


def needle_scores(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "eval_items").where("passage IS NOT NULL AND a IS NOT NULL")
    return items.select("item_id", F.round(text.needle_score(F.col("question"), F.col("passage"), F.col("a")), 9).alias("score"))


def answer_numbers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "eval_items").select("item_id", text.last_number(F.col("question")).alias("number"), text.first_options(F.col("question")).alias("options"), text.first_capital(F.col("question")).alias("capital"))


def exam_scores(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "eval_items").where("answer IS NOT NULL")
    said = F.concat(F.lit("The answer is ("), F.when(F.col("item_id") % 3 == 0, "B").otherwise(F.col("answer")), F.lit(")"))
    return evaluation.scored(items.withColumn("said", said), "mmlu", "task", "said", "answer")


def few_shot_prompts(spark: SparkSession, root: str) -> DataFrame:
    items = table(spark, root, "eval_items")
    support = ordinals.support_set(items.select("task", "item_id", "question"), "task", "item_id", 3, 5)
    return evaluation.few_shot(items.select("item_id", "task"), support, "task", "question").select("item_id", "shots")


def preference_rates(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.preference(table(spark, root, "lineitem"), "l_tax", "l_discount").select(F.round("chosen_reward", 9).alias("chosen_reward"), F.round("rejected_reward", 9).alias("rejected_reward"), F.round("preferred", 9).alias("preferred"))


def value_distribution(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.distribution(table(spark, root, "events"), "value").withColumn("mean", F.round("mean", 6))


def warm_mean(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.warm_mean(table(spark, root, "events"), "event_id", "value", 10, True).select(F.round("mean", 6).alias("mean"))


def event_windows(spark: SparkSession, root: str) -> DataFrame:
    return streams.window_totals(table(spark, root, "events"), "ts", "event_type", "value", "1 hour", "2 hours").select(F.unix_timestamp("start").alias("start"), "event_type", "n")


def question_order(spark: SparkSession, root: str) -> DataFrame:
    return evaluation.in_order(table(spark, root, "eval_items").select("item_id", "question"), F.length("question"), "item_id").select("item_id", "rank")


QUERIES = {f.__name__: f for f in (eval_rollup, pass_at_k, needle_scores, answer_numbers, exam_scores, few_shot_prompts, preference_rates, value_distribution, warm_mean, event_windows, question_order)}

SQL = {
    "eval_rollup": "SELECT CASE WHEN GROUPING(l) = 1 THEN 'total' ELSE l END AS lang, COUNT(*) AS question_n, AVG(CASE WHEN n_chars = length(text) THEN 1 ELSE 0 END) AS acc FROM (SELECT COALESCE(lang, '(none)') AS l, n_chars, text FROM documents) GROUP BY ROLLUP (l)",
    "pass_at_k": """WITH p AS (SELECT o_orderpriority AS t, COUNT(*) AS n, COUNT(*) FILTER (o_orderstatus = 'O') AS c FROM orders GROUP BY 1), k AS (SELECT CAST(unnest([1, 2, 10]) AS INT) AS k),
        e AS (SELECT k, n, CASE WHEN n - c < k THEN 1.0 WHEN c = 0 THEN 0.0 ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: CAST(1 AS DOUBLE) - CAST(k AS DOUBLE) / i)) END AS e FROM p, k)
        SELECT k, AVG(e) AS pass_at_k FROM e GROUP BY k HAVING MIN(n) >= k""",
    "needle_scores": r"""WITH s AS (SELECT item_id, question, a, regexp_replace(question, '\s+', '', 'g') AS x, regexp_replace(passage, '\s+', '', 'g') AS y FROM eval_items WHERE passage IS NOT NULL AND a IS NOT NULL)
        SELECT item_id, round(CASE WHEN contains(question, a) THEN 1.0 ELSE CAST(0.2 AS DOUBLE) * (1 - CAST(levenshtein(x, y) AS DOUBLE) / GREATEST(length(x), length(y))) END, 9) AS score FROM s""",
    "answer_numbers": r"""SELECT item_id, CASE WHEN question IS NULL THEN NULL ELSE COALESCE(regexp_extract_all(string_split(question, 'Question:')[1], '-?\d+(?:\.\d+)?')[-1], 'NULL') END AS number,
        NULLIF(regexp_extract(question, '([A-D]+)', 1), '') AS options, NULLIF(regexp_extract(question, '(\p{Lu})', 1), '') AS capital FROM eval_items""",
    "exam_scores": "SELECT CASE WHEN GROUPING(task) = 1 THEN 'total' ELSE task END AS task, COUNT(*) AS question_n, AVG(CASE WHEN item_id % 3 <> 0 OR answer = 'B' THEN 1 ELSE 0 END) AS acc FROM eval_items WHERE answer IS NOT NULL GROUP BY ROLLUP (task)",
    "few_shot_prompts": "WITH r AS (SELECT task, question, row_number() OVER (PARTITION BY task ORDER BY md5(concat_ws('-', '5', item_id)), item_id) AS k FROM eval_items), s AS (SELECT task, string_agg(question, chr(10) || chr(10) ORDER BY k) AS shots FROM r WHERE k <= 3 GROUP BY task) SELECT item_id, shots FROM eval_items JOIN s USING (task)",
    "preference_rates": "SELECT round(AVG(l_tax), 9) AS chosen_reward, round(AVG(l_discount), 9) AS rejected_reward, round(AVG(CASE WHEN l_tax > l_discount THEN 1 ELSE 0 END), 9) AS preferred FROM lineitem",
    "value_distribution": "SELECT COUNT(value) AS n, COUNT(*) FILTER (value = 0) AS zeros, round(AVG(value), 6) AS mean, MAX(value) AS most, quantile_disc(value, 0.5) AS p5, quantile_disc(value, 0.9) AS p9, quantile_disc(value, 0.99) AS p99, quantile_disc(value, 0.999) AS p999 FROM events",
    "warm_mean": "SELECT round((SUM(value) - MAX(value)) / (COUNT(value) - 1), 6) AS mean FROM events WHERE event_id >= 10",
    "event_windows": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2",
    "question_order": "SELECT item_id, row_number() OVER (ORDER BY length(question), item_id) - 1 AS rank FROM eval_items",
}
