"""Queries on conversations, handlers, token arrays and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import arrays
from corpusloom.operators import conversations as C
from corpusloom.operators import handlers, knapsack
from corpusloom.session import wide_table

EOS, ASSISTANT, PAD, LENGTH = 257, 261, 258, 2048
_LAYOUT = C.Mapping(messages="messages", role="role", content="content", user="user", assistant="assistant", observation="observation", function="function", extra=("example_id",))


def _examples(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "sft_examples")


def _messages(spark: SparkSession, root: str) -> DataFrame:
    return _examples(spark, root).select("example_id", F.concat("_prompt", "_response").alias("messages"))


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    return _examples(spark, root).select("example_id", F.col("_prompt").alias("prompt"), F.col("_response").alias("response"), F.col("_system").alias("system"))


def _tokens(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "sft_tokens")


def _labelled(spark: SparkSession, root: str) -> DataFrame:
    """Every sample, its labels filled with -100 or cut to the length of its tokens; null tokens and labels are none."""
    ids = F.coalesce("input_ids", F.array().cast("array<int>"))
    labels = F.coalesce("labels", F.array().cast("array<int>"))
    filled = F.slice(F.concat(labels, F.array_repeat(F.lit(-100), F.greatest(F.size(ids) - F.size(labels), F.lit(0)))), F.lit(1), F.size(ids))
    return _tokens(spark, root).withColumn("labels", filled).withColumn("input_ids", ids)


def _shape(df: DataFrame) -> DataFrame:
    last = F.get("response", F.lit(0))
    return df.select("example_id", F.size("prompt").alias("n_prompt"), F.size("response").alias("n_response"), last["role"].alias("role"), last["content"].alias("content"))


def conv_sharegpt(spark: SparkSession, root: str) -> DataFrame:
    return _shape(C.aligned(_messages(spark, root), "sharegpt", _LAYOUT))


def conv_openai(spark: SparkSession, root: str) -> DataFrame:
    return _shape(C.aligned(_messages(spark, root), "openai", _LAYOUT))


def conv_alpaca(spark: SparkSession, root: str) -> DataFrame:
    rows = _examples(spark, root).select("example_id", F.get("_prompt", F.lit(0))["content"].alias("instruction"), F.col("_system").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"))
    return C.aligned(rows, "alpaca", C.Mapping(extra=("example_id",))).select("example_id", F.get("prompt", F.lit(0))["content"].alias("question"), F.get("response", F.lit(0))["content"].alias("answer"))


def conv_pretrain_text(spark: SparkSession, root: str) -> DataFrame:
    return _messages(spark, root).select("example_id", C.flattened_text(F.col("messages")).alias("text"))


def conv_valid(spark: SparkSession, root: str) -> DataFrame:
    return _examples(spark, root).groupBy(F.coalesce("dataset_name", F.lit("(none)")).alias("dataset")).agg(F.count("*").alias("n"), F.count_if(C.valid_pair("_prompt", "_response")).alias("valid"))


def conv_recent(spark: SparkSession, root: str) -> DataFrame:
    return _messages(spark, root).select("example_id", F.size(C.recent_turns(F.col("messages"))).alias("n"))


def _lengths(df: DataFrame) -> DataFrame:
    trained = F.size(F.filter("labels", lambda x: x != -100)) if "labels" in df.columns else F.lit(0)
    return df.select("example_id", F.size("input_ids").alias("n"), trained.alias("trained"))


def hdl_instruction(spark: SparkSession, root: str) -> DataFrame:
    return _lengths(handlers.tokenized(_pairs(spark, root), "instruction", "example_id", handlers.Options(cutoff=1_000_000)))


def hdl_processed_sft(spark: SparkSession, root: str) -> DataFrame:
    return _lengths(handlers.tokenized(_pairs(spark, root), "processed_sft", "example_id", handlers.Options(cutoff=512, mask_history=True)))


def hdl_prompt_only(spark: SparkSession, root: str) -> DataFrame:
    return _lengths(handlers.tokenized(_pairs(spark, root), "prompt_only", "example_id", handlers.Options(cutoff=1_000_000)))


def hdl_pretrain(spark: SparkSession, root: str) -> DataFrame:
    docs = wide_table(spark, root, "documents").select(F.col("doc_id").alias("example_id"), "text")
    return handlers.tokenized(docs, "general_pretrain", "example_id", handlers.Options(append_eod=True)).select("example_id", F.size("input_ids").alias("n"))


def hdl_prompted(spark: SparkSession, root: str) -> DataFrame:
    rows = _examples(spark, root).select("example_id", F.get("_prompt", F.lit(0))["content"].alias("instruction"), F.get("_response", F.lit(0))["content"].alias("output"))
    return _lengths(handlers.tokenized(rows.withColumn("input", F.lit("")), "general_instruction", "example_id"))


def token_ends(spark: SparkSession, root: str) -> DataFrame:
    return _tokens(spark, root).select("sample_id", F.array_join(arrays.sequence_ends(F.col("input_ids"), EOS), ",").alias("ends"))


def token_positions(spark: SparkSession, root: str) -> DataFrame:
    total = F.aggregate(arrays.positions_after_end(F.col("input_ids"), EOS), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _tokens(spark, root).select("sample_id", total.alias("total"))


def token_spans(spark: SparkSession, root: str) -> DataFrame:
    made = arrays.span_labels(F.col("input_ids"), ASSISTANT, EOS)
    return _tokens(spark, root).select("sample_id", F.size(F.filter(made, lambda x: x != -100)).alias("trained"))


def token_prompt_runs(spark: SparkSession, root: str) -> DataFrame:
    runs = arrays.prompt_runs(F.col("labels"))
    return _tokens(spark, root).where("labels IS NOT NULL").select("sample_id", F.size(runs).alias("runs"), F.get(runs, F.lit(0))["end"].alias("first_end"))


def token_loss_mask(spark: SparkSession, root: str) -> DataFrame:
    kept = arrays.loss_mask(arrays.shifted(F.col("input_ids"))[1], EOS, PAD)
    return _tokens(spark, root).select("sample_id", F.aggregate(kept, F.lit(0), lambda a, x: a + x).alias("counted"))


def token_cut_lengths(spark: SparkSession, root: str) -> DataFrame:
    n, trained = F.size("input_ids"), F.size(F.filter(F.coalesce("labels", F.array().cast("array<int>")), lambda x: x != -100))
    source, target = arrays.inferred_lengths(n - trained, trained, 1024)
    return _tokens(spark, root).where(trained <= n).select("sample_id", source.cast("int").alias("source"), target.cast("int").alias("target"))


def token_cut_turns(spark: SparkSession, root: str) -> DataFrame:
    own = _labelled(spark, root)
    return knapsack.cut_turns(own, LENGTH).select("sample_id", F.size("input_ids").alias("n"), F.size("labels").alias("n_labels"))


def overlength_skipped(spark: SparkSession, root: str) -> DataFrame:
    return handlers.skipped(_tokens(spark, root), ["input_ids"], LENGTH)


def overlength_kept(spark: SparkSession, root: str) -> DataFrame:
    return handlers.without_long(_tokens(spark, root), ["input_ids", "labels"], LENGTH).select("sample_id")


def pack_knapsack(spark: SparkSession, root: str) -> DataFrame:
    own = _labelled(spark, root)
    return knapsack.packed(own, "sample_id", LENGTH, PAD, neat=True).select("pack", "n_samples", "n_tokens", F.size("input_ids").alias("n"), F.array_max("attention_mask").alias("segments"))


def pack_knapsack_batches(spark: SparkSession, root: str) -> DataFrame:
    own = _labelled(spark, root).withColumn("batch", F.floor(F.col("sample_id") / 1000))
    return knapsack.packed(own, "sample_id", LENGTH, PAD, neat=True, extra=1, batch="batch", with_positions=True).select("batch", "pack", "n_samples", "n_tokens", F.size("position_ids").alias("n"))


QUERIES = {f.__name__: f for f in (conv_sharegpt, conv_openai, conv_alpaca, conv_pretrain_text, conv_valid, conv_recent, hdl_instruction, hdl_processed_sft, hdl_prompt_only, hdl_pretrain, hdl_prompted, token_ends, token_positions, token_spans, token_prompt_runs, token_loss_mask, token_cut_lengths, token_cut_turns, overlength_skipped, overlength_kept, pack_knapsack, pack_knapsack_batches)}

_M = "WITH e AS (SELECT *, list_concat(_prompt, _response) AS m FROM sft_examples)"
_OK = "len(_prompt) % 2 = 1 AND len(_response) = 1"
_BYTES = lambda l: f"COALESCE(list_sum(list_transform({l}, lambda x: strlen(COALESCE(x.content, '')))), 0)"  # noqa: E731,E741
_FIRST = "list_filter(range(1, len(input_ids) + 1), lambda i: input_ids[i] = {})"
_HEAD = len("\nBelow is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request. Please note that you need to think through your response logically and step by step.\n")

SQL = {
    "conv_sharegpt": f"""{_M} SELECT example_id, CAST(len(m) - 1 AS INT) AS n_prompt, 1 AS n_response, m[-1].role AS role, m[-1].content AS content FROM e WHERE len(m) > 0 AND len(m) % 2 = 0
        AND len(list_filter(m, lambda x, i: CASE WHEN i % 2 = 1 THEN x.role IN ('user', 'observation') ELSE x.role IN ('assistant', 'function') END)) = len(m)
        AND len(list_filter(m, lambda x: x.content IS NULL)) = 0""",
    "conv_openai": f"""{_M} SELECT example_id, CAST(len(m) - 1 AS INT) AS n_prompt, 1 AS n_response, m[-1].role AS role, COALESCE(m[-1].content, '') AS content FROM e WHERE len(m) > 1
        AND m[1].role IN ('user', 'system') AND m[-1].role = 'assistant' AND len(list_filter(m, lambda x: x.role IN ('user', 'assistant', 'observation', 'function', 'system'))) = len(m)""",
    "conv_alpaca": "SELECT example_id, array_to_string(list_filter([_prompt[1].content, _system], lambda x: x IS NOT NULL AND x <> ''), chr(10)) AS question, _response[1].content AS answer FROM sft_examples WHERE _response[1].content IS NOT NULL",
    "conv_pretrain_text": f"{_M} SELECT example_id, array_to_string(list_transform(m, lambda x: x.content), '') AS text FROM e",
    "conv_valid": f"SELECT COALESCE(dataset_name, '(none)') AS dataset, COUNT(*) AS n, COUNT(*) FILTER ({_OK}) AS valid FROM sft_examples GROUP BY 1",
    "conv_recent": f"{_M} SELECT example_id, CAST(len(m) - COALESCE(list_max(list_filter(range(1, len(m) + 1), lambda i: m[i].role = 'user')), 0) + CASE WHEN len(list_filter(m, lambda x: x.role = 'user')) > 0 THEN 1 ELSE 0 END AS INT) AS n FROM e",
    "hdl_instruction": f"""SELECT example_id, CAST(CASE WHEN {_OK} THEN {_BYTES("_prompt")} + {_BYTES("_response")} + 3 * (len(_prompt) + 1) / 2 ELSE 3 END + 1 + CASE WHEN COALESCE(_system, '') <> '' THEN 1 + strlen(_system) ELSE 0 END AS INT) AS n,
        CAST(CASE WHEN {_OK} THEN {_BYTES("list_filter(_prompt, lambda x, i: i % 2 = 0)")} + {_BYTES("_response")} + (len(_prompt) + 1) / 2 ELSE 1 END AS INT) AS trained FROM sft_examples""",
    "hdl_prompt_only": f"""SELECT example_id, CAST(CASE WHEN {_OK} THEN {_BYTES("list_filter(_prompt, lambda x, i: i % 2 = 1)")} + len(_prompt) + 1 ELSE 2 END + 1 + CASE WHEN COALESCE(_system, '') <> '' THEN 1 + strlen(_system) ELSE 0 END AS INT) AS n, 0 AS trained FROM sft_examples""",
    "hdl_pretrain": "SELECT doc_id AS example_id, CAST(strlen(text) + 1 AS INT) AS n FROM documents WHERE strlen(text) > 0",
    "hdl_prompted": f"""SELECT example_id, CAST({_HEAD} + 16 + strlen(COALESCE(_prompt[1].content, '')) + 3 + 14 + strlen(COALESCE(_response[1].content, '')) + 1 AS INT) AS n,
        CAST(strlen(COALESCE(_response[1].content, '')) + 1 AS INT) AS trained FROM sft_examples""",
    "token_ends": f"""SELECT sample_id, array_to_string(list_concat({_FIRST.format(EOS)}, CASE WHEN len(input_ids) > 0 AND input_ids[-1] <> {EOS} THEN [len(input_ids)] ELSE [] END), ',') AS ends FROM sft_tokens""",
    "token_positions": f"""WITH s AS (SELECT sample_id, len(input_ids) AS n, {_FIRST.format(EOS)} AS e FROM sft_tokens), p AS (SELECT sample_id, list_concat([0], e) AS a, list_concat(e, [n]) AS b FROM s)
        SELECT sample_id, CAST(list_sum(list_transform(range(1, len(a) + 1), lambda i: (b[i] - a[i]) * (b[i] - a[i] - 1) // 2)) AS BIGINT) AS total FROM p""",
    "token_spans": f"""WITH s AS (SELECT sample_id, {_FIRST.format(ASSISTANT)} AS a, {_FIRST.format(EOS)} AS b FROM sft_tokens)
        SELECT sample_id, CAST(COALESCE(list_sum(list_transform(range(1, LEAST(len(a), len(b)) + 1), lambda i: GREATEST(b[i] - a[i] + 1, 0))), 0) AS INT) AS trained FROM s""",
    "token_prompt_runs": """SELECT sample_id, CAST(len(list_filter(range(1, len(labels) + 1), lambda i: labels[i] = -100 AND (i = 1 OR labels[i - 1] <> -100))) AS INT) AS runs,
        CAST(list_filter(range(2, len(labels) + 1), lambda i: labels[i] <> -100 AND labels[i - 1] = -100)[1] - 1 AS INT) AS first_end FROM sft_tokens WHERE labels IS NOT NULL""",
    "token_loss_mask": f"SELECT sample_id, CAST(len(list_filter(input_ids[2:], lambda x: x <> {EOS} AND x <> {PAD})) AS INT) AS counted FROM sft_tokens",
    "token_cut_lengths": """WITH s AS (SELECT sample_id, len(input_ids) AS n, len(list_filter(COALESCE(labels, []), lambda x: x <> -100)) AS t FROM sft_tokens),
        c AS (SELECT sample_id, n - t AS src, t, CASE WHEN t * 2 < 1024 THEN 1024 WHEN (n - t) * 2 < 1024 THEN 1024 - (n - t) ELSE CAST(floor(1024 * (CAST(t AS DOUBLE) / GREATEST(n, 1))) AS BIGINT) END AS most FROM s WHERE t <= n)
        SELECT sample_id, CAST(LEAST(GREATEST(1024 - LEAST(most, t), 0), src) AS INT) AS source, CAST(LEAST(most, t) AS INT) AS target FROM c""",
    "token_cut_turns": f"""WITH RECURSIVE t AS (SELECT sample_id, COALESCE(input_ids, []) AS x, list_concat(COALESCE(labels, []), list_transform(range(0, GREATEST(len(COALESCE(input_ids, [])) - len(COALESCE(labels, [])), 0)), lambda i: -100))[1:len(COALESCE(input_ids, []))] AS y FROM sft_tokens),
        a AS (SELECT *, list_filter(range(1, len(y) + 1), lambda i: y[i] = -100 AND (i = 1 OR y[i - 1] <> -100)) AS a, list_concat(list_filter(range(2, len(y) + 1), lambda i: y[i] <> -100 AND y[i - 1] = -100), [len(y) + 1]) AS b FROM t WHERE len(x) > {LENGTH}),
        r AS (SELECT sample_id, 0 AS k, CAST(0 AS BIGINT) AS used FROM a
        UNION ALL SELECT sample_id, k + 1, used + LEAST(GREATEST(cut - LEAST(most, t), 0), s) + LEAST(most, t) FROM (SELECT sample_id, k, used, s, t, cut, CASE WHEN t * 2 < cut THEN cut WHEN s * 2 < cut THEN cut - s ELSE CAST(trunc(cut * (CAST(t AS DOUBLE) / GREATEST(s + t, 1))) AS BIGINT) END AS most FROM (
            SELECT sample_id, k, used, b[k + 1] - a[k + 1] AS s, COALESCE(a[k + 2], len(y) + 1) - b[k + 1] AS t, {LENGTH} - used AS cut FROM r JOIN a USING (sample_id) WHERE k < len(a) AND used < {LENGTH})))
        SELECT sample_id, CAST(MAX(used) AS INT) AS n, CAST(MAX(used) AS INT) AS n_labels FROM r GROUP BY sample_id UNION ALL SELECT sample_id, CAST(len(x) AS INT), CAST(len(y) AS INT) FROM t WHERE len(x) <= {LENGTH}""",
    "pack_knapsack_batches": f"""WITH RECURSIVE l AS (SELECT sample_id // 1000 AS batch, len(input_ids) AS n FROM sft_tokens WHERE len(input_ids) > 0 AND len(input_ids) <= {LENGTH}), h AS (SELECT batch, list(c ORDER BY k) AS c FROM (SELECT b.batch, k, COUNT(l.n) AS c FROM (SELECT DISTINCT batch FROM l) b CROSS JOIN (SELECT unnest(range(1, {LENGTH + 1})) AS k) LEFT JOIN l ON l.n = k AND l.batch = b.batch GROUP BY b.batch, k) GROUP BY batch),
        r AS (SELECT batch, 0 AS i, c, CAST({LENGTH} AS BIGINT) AS room, 0 AS pack, CAST(0 AS BIGINT) AS n FROM h
        UNION ALL SELECT batch, i + 1, list_transform(c, lambda x, j: CASE WHEN j = pick THEN x - 1 ELSE x END), CASE WHEN fit IS NULL THEN {LENGTH} ELSE room END - pick, CASE WHEN fit IS NULL THEN pack + 1 ELSE pack END, pick FROM (
            SELECT *, COALESCE(fit, top) AS pick FROM (SELECT batch, i, c, room, pack, list_max(list_filter(range(1, room + 1), lambda k: c[k] > 0)) AS fit, list_max(list_filter(range(1, {LENGTH + 1}), lambda k: c[k] > 0)) AS top FROM r)) WHERE top IS NOT NULL)
        SELECT CAST(batch AS BIGINT) AS batch, CAST(pack AS BIGINT) AS pack, CAST(COUNT(*) AS INT) AS n_samples, CAST(SUM(n) AS INT) AS n_tokens, CAST({LENGTH + 1} AS INT) AS n FROM r WHERE i > 0 GROUP BY batch, pack""",
    "hdl_processed_sft": f"""WITH RECURSIVE d AS (SELECT example_id, COALESCE(_system, '') AS s, list_transform(list_concat(_prompt, _response), lambda x: strlen(COALESCE(x.content, ''))) AS t FROM sft_examples WHERE {_OK}),
        r AS (SELECT example_id, 0 AS k, CAST(0 AS BIGINT) AS used, CAST(0 AS BIGINT) AS trained FROM d
        UNION ALL SELECT example_id, k + 1, used + LEAST(GREATEST(cut - LEAST(most, t), 0), s) + LEAST(most, t), CASE WHEN k = 0 THEN LEAST(most, t) ELSE trained END FROM (SELECT *, CASE WHEN t * 2 < cut THEN cut WHEN s * 2 < cut THEN cut - s ELSE CAST(trunc(cut * (CAST(t AS DOUBLE) / (s + t))) AS BIGINT) END AS most FROM (
            SELECT r.example_id, k, used, trained, d.t[len(d.t) - 2 * k - 1] + 2 + CASE WHEN len(d.t) = 2 * k + 2 THEN 1 + CASE WHEN d.s <> '' THEN 1 + strlen(d.s) ELSE 0 END ELSE 0 END AS s, d.t[len(d.t) - 2 * k] + 1 AS t, 512 - used AS cut FROM r JOIN d USING (example_id) WHERE 2 * k < len(d.t) AND used < 512)))
        SELECT example_id, CAST(MAX(used) AS INT) AS n, CAST(arg_max(trained, k) AS INT) AS trained FROM r GROUP BY example_id""",
    "pack_knapsack": f"""WITH RECURSIVE l AS (SELECT LEAST(len(input_ids), {LENGTH - 1}) AS n FROM sft_tokens WHERE len(input_ids) > 0), h AS (SELECT list(c ORDER BY k) AS c FROM (SELECT k, COUNT(n) AS c FROM (SELECT unnest(range(1, {LENGTH})) AS k) LEFT JOIN l ON l.n = k GROUP BY k)),
        r AS (SELECT 0 AS i, c, CAST({LENGTH - 1} AS BIGINT) AS room, 0 AS pack, CAST(0 AS BIGINT) AS n FROM h
        UNION ALL SELECT i + 1, list_transform(c, lambda x, j: CASE WHEN j = pick THEN x - 1 ELSE x END), CASE WHEN fit IS NULL THEN {LENGTH - 1} ELSE room END - pick, CASE WHEN fit IS NULL THEN pack + 1 ELSE pack END, pick FROM (
            SELECT *, COALESCE(fit, top) AS pick FROM (SELECT i, c, room, pack, list_max(list_filter(range(1, room + 1), lambda k: c[k] > 0)) AS fit, list_max(list_filter(range(1, {LENGTH}), lambda k: c[k] > 0)) AS top FROM r)) WHERE top IS NOT NULL)
        SELECT CAST(pack AS BIGINT) AS pack, CAST(COUNT(*) AS INT) AS n_samples, CAST(SUM(n) AS INT) AS n_tokens, CAST({LENGTH} AS INT) AS n, CAST(COUNT(*) AS INT) AS segments FROM r WHERE i > 0 GROUP BY pack""",
    "overlength_skipped": f"SELECT COUNT(*) AS sequences, COUNT(*) FILTER (len(input_ids) >= {LENGTH}) AS skipped FROM sft_tokens",
    "overlength_kept": f"SELECT sample_id FROM sft_tokens WHERE GREATEST(len(input_ids), COALESCE(len(labels), 0)) < {LENGTH}",
}
