"""Queries on chat layouts, handlers and templates, compared value for value."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import conversations as C
from corpusloom.operators import handlers, ordinals, templates, tool_formats
from corpusloom.operators.template_values import TEMPLATES
from corpusloom.plans.digests import digest, sql_told, told, wide
from corpusloom.session import wide_table

LONG = 1_000_000_000
_NAMES = C.Mapping(messages="messages", role="role", content="content", user="user", assistant="assistant", observation="observation", function="function", extra=("example_id", "dataset_name"))


def _examples(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "sft_examples")


def _aligned(df: DataFrame) -> DataFrame:
    return df.select("example_id", told(F.col("prompt")).alias("prompt"), told(F.col("response")).alias("response"), "system", "tools", *[c for c in df.columns if c == "dataset_name"])


def _content(i: Column) -> Column:
    return F.get("_prompt", i)["content"]


# chat layouts


def conv_history(spark: SparkSession, root: str) -> DataFrame:
    """CNV-01, CNV-05, PRJ-02, PRJ-03, PRJ-09, FIL-04: instruction, input and output with history pairs."""
    n = F.floor((F.size("_prompt") - 1) / 2).cast("int")
    pairs = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array(_content(2 * i), _content(2 * i + 1)))).otherwise(F.array().cast("array<array<string>>"))
    rows = _examples(spark, root).select("example_id", "dataset_name", F.element_at("_prompt", -1)["content"].alias("instruction"), F.col("_system").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"), pairs.alias("history"), F.col("_tools").alias("tools"))
    return _aligned(C.aligned(rows, "alpaca", C.Mapping(history="history", tools="tools", extra=("example_id", "dataset_name"))))


def conv_ranked(spark: SparkSession, root: str) -> DataFrame:
    """CNV-01, CNV-02 of ranked records: a chosen and a rejected answer."""
    other = F.struct(F.lit("assistant").alias("role"), F.reverse(F.get("_response", F.lit(0))["content"]).alias("content"))
    rows = _examples(spark, root).select("example_id", "dataset_name", F.col("_prompt").alias("messages"), F.get("_response", F.lit(0)).alias("chosen"), other.alias("rejected"), F.col("_system").alias("system"))
    return _aligned(C.aligned(rows, "sharegpt", _NAMES.renamed(ranking=True, system="system")))


def conv_approved(spark: SparkSession, root: str) -> DataFrame:
    """CNV-06, CNV-07, CNV-10: answers with a tag of approval, whose empty opposite stands beside them."""
    tag = F.when(F.col("example_id") % 3 == 0, True).when(F.col("example_id") % 3 == 1, False)
    rows = _examples(spark, root).select("example_id", "dataset_name", F.concat("_prompt", "_response").alias("messages"), tag.alias("liked"))
    return _aligned(C.aligned(rows, "tagged", _NAMES.renamed(kto_tag="liked")))


def conv_approved_pairs(spark: SparkSession, root: str) -> DataFrame:
    """CNV-06: the same of instruction, input and output."""
    tag = F.when(F.col("example_id") % 3 == 0, True).when(F.col("example_id") % 3 == 1, False)
    rows = _examples(spark, root).select("example_id", _content(F.lit(0)).alias("instruction"), F.lit("").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"), tag.alias("liked"))
    return _aligned(C.aligned(rows, "alpaca", C.Mapping(kto_tag="liked", extra=("example_id",))))


def conv_periodic(spark: SparkSession, root: str) -> DataFrame:
    """CNV-03: system, user's side and assistant's side in turn."""
    said = F.concat("_prompt", "_response")
    three = F.flatten(F.transform(said, lambda t, i: F.when(i % 2 == 0, F.array(C.turn("system", F.coalesce("_system", F.lit("s"))), C.turn(t["role"], t["content"]))).otherwise(F.array(C.turn(t["role"], t["content"])))))
    return _aligned(C.aligned(_examples(spark, root).select("example_id", "dataset_name", three.alias("messages")), "periodic", _NAMES))


def conv_chat(spark: SparkSession, root: str) -> DataFrame:
    """CNV-08, WIN-11: calls become a function turn, results one turn, and the system text gets its note."""
    call = F.struct(F.struct(F.lit("look_up").alias("name"), F.concat(F.lit('{"id": '), F.col("example_id").cast("string"), F.lit("}")).alias("arguments")).alias("function"))
    turn_ = lambda role, content, calls: F.struct(F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"), content.alias("content"), calls.alias("tool_calls"))
    none = F.lit(None).cast("array<struct<function:struct<name:string,arguments:string>>>")
    later = lambda t: F.array(turn_("observation", t["content"], none), turn_("observation", F.lit("seen"), none))
    asked = lambda t, i: F.when((t["role"] == "user") & (i > 0), later(t)).when(t["role"] == "user", F.array(turn_(t["role"], t["content"], none))).otherwise(F.array(turn_(t["role"], t["content"], F.when((i == 1) & (F.col("example_id") % 2 == 0), F.array(call)))))
    said = F.flatten(F.transform(F.concat("_prompt", "_response"), asked))
    lead = F.when(F.length("_system") > 0, F.array(turn_("system", F.col("_system"), none))).otherwise(F.filter(said, lambda _: F.lit(False)))
    return _aligned(C.aligned(_examples(spark, root).select("example_id", "dataset_name", F.concat(lead, said).alias("messages"), F.when(F.col("example_id") % 5 == 0, "[]").alias("tools")), "chat", _NAMES.renamed(tools="tools")))


def conv_since_user(spark: SparkSession, root: str) -> DataFrame:
    """WIN-14: the turns from the user's last one on."""
    return _examples(spark, root).select("example_id", told(C.recent_turns(F.concat("_prompt", "_response"))).alias("turns"))


def conv_dialogue(spark: SparkSession, root: str) -> DataFrame:
    """FIL-05: valid pairs as one dialogue, an empty exchange in place of the others."""
    return _examples(spark, root).select("example_id", told(C.dialogue("_prompt", "_response")).alias("turns"))


def conv_split_marks(spark: SparkSession, root: str) -> DataFrame:
    """STR-05: a dialogue written with marks, taken apart."""
    written = F.array_join(F.transform("_prompt", lambda t, i: F.concat(F.when(i % 2 == 0, "Human:").otherwise("Assistant:"), F.lit(" "), F.coalesce(t["content"], F.lit("")), F.lit("\n"))), "")
    return _examples(spark, root).select("example_id", told(C.split_marked(written)).alias("turns"))


# handlers


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    return _examples(spark, root).select("example_id", F.col("_prompt").alias("prompt"), F.col("_response").alias("response"), F.col("_system").alias("system"))


def _digests(df: DataFrame, *names: str) -> DataFrame:
    return df.select("example_id", *([] if "seq" not in names else ["seq"]), *[digest(F.col(n)).alias(n) for n in names if n != "seq"])


def rows_instruction(spark: SparkSession, root: str) -> DataFrame:
    """HDL-04, HDL-05, ARR-03, TOK-06, TPL-02, TPL-03."""
    return _digests(handlers.tokenized(_pairs(spark, root), "instruction", "example_id", handlers.Options(cutoff=LONG)), "input_ids", "attention_mask", "labels")


def rows_trained_whole(spark: SparkSession, root: str) -> DataFrame:
    """HDL-04 with labels on the prompts as well and an end-of-document token."""
    return _digests(handlers.tokenized(_pairs(spark, root), "instruction", "example_id", handlers.Options(cutoff=LONG, train_on_inputs=True, append_eod=True)), "input_ids", "labels")


def rows_last_answer(spark: SparkSession, root: str) -> DataFrame:
    """HDL-17, FIL-05: invalid rows dropped, only the last answer trains."""
    return _digests(handlers.tokenized(_pairs(spark, root), "processed_sft", "example_id", handlers.Options(cutoff=LONG, mask_history=True)), "input_ids", "labels")


def rows_prompt_only(spark: SparkSession, root: str) -> DataFrame:
    """HDL-08."""
    return _digests(handlers.tokenized(_pairs(spark, root), "prompt_only", "example_id", handlers.Options(cutoff=LONG)), "input_ids")


def rows_before_last(spark: SparkSession, root: str) -> DataFrame:
    """HDL-09."""
    return _digests(handlers.tokenized(_pairs(spark, root), "all_but_last_answer", "example_id", handlers.Options(cutoff=LONG, labels_from_answer=True)), "input_ids", "labels")


def rows_marked(spark: SparkSession, root: str) -> DataFrame:
    """HDL-06, ARR-04."""
    return _digests(handlers.tokenized(_pairs(spark, root), "marked_instruction", "example_id", handlers.Options(cutoff=LONG)), "input_ids", "labels")


def rows_pairwise(spark: SparkSession, root: str) -> DataFrame:
    """HDL-07."""
    both = F.concat("response", F.array(C.turn("assistant", F.reverse(F.get("response", F.lit(0))["content"]))))
    rows = _pairs(spark, root).where("size(prompt) % 2 = 1 AND size(response) = 1").withColumn("response", both)
    return _digests(handlers.tokenized(rows, "pairwise", "example_id"), "chosen_input_ids", "chosen_labels", "rejected_input_ids", "rejected_labels")


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return wide_table(spark, root, "documents").withColumn("example_id", F.col("doc_id"))


def rows_text(spark: SparkSession, root: str) -> DataFrame:
    """HDL-01, HDL-19, ARR-02."""
    return _digests(handlers.tokenized(_documents(spark, root).select("example_id", "text"), "general_pretrain", "example_id", handlers.Options(append_eod=True)), "input_ids")


def rows_text_padded(spark: SparkSession, root: str) -> DataFrame:
    """ARR-01, TOK-06: texts filled up to a multiple of eight tokens."""
    return _digests(handlers.tokenized(_documents(spark, root).select("example_id", "text"), "general_pretrain", "example_id", handlers.Options(append_eod=True, pad_to_multiple=8)), "input_ids")


def _parts(whole: str) -> list[str]:
    return whole.split(". ")


def rows_sentences(spark: SparkSession, root: str) -> DataFrame:
    """STR-04, FIL-08, UDF-01: a splitter of one's own; empty parts are skipped."""
    return _digests(handlers.tokenized(_documents(spark, root).select("example_id", "text"), "general_pretrain", "example_id", handlers.Options(split=_parts)), "seq", "input_ids")


def rows_alpaca_text(spark: SparkSession, root: str) -> DataFrame:
    """HDL-02, PRJ-08."""
    rows = _examples(spark, root).select("example_id", _content(F.lit(0)).alias("instruction"), F.col("_system").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"))
    return _digests(handlers.tokenized(rows, "alpaca_pretrain", "example_id"), "input_ids")


def rows_messages_text(spark: SparkSession, root: str) -> DataFrame:
    """HDL-03, PRJ-07."""
    rows = _examples(spark, root).select("example_id", F.filter(F.concat("_prompt", "_response"), lambda t: t["content"].isNotNull()).alias("messages"))
    return _digests(handlers.tokenized(rows, "sharegpt_pretrain", "example_id"), "input_ids")


def rows_forum(spark: SparkSession, root: str) -> DataFrame:
    """HDL-15, PRJ-06."""
    rows = _documents(spark, root).select("example_id", F.col("doi").alias("title"), F.col("source").alias("question_body"), F.col("text").alias("answer_body"))
    return _digests(handlers.tokenized(rows, "forum_pretrain", "example_id"), "input_ids")


def rows_prompted(spark: SparkSession, root: str) -> DataFrame:
    """HDL-10, TPL-01, ARR-03."""
    rows = _examples(spark, root).select("example_id", _content(F.lit(0)).alias("instruction"), F.col("_system").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"))
    return _digests(handlers.tokenized(rows, "general_instruction", "example_id"), "input_ids", "labels")


def rows_marked_turns(spark: SparkSession, root: str) -> DataFrame:
    """HDL-11, STR-05."""
    written = F.array_join(F.transform("_prompt", lambda t, i: F.concat(F.when(i % 2 == 0, "Human:").otherwise("Assistant:"), F.lit(" "), F.coalesce(t["content"], F.lit("")), F.lit("\n"))), "")
    rows = _examples(spark, root).where("size(_prompt) % 2 = 1").select("example_id", F.concat(written, F.lit("Assistant:")).alias("instruction"), F.get("_response", F.lit(0))["content"].alias("output"))
    return _digests(handlers.tokenized(rows, "marked_turns", "example_id"), "input_ids")


def _chats(spark: SparkSession, root: str) -> DataFrame:
    n = F.floor((F.size("_prompt") + 1) / 2).cast("int")
    said = F.concat("_prompt", "_response")
    at = lambda i: F.coalesce(F.get(said, i)["content"], F.lit(""))
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.concat(F.lit("<|Human|>: "), at(2 * i), F.lit("<eoh>\n")).alias("Human"), F.concat(F.lit("<|MOSS|>: "), at(2 * i + 1), F.lit("<eom>\n")).alias("MOSS")))
    return _examples(spark, root).where("size(_prompt) % 2 = 1 AND size(_response) = 1").select("example_id", pairs.alias("chat"))


def rows_role_ids(spark: SparkSession, root: str) -> DataFrame:
    """HDL-12, STR-06."""
    return _digests(handlers.tokenized(_chats(spark, root), "role_id_turns", "example_id"), "input_ids", "labels")


def rows_prefixes(spark: SparkSession, root: str) -> DataFrame:
    """HDL-13, UDF-02: a row of tokens for each prefix of a dialogue."""
    return _digests(handlers.tokenized(_chats(spark, root), "every_prefix", "example_id"), "seq", "input_ids")


def rows_code(spark: SparkSession, root: str) -> DataFrame:
    """HDL-14, STR-07."""
    said = F.get("_response", F.lit(0))["content"]
    rows = _examples(spark, root).select("example_id", said.alias("code_with_problem"), text.fenced_code(said).alias("code_only"), F.col("_system").alias("explanation_only"))
    return _digests(handlers.tokenized(rows, "code_instruction", "example_id"), "input_ids")


def rows_unknown_handler(spark: SparkSession, root: str) -> DataFrame:
    """UDF-01, UDF-03: an unknown name falls back to the plain text handler, run batch by batch."""
    return _digests(handlers.tokenized(_documents(spark, root).select("example_id", "text"), "no_such_handler", "example_id").select("example_id", "input_ids"), "input_ids")


def rows_pretrain_cut(spark: SparkSession, root: str) -> DataFrame:
    """HDL-16, PCK-07: texts with begin and end tokens, cut off."""
    return _digests(handlers.pretrain_rows(_documents(spark, root), "example_id", "text", 256, add_bos=True), "input_ids")


def rows_pretrain_blocks(spark: SparkSession, root: str) -> DataFrame:
    """HDL-16, PCK-08: texts of every fifty rows in blocks that begin with the begin token."""
    made = handlers.pretrain_blocks(_documents(spark, root), "example_id", "text", 512, batch=50, add_bos=True)
    return made.select("batch", "block", F.md5(wide(F.col("input_ids"))).alias("input_ids"))


def moss_cleaned(spark: SparkSession, root: str) -> DataFrame:
    """STR-06."""
    c = F.coalesce(F.get("_response", F.lit(0))["content"], F.lit(""))
    marked = lambda a, b: F.concat(F.lit(a), c, F.lit(b))
    return _examples(spark, root).select("example_id", text.moss_user(marked("<|Human|>: ", "<eoh>\n")).alias("user"), text.moss_assistant(marked("<|MOSS|>: ", "<eom>\n")).alias("assistant"))


# templates


def _plain_templates() -> list[str]:
    return sorted(n for n, t in templates.REGISTRY.items() if not t.reasoning)


def tpl_rendered(spark: SparkSession, root: str) -> DataFrame:
    """TPL-02, TPL-05, TPL-06, TPL-09, TPL-11, TPL-14, UDF-05: valid dialogues as text under every template."""
    names = sorted(templates.REGISTRY)
    rows = _pairs(spark, root).where("size(prompt) % 2 = 1 AND size(response) = 1").select("example_id", F.concat("prompt", "response").alias("turns"), "system")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            out: list[tuple] = []
            for row in b.to_pylist():
                turns = [(t["role"], t["content"] or "") for t in row["turns"]]
                out += [(row["example_id"], n, hashlib.md5(templates.rendered(templates.template(n), turns, row["system"]).encode()).hexdigest()) for n in names]
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["example_id", "template", "text"])

    return rows.mapInArrow(run, "example_id bigint, template string, text string")


def tpl_thoughts(spark: SparkSession, root: str) -> DataFrame:
    """TPL-07, STR-08, STR-09: answers get an empty thought where thinking is on; only the ids of prompts have it where it is off."""
    rows = _pairs(spark, root).where("size(prompt) % 2 = 1 AND size(response) = 1").select("example_id", F.concat("prompt", "response").alias("turns"), "system")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from dataclasses import replace

        tok = handlers.Options().tokenizer
        t = templates.Template(user=("U", "{{content}}", "A"), assistant=("{{content}}", "\n"), system=("S", "{{content}}"), cut="longer", reasoning=True)
        for b in batches:
            out: list[list] = [[], [], []]
            for row in b.to_pylist():
                turns = [(x["role"], x["content"] or "") for x in row["turns"]]
                for column, thinking in zip(out[1:], (True, False), strict=True):
                    pairs = templates.encoded_pairs(replace(t, thinking=thinking), turns, row["system"], None, tok)
                    column.append("|".join(f"{tok.decode(a)}>{tok.decode(z)}" for a, z in pairs))
                out[0].append(row["example_id"])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names=["example_id", "on", "off"])

    made = rows.mapInArrow(run, "example_id bigint, on string, off string")
    return made.select("example_id", F.md5("on").alias("on"), F.md5("off").alias("off"))


def tpl_tools(spark: SparkSession, root: str) -> DataFrame:
    """TPL-12, TPL-13, TPL-16, JSN-01, JSN-02, JSN-03: tools described, calls written and read back."""
    rows = wide_table(spark, root, "jobs").select("job_id", F.coalesce("status", F.lit("none")).alias("status"), F.coalesce("suffix_layers", F.lit(0)).alias("layers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for r in b.to_pylist():
                tool = {"name": r["status"], "description": "d", "parameters": {"type": "object", "properties": {"n": {"type": "integer", "description": "how many"}, "kind": {"type": "string", "description": "é", "enum": ["a", "b"]}}, "required": ["n"]}}
                call = [{"name": r["status"], "arguments": {"n": r["layers"]}}]
                written = tool_formats.written(tool_formats.dumped(call))
                read = tool_formats.extracted(written)
                plain = tool_formats.extracted(f'Action: {r["status"]}\nAction Input: {{"n": {r["layers"]}}}')
                for column, v in zip(out, (r["job_id"], tool_formats.described(tool_formats.dumped([tool])), tool_formats.described(tool_formats.dumped([tool]), "tagged"), written, f"{read[0]}{plain[0]}"), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *[pa.array(c, pa.string()) for c in out[1:]]], names=["job_id", "plain", "tagged", "written", "read"])

    return rows.mapInArrow(run, "job_id bigint, plain string, tagged string, written string, read string")


def tpl_shared_lengths(spark: SparkSession, root: str) -> DataFrame:
    """TPL-04: prompt and answer cut so that the answer has its share."""
    rows = wide_table(spark, root, "sft_tokens").select("sample_id", F.size(F.coalesce("input_ids", F.array().cast("array<int>"))).alias("n"), F.size(F.filter(F.coalesce("labels", F.array().cast("array<int>")), lambda x: x != -100)).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [templates.shared_lengths(max(n - t, 0), t, 1024) for n, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([a for a, _ in cut], pa.int32()), pa.array([a for _, a in cut], pa.int32())], names=["sample_id", "source", "target"])

    return rows.mapInArrow(run, "sample_id bigint, source int, target int")


_CORE = (conv_history, conv_ranked, conv_approved, conv_approved_pairs, conv_periodic, conv_chat, conv_since_user, conv_dialogue, conv_split_marks, moss_cleaned, tpl_rendered, tpl_thoughts, tpl_tools, tpl_shared_lengths)
_ROWS = (rows_instruction, rows_trained_whole, rows_last_answer, rows_prompt_only, rows_before_last, rows_marked, rows_pairwise, rows_text, rows_text_padded, rows_sentences, rows_alpaca_text, rows_messages_text, rows_forum, rows_prompted, rows_marked_turns, rows_role_ids, rows_prefixes, rows_code, rows_unknown_handler, rows_pretrain_cut, rows_pretrain_blocks)
QUERIES = {f.__name__: f for f in _CORE + _ROWS}

_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_STRIP = lambda x: f"regexp_replace({x}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"
_TURN = lambda role, content: f"{{'role': {role}, 'content': {content}}}"
_SAID = "list_concat(_prompt, _response)"
_IN_TURN = lambda m: f"len(list_filter({m}, lambda x, i: CASE WHEN i % 2 = 1 THEN x.role IN ('user', 'observation') ELSE x.role IN ('assistant', 'function') END)) = len({m})"
_LAST = "_response[1].content"
_ALL = lambda parts, sep="": f"array_to_string({parts}, '{sep}')"
# dialogues of valid pairs, an empty exchange for others: s system, t contents
_D = "WITH d AS (SELECT example_id, len(_prompt) % 2 = 1 AND len(_response) = 1 AS ok, COALESCE(_system, '') AS s, CASE WHEN len(_prompt) % 2 = 1 AND len(_response) = 1 THEN list_transform(list_concat(_prompt, _response), lambda x: COALESCE(x.content, '')) ELSE ['', ''] END AS t FROM sft_examples)"
_HEADS = "'[256]' || CASE WHEN s <> '' THEN '[262]' || hex(s) ELSE '' END"
_DOTS = "repeat('.', 1 + CASE WHEN s <> '' THEN 1 + strlen(s) ELSE 0 END)"
_IDS = f"{_HEADS} || " + _ALL("list_transform(t, lambda x, i: CASE WHEN i % 2 = 1 THEN '[260]' || hex(x) || '[261]' ELSE hex(x) || '[257]' END)")
_LABELS = f"{_DOTS} || " + _ALL("list_transform(t, lambda x, i: CASE WHEN i % 2 = 1 THEN repeat('.', strlen(x) + 2) ELSE hex(x) || '[257]' END)")
_N = "1 + CASE WHEN s <> '' THEN 1 + strlen(s) ELSE 0 END + CAST(list_sum(list_transform(t, lambda x, i: strlen(x) + CASE WHEN i % 2 = 1 THEN 2 ELSE 1 END)) AS BIGINT)"
_PREAMBLE = "Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request. Please note that you need to think through your response logically and step by step."
_PROMPT = lambda turns: f"chr(10) || '{_PREAMBLE}' || chr(10) || {turns}"
_Q, _A = "'### Instruction:' || chr(10) || {} || chr(10)", "'### Response:' || chr(10) || {} || chr(10)"
_MOSS = "WITH d AS (SELECT example_id, list_transform(list_concat(_prompt, _response), lambda x: " + _STRIP("COALESCE(x.content, '')") + ") AS t FROM sft_examples WHERE len(_prompt) % 2 = 1 AND len(_response) = 1)"


def _slot(pieces: list, value: str) -> str:
    """A slot as SQL text; the first mark of the content is replaced by ``value``, that of the round by its number."""
    names = {"bos": "<s>", "eos": "</s>"}
    parts = []
    for p in pieces:
        p = names.get(p[0], p[0]) if isinstance(p, tuple) else p
        q = "'" + p.replace("'", "''") + "'"
        if "{{idx}}" in p:
            q = f"replace({q}, '{{{{idx}}}}', CAST((i - 1) // 2 AS VARCHAR))"
        if "{{content}}" in p:
            a, b = p.split("{{content}}", 1)
            left = "'" + a.replace("'", "''") + "'"
            left = f"replace({left}, '{{{{idx}}}}', CAST((i - 1) // 2 AS VARCHAR))" if "{{idx}}" in a else left
            right = "'" + b.replace("'", "''") + "'"
            q = f"{left} || {value} || {right}"
        parts.append(q)
    return "(" + (" || ".join(parts) if parts else "''") + ")"


def _rendering(name: str) -> str:
    spec = TEMPLATES[name]
    answer = spec.get("assistant", ["{{content}}", *([] if spec.get("efficient_eos") else [("eos",)])])
    kind, default = spec.get("kind", "plain"), spec.get("default_system", "").replace("'", "''")
    system = f"(CASE WHEN s <> '' THEN s ELSE '{default}' END)"
    head = f"CASE WHEN {system} <> '' THEN {_slot(spec.get('system', ['{{content}}']), system)} ELSE '' END"
    asked = f"({head} || x)" if kind == "folded" else "x"
    first = _slot(spec.get("prefix", []), "''") + ("" if kind == "folded" else f" || {head}")
    later = "''" if kind == "bare" else _slot(spec.get("separator", []), "''")
    user, user1 = _slot(spec["user"], "x"), _slot(spec["user"], asked)
    body = f"CASE WHEN i = 1 THEN {first} || {user1} WHEN i % 2 = 1 THEN {later} || {user} ELSE {_slot(answer, 'x')} END"
    return f"SELECT example_id, '{name}' AS template, md5({_ALL(f'list_transform(t, lambda x, i: {body})')}) AS text FROM d WHERE ok"


_JSON_TOOL = """'{"name": "' || s || '", "description": "d", "parameters": {"type": "object", "properties": {"n": {"type": "integer", "description": "how many"}, "kind": {"type": "string", "description": "é", "enum": ["a", "b"]}}, "required": ["n"]}}'"""
_TAGS = "'# Tools' || chr(10) || chr(10) || 'You may call one or more functions to assist with the user query.' || chr(10) || chr(10) || 'You are provided with function signatures within <tools></tools> XML tags:' || chr(10) || '<tools>' || chr(10) || '{\"type\": \"function\", \"function\": ' || " + _JSON_TOOL + " || '}' || chr(10) || '</tools>' || chr(10) || chr(10) || 'For each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:' || chr(10) || '<tool_call>' || chr(10) || '{\"name\": <function-name>, \"arguments\": <args-json-object>}' || chr(10) || '</tool_call>'"
_CALL = "'{\"n\": ' || l || '}'"

SQL = {
    "conv_history": f"""WITH e AS (SELECT *, _prompt[-1].content AS q, {_LAST} AS a, list_transform(range(1, 2 * ((len(_prompt) - 1) // 2) + 1), lambda i: {_TURN("CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END", "_prompt[i].content")}) AS h FROM sft_examples)
        SELECT example_id, dataset_name, {sql_told("list_concat(h, [" + _TURN("'user'", "array_to_string(list_filter([q, _system], lambda x: COALESCE(x, '') <> ''), chr(10))") + "])")} AS prompt, {sql_told("[" + _TURN("'assistant'", "a") + "]")} AS response, '' AS system, COALESCE(_tools, '') AS tools FROM e WHERE a IS NOT NULL""",
    "conv_ranked": f"""SELECT example_id, dataset_name, {sql_told("_prompt")} AS prompt, {sql_told("[" + _TURN("'assistant'", _LAST) + ", " + _TURN("'assistant'", f"reverse({_LAST})") + "]")} AS response, COALESCE(_system, '') AS system, '' AS tools FROM sft_examples
        WHERE len(_prompt) % 2 = 1 AND {_IN_TURN("_prompt")} AND _response[1].role IN ('assistant', 'function') AND len(list_filter(_prompt, lambda x: x.content IS NULL)) = 0""",
    "conv_approved": f"""WITH e AS (SELECT *, {_SAID} AS m FROM sft_examples)
        SELECT example_id, dataset_name, {sql_told("m[1:len(m) - 1]")} AS prompt, CASE example_id % 3 WHEN 0 THEN {sql_told("[m[-1], " + _TURN("'assistant'", "''") + "]")} WHEN 1 THEN {sql_told("[" + _TURN("'assistant'", "''") + ", m[-1]]")} ELSE {sql_told("[m[-1]]")} END AS response, '' AS system, '' AS tools
        FROM e WHERE len(m) > 0 AND len(m) % 2 = 0 AND {_IN_TURN("m")}""",
    "conv_approved_pairs": f"""SELECT example_id, {sql_told("[" + _TURN("'user'", "COALESCE(_prompt[1].content, '')") + "]")} AS prompt, CASE WHEN {_LAST} IS NULL THEN CASE WHEN example_id % 3 < 2 THEN {sql_told("[" + _TURN("'assistant'", "''") + "]")} END ELSE
        CASE example_id % 3 WHEN 0 THEN {sql_told("[" + _TURN("'assistant'", _LAST) + ", " + _TURN("'assistant'", "''") + "]")} WHEN 1 THEN {sql_told("[" + _TURN("'assistant'", "''") + ", " + _TURN("'assistant'", _LAST) + "]")} ELSE {sql_told("[" + _TURN("'assistant'", _LAST) + "]")} END END AS response, '' AS system, '' AS tools
        FROM sft_examples WHERE {_LAST} IS NOT NULL OR example_id % 3 < 2""",
    "conv_periodic": f"""WITH e AS (SELECT *, {_SAID} AS m, COALESCE(_system, 's') AS s FROM sft_examples), g AS (SELECT *, flatten(list_transform(m, lambda x, i: CASE WHEN i % 2 = 1 THEN [{_TURN("'system'", "s")}, {_TURN("x.role", "x.content")}] ELSE [{_TURN("x.role", "x.content")}] END)) AS k FROM e WHERE len(m) > 0 AND len(m) % 2 = 0 AND {_IN_TURN("m")} AND len(list_filter(m, lambda x: x.content IS NULL)) = 0)
        SELECT example_id, dataset_name, {sql_told("k[1:len(k) - 1]")} AS prompt, {sql_told("[k[-1]]")} AS response, '' AS system, '' AS tools FROM g""",
    "conv_chat": f"""WITH e AS (SELECT *, {_SAID} AS m, COALESCE(_system, '') AS s, example_id % 5 = 0 AS tooled FROM sft_examples),
        g AS (SELECT *, list_transform(m, lambda x, i: CASE WHEN x.role = 'user' AND i > 1 THEN {_TURN("'observation'", "COALESCE(x.content, '') || chr(10) || '</tool_response>' || chr(10) || '<tool_response>' || chr(10) || 'seen'")} WHEN x.role <> 'user' AND i = 2 AND example_id % 2 = 0 THEN {_TURN("'function'", "'[{\"name\": \"look_up\", \"arguments\": \"{\\\"id\\\": ' || example_id || '}\"}]'")} ELSE {_TURN("x.role", "x.content")} END) AS k FROM e)
        SELECT example_id, dataset_name, {sql_told("k[1:len(k) - 1]")} AS prompt, {sql_told("[k[-1]]")} AS response,
        CASE WHEN s = '' AND NOT tooled THEN 'detailed thinking off' WHEN s = '' THEN '' WHEN tooled THEN s || chr(10) WHEN contains(s, 'detailed thinking on') OR contains(s, 'detailed thinking off') THEN s ELSE s || chr(10) || 'detailed thinking off' END AS system,
        CASE WHEN tooled THEN '[]' ELSE '' END AS tools FROM g WHERE len(k) > 0 AND len(k) % 2 = 0 AND {_IN_TURN("k")}""",
    "conv_since_user": f"""WITH e AS (SELECT example_id, {_SAID} AS m FROM sft_examples) SELECT example_id, {sql_told("m[GREATEST(COALESCE(list_max(list_filter(range(1, len(m) + 1), lambda i: m[i].role = 'user')), 1), 1):]")} AS turns FROM e""",
    "conv_dialogue": f"""SELECT example_id, CASE WHEN len(_prompt) % 2 = 1 AND len(_response) = 1 THEN {sql_told(f"list_transform({_SAID}, lambda x: " + _TURN("x.role", "COALESCE(x.content, '')") + ")")} ELSE md5('user:|assistant:') END AS turns FROM sft_examples""",
    "conv_split_marks": f"""SELECT example_id, {sql_told("list_transform(_prompt, lambda x, i: " + _TURN("CASE WHEN i % 2 = 1 AND i < len(_prompt) THEN 'user' ELSE 'assistant' END", _STRIP("COALESCE(x.content, '')")) + ")")} AS turns FROM sft_examples""",
    "rows_instruction": f"{_D} SELECT example_id, md5({_IDS}) AS input_ids, md5(repeat('01', {_N})) AS attention_mask, md5({_LABELS}) AS labels FROM d",
    "rows_trained_whole": f"{_D} SELECT example_id, md5({_IDS} || '[259]') AS input_ids, md5({_IDS} || '[259]') AS labels FROM d",
    "rows_last_answer": f"{_D} SELECT example_id, md5({_IDS}) AS input_ids, md5({_DOTS} || {_ALL('''list_transform(t, lambda x, i: CASE WHEN i < len(t) THEN repeat('.', strlen(x) + CASE WHEN i % 2 = 1 THEN 2 ELSE 1 END) ELSE hex(x) || '[257]' END)''')}) AS labels FROM d WHERE ok",
    "rows_prompt_only": f"{_D} SELECT example_id, md5({_HEADS} || {_ALL('''list_transform(list_filter(t, lambda x, i: i % 2 = 1), lambda x: '[260]' || hex(x) || '[261]')''')}) AS input_ids FROM d",
    "rows_before_last": f"""{_D} SELECT d.example_id, md5({_HEADS} || {_ALL('''list_transform(t[1:len(t) - 1], lambda x, i: CASE WHEN i % 2 = 1 THEN '[260]' || hex(x) || '[261]' ELSE hex(x) || '[257]' END)''')}) AS input_ids, md5(COALESCE(hex(e._response[-1].content), '')) AS labels FROM d JOIN sft_examples e USING (example_id)""",
    "rows_marked": f"""WITH d AS (SELECT example_id, COALESCE(_system, '') AS s, list_transform({_SAID}, lambda x: {_TURN("x.role", "COALESCE(x.content, '')")}) AS t FROM sft_examples WHERE len({_SAID}) > 0),
        k AS (SELECT *, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'user') AS u, list_filter(range(1, len(t) + 1), lambda i: t[i].role <> 'user') AS a FROM d),
        z AS (SELECT *, list_filter(range(1, len(u) + 1), lambda k: k <= len(a)) AS ks FROM k)
        SELECT example_id, md5({_HEADS} || {_ALL('''list_transform(t, lambda x: CASE WHEN x.role = 'user' THEN '[260]' || hex(x.content) || '[261]' ELSE hex(x.content) || '[257]' END)''')}) AS input_ids,
        md5({_DOTS} || {_ALL('''list_transform(t, lambda x, i: CASE WHEN x.role = 'user' THEN CASE WHEN len(list_filter(ks, lambda k: u[k] < i AND i < a[k])) > 0 THEN '[260]' || hex(x.content) ELSE repeat('.', strlen(x.content) + 1) END || CASE WHEN len(list_filter(ks, lambda k: u[k] <= i AND i < a[k])) > 0 THEN '[261]' ELSE '.' END
            WHEN len(list_filter(ks, lambda k: u[k] < i AND i <= a[k])) > 0 THEN hex(x.content) || '[257]' ELSE repeat('.', strlen(x.content) + 1) END)''')}) AS labels FROM z""",
    "rows_pairwise": f"""{_D}, p AS (SELECT example_id, {_HEADS} || {_ALL('''list_transform(t[1:len(t) - 1], lambda x, i: CASE WHEN i % 2 = 1 THEN '[260]' || hex(x) || '[261]' ELSE hex(x) || '[257]' END)''')} AS b, repeat('.', CAST({_N} - strlen(t[-1]) - 1 AS BIGINT)) AS l, hex(t[-1]) || '[257]' AS c, hex(reverse(t[-1])) || '[257]' AS r FROM d WHERE ok)
        SELECT example_id, md5(b || c) AS chosen_input_ids, md5(l || c) AS chosen_labels, md5(b || r) AS rejected_input_ids, md5(l || r) AS rejected_labels FROM p""",
    "rows_text": "SELECT doc_id AS example_id, md5(hex(text) || '[259]') AS input_ids FROM documents WHERE strlen(text) > 0",
    "rows_text_padded": "SELECT doc_id AS example_id, md5(hex(text) || repeat('[263]', 7 - strlen(text) % 8) || '[259]') AS input_ids FROM documents WHERE strlen(text) > 0",
    "rows_sentences": "WITH p AS (SELECT doc_id, list_filter(string_split(text, '. '), lambda x: x <> '') AS p FROM documents WHERE text IS NOT NULL) SELECT doc_id AS example_id, CAST(i - 1 AS INT) AS seq, md5(hex(p[i])) AS input_ids FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM p)",
    "rows_alpaca_text": f"""SELECT example_id, md5(hex('A chat between a curious user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user''s questions.' || 'USER: Below is an instruction that describes a task. Write a response that appropriately completes the request.' || chr(10) || chr(10) || '### Instruction:' || chr(10) || COALESCE(_prompt[1].content, 'None') || chr(10) || chr(10) || '###' || CASE WHEN COALESCE(_system, '') <> '' THEN ' Input:' || chr(10) || _system ELSE 'None' END || chr(10) || chr(10) || '### Response: ASSISTANT: ' || COALESCE({_LAST}, 'None'))) AS input_ids FROM sft_examples""",
    "rows_messages_text": f"SELECT example_id, md5(hex(x)) AS input_ids FROM (SELECT example_id, array_to_string(list_transform({_SAID}, lambda x: x.content), '') AS x FROM sft_examples) WHERE x <> ''",
    "rows_forum": "SELECT doc_id AS example_id, md5(hex('In python, ' || COALESCE(doi, 'None') || chr(10) || '### Question:' || chr(10) || COALESCE(source, 'None') || chr(10) || '### Response:' || chr(10) || COALESCE(text, 'None') || chr(10))) AS input_ids FROM documents",
    "rows_prompted": f"""WITH d AS (SELECT example_id, {_PROMPT(_Q.format("COALESCE(_prompt[1].content, '') || chr(10) || COALESCE(_system, '')"))} || '### Response:' || chr(10) AS q, COALESCE({_LAST}, '') || chr(10) AS a FROM sft_examples)
        SELECT example_id, md5(hex(q || a)) AS input_ids, md5(repeat('.', strlen(q)) || hex(a)) AS labels FROM d""",
    "rows_marked_turns": f"""WITH d AS (SELECT example_id, list_transform(_prompt, lambda x: {_STRIP("COALESCE(x.content, '')")}) AS t, {_STRIP(f"COALESCE({_LAST}, '')")} AS a FROM sft_examples WHERE len(_prompt) % 2 = 1)
        SELECT example_id, md5(hex({_PROMPT(_ALL("list_transform(t, lambda x, i: CASE WHEN i % 2 = 1 THEN " + _Q.format("x") + " ELSE " + _A.format("x") + " END)"))} || {_A.format("a")})) AS input_ids FROM d""",
    "rows_role_ids": f"""{_MOSS} SELECT example_id, md5({_ALL('''list_transform(t, lambda x, i: CASE WHEN i % 2 = 1 THEN 'C3' || hex(x) ELSE 'C4' || hex(x) END)''')} || '[257]') AS input_ids,
        md5({_ALL('''list_transform(t, lambda x, i: CASE WHEN i % 2 = 1 THEN '[257]' || repeat('.', strlen(x) + 1) ELSE hex(x) END)''')} || '[257]') AS labels FROM d""",
    "rows_prefixes": f"""{_MOSS}, p AS (SELECT example_id, t, unnest(range(1, len(t) // 2 + 1)) AS k FROM d)
        SELECT example_id, CAST(k - 1 AS INT) AS seq, md5(hex({_PROMPT(_ALL("list_transform(t[1:2 * k], lambda x, i: CASE WHEN i % 2 = 1 THEN " + _Q.format("x") + " ELSE " + _A.format("x") + " END)"))})) AS input_ids FROM p""",
    "rows_code": f"""WITH d AS (SELECT example_id, COALESCE({_LAST}, '') AS x, COALESCE(_system, '') AS s FROM sft_examples), c AS (SELECT *, CASE WHEN regexp_matches(x, '(?s)```\\w*\\n(.*?)```') THEN regexp_extract(x, '(?s)```\\w*\\n(.*?)```', 1) ELSE x END AS code FROM d)
        SELECT example_id, md5(hex({_PROMPT(_Q.format(_STRIP("string_split(x, '```')[1]")))} || {_A.format("code || chr(10) || s")})) AS input_ids FROM c""",
    "rows_unknown_handler": "SELECT doc_id AS example_id, md5(hex(text)) AS input_ids FROM documents WHERE strlen(text) > 0",
    "rows_pretrain_cut": "SELECT doc_id AS example_id, md5('[256]' || CASE WHEN strlen(COALESCE(text, '')) <= 254 THEN hex(COALESCE(text, '')) || '[257]' ELSE substr(hex(text), 1, 510) END) AS input_ids FROM documents",
    "rows_pretrain_blocks": """WITH d AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch, regexp_replace(hex(COALESCE(text, '')), '(..)', '00\\1', 'g') || '0101' AS x FROM documents),
        b AS (SELECT batch, string_agg(x, '' ORDER BY doc_id) AS x FROM d GROUP BY batch), k AS (SELECT batch, x, unnest(range(0, length(x) // 2048)) AS block FROM b)
        SELECT CAST(batch AS BIGINT) AS batch, CAST(block AS INT) AS block, md5('0100' || substr(x, block * 2048 + 5, 2044)) AS input_ids FROM k""",
    "moss_cleaned": f"WITH d AS (SELECT example_id, {_STRIP(f'''COALESCE({_LAST}, '')''')} AS x FROM sft_examples) SELECT example_id, x AS user, x AS assistant FROM d",
    "tpl_rendered": _D + " " + " UNION ALL ".join(_rendering(n) for n in sorted(TEMPLATES)),
    "tpl_thoughts": f"""{_D}, e AS (SELECT example_id, s, t, '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) AS th, '<think>' || chr(10) AS b, chr(10) || '</think>' || chr(10) || chr(10) AS z,
        list_transform(t, lambda x: regexp_replace(regexp_replace(x, '(?s)<think>\\n(.*?)\\n</think>\\n\\n', '', 'g'), '^\\n+', '')) AS r FROM d WHERE ok)
        SELECT example_id, md5({_ALL('''list_transform(range(1, len(t), 2), lambda i: CASE WHEN i = 1 AND s <> '' THEN 'S' || s ELSE '' END || 'U' || t[i] || 'A>' || CASE WHEN contains(t[i + 1], b) OR contains(t[i + 1], z) THEN '' ELSE th END || t[i + 1] || chr(10))''', "|")}) AS "on",
        md5({_ALL('''list_transform(range(1, len(t), 2), lambda i: CASE WHEN i = 1 AND s <> '' THEN 'S' || s ELSE '' END || 'U' || t[i] || 'A' || CASE WHEN contains(r[i + 1], b) OR contains(r[i + 1], z) THEN '' ELSE th END || '>' || r[i + 1] || chr(10))''', "|")}) AS "off" FROM e""",
    "tpl_tools": f"""WITH j AS (SELECT job_id, COALESCE(status, 'none') AS s, CAST(COALESCE(suffix_layers, 0) AS VARCHAR) AS l FROM jobs)
        SELECT job_id, 'You have access to the following tools:' || chr(10) || '> Tool Name: ' || s || chr(10) || 'Tool Description: d' || chr(10) || 'Tool Args:' || chr(10) || '  - n (integer, required): how many' || chr(10) || '  - kind (string): é, should be one of [a, b]' || chr(10) || chr(10) || 'Use the following format if using a tool:' || chr(10) || '```' || chr(10) || 'Action: tool name (one of [' || s || ']).' || chr(10) || 'Action Input: the input to the tool, in a JSON format representing the kwargs (e.g. ```{{"input": "hello world", "num_beams": 5}}```).' || chr(10) || '```' || chr(10) AS plain,
        chr(10) || chr(10) || {_TAGS} AS tagged, '<tool_call>' || chr(10) || '{{"name": "' || s || '", "arguments": ' || {_CALL} || '}}' || chr(10) || '</tool_call>' AS written,
        '(''' || s || ''', ''' || {_CALL} || ''')' || '(''' || s || ''', ''' || {_CALL} || ''')' AS "read" FROM j""",
    "tpl_shared_lengths": """WITH s AS (SELECT sample_id, CAST(len(COALESCE(input_ids, [])) AS INT) AS n, CAST(len(list_filter(COALESCE(labels, []), lambda x: x <> -100)) AS INT) AS t FROM sft_tokens),
        m AS (SELECT sample_id, t, CASE WHEN GREATEST(n - t, 0) + t > 0 THEN GREATEST(CAST(trunc(1024 * (CAST(t AS DOUBLE) / (GREATEST(n - t, 0) + t))) AS INT), 1) ELSE 1 END AS most FROM s)
        SELECT sample_id, CAST(1024 - LEAST(most, t) AS INT) AS source, CAST(most AS INT) AS target FROM m""",
}
