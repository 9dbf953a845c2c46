"""Queries that write tables to the shared folder in some format and read them back through the library's sources and sinks.

The files lie in a folder of their own below the checkpoint folder, which all machines see, and are removed when the driver ends.
"""

from __future__ import annotations

import atexit
import gzip
import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import records, text
from corpusloom.operators import conversations, handlers, markup_template, preprocessing, templates
from corpusloom.plans.digests import digest, listed, sql_listed
from corpusloom.session import shared_folder, table, wide_table
from corpusloom.sources import files, gunzip, indexed, sinks
from corpusloom.streaming import streams


def _scratch(spark: SparkSession) -> str:
    """A new folder that all machines see, as a plain path."""
    path = os.path.join(shared_folder(spark), f"scratch-{uuid.uuid4().hex}")
    os.makedirs(path, exist_ok=True)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", "text")


def _parts(folder: str, ext: str) -> list[str]:
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.startswith("part-") and n.endswith(ext))


def src_majority(spark: SparkSession, root: str) -> DataFrame:
    """SRC-01, SRC-02, SRC-07, SRC-30, AGG-21, SRT-02, SRT-04: of a folder the files of the most frequent kind are read."""
    at = _scratch(spark)
    _documents(spark, root).repartition(3).write.option("ignoreNullFields", "false").json(f"{at}/json")
    _documents(spark, root).limit(1).coalesce(1).write.parquet(f"{at}/parquet")
    os.makedirs(f"{at}/all")
    for ext in ("json", "parquet"):
        for p in _parts(f"{at}/{ext}", ext):
            shutil.copy(p, f"{at}/all/{os.path.basename(p)}")
    if not files.is_raw(f"{at}/all"):
        raise ValueError("a folder of data files isn't taken for one")
    return files.read_path(spark, f"{at}/all").select("doc_id", "text")


def src_formats(spark: SparkSession, root: str) -> DataFrame:
    """SRC-07, SRC-10: Parquet, Arrow, text and whatever options name."""
    at, docs = _scratch(spark), _documents(spark, root)
    docs.write.parquet(f"{at}/parquet")
    os.makedirs(f"{at}/arrow")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = list(batches)
        if got:
            with pa.OSFile(f"{at}/arrow/part-{TaskContext.get().partitionId():05d}.arrow", "wb") as f, pa.ipc.new_file(f, got[0].schema) as w:
                for b in got:
                    w.write_batch(b)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(got)], pa.int64())})

    docs.mapInArrow(run, "n bigint").count()
    docs.select(F.concat_ws(" ", "doc_id", F.md5(F.coalesce("text", F.lit("")))).alias("value")).write.text(f"{at}/txt")
    kinds = {"parquet": files.read_path(spark, f"{at}/parquet"), "arrow": files.read_path(spark, f"{at}/arrow"), "options": files.read_with_options(spark, json.dumps({"format": "parquet", "path": f"{at}/parquet", "mergeSchema": False}))}
    out = files.read_path(spark, f"{at}/txt").select(F.lit("text").alias("kind"), F.split("value", " ")[0].cast("bigint").alias("doc_id"), F.split("value", " ")[1].alias("text"))
    for kind, df in kinds.items():
        out = out.unionByName(df.select(F.lit(kind).alias("kind"), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text")))
    return out


def src_registry(spark: SparkSession, root: str) -> DataFrame:
    """SRC-03 to SRC-06, LIM-01, FIL-09: entries of a registry, the first rows of one in the order of files and rows."""
    at = _scratch(spark)
    _documents(spark, root).repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{at}/docs")
    os.makedirs(f"{at}/data")
    for p in _parts(f"{at}/docs", "parquet"):
        shutil.copy(p, f"{at}/data/{os.path.basename(p)}")
    with open(f"{at}/info.json", "w") as f:
        json.dump({"few": {"file_name": "data", "max_samples": 50, "hf_hub_url": "ignored"}, "ranked": {"cloud_file_name": f"{at}/data", "ranking": True}}, f)
    few, ranked = files.entries("few, ranked", files.registry(f"{at}/info.json"), at)
    files.check_stage(few, "sft")
    files.check_stage(ranked, "rm")
    return files.read_entry(spark, few).select(F.lit("few").alias("entry"), "doc_id").unionByName(files.read_entry(spark, ranked).select(F.lit("ranked").alias("entry"), "doc_id"))


def _text_files(spark: SparkSession, root: str, at: str, name: str, content) -> None:
    """One file for each document, written in tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i, t in zip(frame["doc_id"], frame["text"], strict=True):
                path = f"{at}/{i % 10}/{name.format(i=i, gz=('.gz', '.gz.gz', '.GZ')[i % 3])}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "wb") as f:
                    f.write(content(int(i), (t or "").encode()))
            yield frame[["doc_id"]]

    _documents(spark, root).mapInPandas(run, "doc_id bigint").count()


def src_sniffed(spark: SparkSession, root: str) -> DataFrame:
    """SRC-11, SRC-12: plain and gzip files told apart by their first bytes, whatever they are called."""
    at = _scratch(spark)
    _text_files(spark, root, at, "{i}.txt{gz}", lambda i, b: gzip.compress(b) if i % 2 else b)
    return files.read_sniffed_lines(spark, at).select(F.regexp_extract("path", r"/(\d+)\.txt", 1).cast("bigint").alias("doc_id"), "line_no", F.md5("line").alias("line"))


def src_line_counts(spark: SparkSession, root: str) -> DataFrame:
    """SRC-13, SRC-18: lines of every file and of all, and files that can't be read."""
    at = _scratch(spark)
    _text_files(spark, root, at, "{i}.txt", lambda i, b: gzip.compress(b)[:-5] if i % 7 == 0 else b)
    if len(files.find_files(at, (".txt",))) == 0:
        raise ValueError("no files")
    counted = files.count_lines(spark, at)
    return counted.select(F.when(F.col("path") == "TOTAL", -1).otherwise(F.regexp_extract("path", r"/(\d+)\.txt", 1).cast("bigint")).alias("doc_id"), "lines", "error")


def src_gunzip(spark: SparkSession, root: str) -> DataFrame:
    """SRC-14 to SRC-17, AGG-06: layers taken off as names say, as far as they are there; files that exist are skipped."""
    at = _scratch(spark)
    _text_files(spark, root, f"{at}/in", "{i}.txt{gz}", lambda i, b: gzip.compress(gzip.compress(b)) if i % 3 == 1 else b if i % 3 == 2 else gzip.compress(b))
    jobs = gunzip.discover(f"{at}/in", f"{at}/out")
    gunzip.decompress(spark, jobs).write.parquet(f"{at}/done")
    done = spark.read.parquet(f"{at}/done")
    again = gunzip.decompress(spark, jobs)
    number = F.regexp_extract("source", r"/(\d+)\.txt", 1).cast("bigint").alias("doc_id")
    return done.select(number, F.lit(1).alias("round"), "status", "size_bytes").unionByName(again.select(number, F.lit(2).alias("round"), "status", "size_bytes"))


def src_exams(spark: SparkSession, root: str) -> DataFrame:
    """SRC-20: questions of files of comma-separated values without a header."""
    at = _scratch(spark)
    items = table(spark, root, "eval_items").select("question", "a", "b", "c", "d", "answer")
    items.write.option("escape", '"').option("quote", '"').csv(f"{at}/exam")
    return files.read_choices(spark, _parts(f"{at}/exam", "csv")).select("question", "A", "B", "C", "D", "answer")


def src_json_lines(spark: SparkSession, root: str) -> DataFrame:
    """SRC-21, SRC-23, FIL-12: JSON lines, gzip by suffix, of the files with dev in their names."""
    at = _scratch(spark)
    table(spark, root, "eval_items").select("item_id", "question", "answer").coalesce(2).write.option("compression", "gzip").json(f"{at}/raw")
    os.makedirs(f"{at}/data")
    for k, p in enumerate(_parts(f"{at}/raw", "gz")):
        shutil.copy(p, f"{at}/data/dev-{k}.jsonl.gz")
    with open(f"{at}/data/train.jsonl", "w") as f:
        f.write('{"item_id": -1}\n\n')
    with open(f"{at}/data/dev-blank.jsonl", "w") as f:
        f.write('\n\n{"item_id": -2, "question": "q"}\n\n')
    return files.read_json_lines(spark, f"{at}/data", "item_id bigint, question string, answer string", "*dev*")


def src_cloud_json(spark: SparkSession, root: str) -> DataFrame:
    """SRC-08: JSON lines through Hadoop's file systems, here the shared folder's."""
    at = _scratch(spark)
    table(spark, root, "eval_items").select("item_id", "question").repartition(2).write.option("ignoreNullFields", "false").json(f"{at}/bucket")
    return files.read_cloud_json(spark, f"file://{at}/bucket").select("item_id", "question")


def src_examples(spark: SparkSession, root: str) -> DataFrame:
    """SRC-22: examples nested in JSON files."""
    at = _scratch(spark)
    e = table(spark, root, "eval_items").groupBy(F.coalesce("task", F.lit("none")).alias("task")).agg(F.collect_list(F.struct(F.coalesce("question", F.lit("")).alias("input"), F.coalesce("answer", F.lit("")).alias("target"))).alias("examples"))
    e.repartition("task").write.partitionBy("task").json(f"{at}/bbh")
    return files.read_examples(spark, files.find_files(f"{at}/bbh", (".json",))).groupBy("input", "target").agg(F.count("*").alias("n"))


def src_store(spark: SparkSession, root: str) -> DataFrame:
    """SRC-24 to SRC-26, SNK-03 to SNK-05, SNK-08, SNK-09, SET-03: two token stores written, merged and read."""
    at = _scratch(spark)
    d = table(spark, root, "sft_tokens").select("sample_id", F.floor(F.col("sample_id") / 3).alias("doc"), F.coalesce("input_ids", F.array().cast("array<int>")).alias("tokens"))
    for k in (0, 1):
        indexed.write_store(d.where(F.col("doc") % 2 == k), f"{at}/s{k}_text_document", ["sample_id"], "doc", "tokens")
    indexed.merge_stores(at, f"{at}/all", ["text_document"], spark)
    return indexed.read_store(spark, f"{at}/all_text_document", 1 << 18).select("seq_id", "doc_id", listed(F.col("tokens")).alias("tokens"))


def src_packed_store(spark: SparkSession, root: str) -> DataFrame:
    """SRC-27: equally long stores of several fields, as one table."""
    at = _scratch(spark)
    d = table(spark, root, "sft_tokens").select("sample_id", F.coalesce("input_ids", F.array().cast("array<int>")).alias("input_ids"), F.coalesce("labels", F.array().cast("array<int>")).alias("labels"))
    for f in ("input_ids", "labels"):
        indexed.write_store(d, f"{at}/x_packed_{f}_document", ["sample_id"], "sample_id", f)
    return indexed.packed_store(spark, f"{at}/x").select("seq_id", listed(F.col("input_ids")).alias("input_ids"), listed(F.col("labels")).alias("labels"))


def src_cached(spark: SparkSession, root: str) -> DataFrame:
    """SRC-28, SNK-11, SNK-12: what was made under a description is read the second time."""
    at = _scratch(spark)
    docs = _documents(spark, root)
    sinks.kept(spark, at, {"what": "documents"}, lambda: docs)
    again = sinks.kept(spark, at, {"what": "documents"}, lambda: docs.limit(0))
    sinks.write_table(again, f"{at}/saved")
    return files.cached(spark, f"{at}/saved")


def src_mock(spark: SparkSession, root: str) -> DataFrame:
    """SRC-29: documents of seeded lengths, as many as there are."""
    made = files.mock_documents(spark, table(spark, root, "documents").count(), 7, 100, end=5)
    return made.select("doc_id", listed(F.col("tokens")).alias("tokens"))


def src_logs(spark: SparkSession, root: str) -> DataFrame:
    """SRC-31: steps, times, losses and memory of training logs."""
    e = table(spark, root, "events").select("event_id", F.round(F.abs("value"), 2).cast("decimal(12,2)").alias("v"))
    line = F.concat(F.lit(" iteration "), F.col("event_id"), F.lit("/ 99999 | elapsed time per iteration (ms): "), F.col("v"), F.lit(" | lm loss: 1.5E+00 | grad norm: "), F.col("v"), F.lit(" |"))
    memory = F.concat(F.lit("memory (MB) | allocated: "), F.col("v"))
    steps = files.log_metrics(e.select(line.alias("value"))).select("step", "ms", "loss", "norm", F.lit(None).cast("double").alias("mb"))
    return steps.unionByName(files.log_memory(e.select(memory.alias("value"))).select(F.lit(None).cast("bigint").alias("step"), F.lit(None).cast("double").alias("ms"), F.lit(None).cast("double").alias("loss"), F.lit(None).cast("double").alias("norm"), "mb"))


def snk_texts(spark: SparkSession, root: str) -> DataFrame:
    """SNK-01, SNK-02: shards of texts of a bounded number of rows, numbered."""
    at = _scratch(spark)
    sinks.write_texts(_documents(spark, root).repartitionByRange(3, "doc_id"), f"{at}/texts", rows=100_000)
    names = sinks.number_shards(spark, f"{at}/texts")
    read = spark.read.parquet(*[f"{at}/texts/{n}" for n in names])
    return read.groupBy(F.md5("text").alias("text")).agg(F.count("*").alias("n"), F.lit(names[0].rsplit("-of-", 1)[0]).alias("first"))


def snk_tables(spark: SparkSession, root: str) -> DataFrame:
    """SNK-10, SNK-13: a table that is overwritten and JSON lines that are appended to."""
    at, d = _scratch(spark), table(spark, root, "doi_counts").select("row_id", "shard")
    sinks.write_table(d.limit(1), f"{at}/table")
    sinks.write_table(d, f"{at}/table", overwrite=True)
    for _ in range(2):
        sinks.write_json_lines(d, f"{at}/lines", compressed=True, append=True)
    return spark.read.parquet(f"{at}/table").select(F.lit("table").alias("kind"), "row_id", "shard").unionByName(spark.read.schema("row_id bigint, shard string").json(f"{at}/lines").select(F.lit("lines").alias("kind"), "row_id", "shard"))


def snk_keys(spark: SparkSession, root: str) -> DataFrame:
    """SNK-06, FIL-06, PRJ-01: a table for each key, without the samples that are too long for any."""
    at = _scratch(spark)
    d = table(spark, root, "sft_tokens").select("sample_id", "input_ids", "labels", "attention_mask")
    sinks.write_keys(d, f"{at}/out", ["input_ids", "labels"], 1024, "sample_id")
    read = lambda k: spark.read.parquet(sinks.prefix_of(f"{at}/out", k)).select("sample_id", listed(F.col(k)).alias(k))
    return read("input_ids").join(read("labels"), "sample_id")


def snk_preprocessed(spark: SparkSession, root: str) -> DataFrame:
    """SNK-07, SNK-09, SNK-14, HDL-20: raw records aligned, tokenized and written, found again under their prefix."""
    at = _scratch(spark)
    e = table(spark, root, "sft_examples").where("size(_prompt) > 0").select(F.get("_prompt", F.lit(0))["content"].alias("instruction"), F.lit("").alias("input"), F.get("_response", F.lit(0))["content"].alias("output"))
    e.write.json(f"{at}/raw")
    config = preprocessing.Config("", "", handler="instruction", keys=("input_ids", "labels"), length=4096, options=handlers.Options(cutoff=1_000_000_000))
    (names,) = preprocessing.converted(spark, [f"{at}/raw"], config).values()
    (again,) = preprocessing.converted(spark, [f"{at}/raw"], config).values()
    if names != again:
        raise ValueError("a second run wrote other tables")
    read = lambda n, k: spark.read.parquet(n).select("row", "seq", digest(F.col(k)).alias(k))
    return read(names[0], "input_ids").join(read(names[1], "labels"), ["row", "seq"]).groupBy("input_ids", "labels").agg(F.count("*").alias("n"))


def stm_files(spark: SparkSession, root: str) -> DataFrame:
    """STM-01, STM-02, STM-03: arriving files through a batch operator, and appended as they are."""
    at = _scratch(spark)
    d = table(spark, root, "events").select("event_id", "value")
    d.repartition(3).write.parquet(f"{at}/in")
    streams.check_saving(False, f"{at}/saved")
    stream = streams.arriving(spark, f"{at}/in", d.schema, 1)
    streams.each_batch(stream, lambda b: b.withColumn("twice", F.col("value") * 2), f"{at}/out", f"{at}/c1").awaitTermination()
    streams.to_parquet(streams.arriving(spark, f"{at}/in", d.schema), f"{at}/plain", f"{at}/c2").awaitTermination()
    out = spark.read.parquet(f"{at}/out").select("event_id", F.round("twice", 6).alias("twice"))
    return out.join(spark.read.parquet(f"{at}/plain").select("event_id", F.round("value", 6).alias("value")), "event_id")


def stm_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Runs of events of a user without a pause of six hours."""
    s = streams.sessions(table(spark, root, "events"), "ts", "user_id", "6 hours", "1 day")
    return s.select("user_id", F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "n")


# records and templates


def record_fields(spark: SparkSession, root: str) -> DataFrame:
    """PRJ-04, FIL-01, FIL-02, JSN-04: class, identifier and body of every line."""
    c = records.classified(wide_table(spark, root, "job_lines").select("line_id", "line"))
    return c.select("line_id", "kind", text.normalize_doi(F.col("raw_doi")).alias("doi"), "has_body")


def record_texts(spark: SparkSession, root: str) -> DataFrame:
    """PRJ-05, FIL-03, STR-02: outcome and text of every line."""
    from corpusloom.operators import corpus

    return corpus.paper_texts(wide_table(spark, root, "job_lines")).select("line_id", "outcome", F.md5("text").alias("text"))


def tpl_markup(spark: SparkSession, root: str) -> DataFrame:
    """TPL-08, JOI-13: dialogues in the markup of its own, with results brought into the order of their calls."""
    rows = wide_table(spark, root, "sft_examples").where("size(_prompt) = 1 AND size(_response) = 1").select("example_id", F.get("_prompt", F.lit(0))["content"].alias("q"), F.get("_response", F.lit(0))["content"].alias("a"), F.col("_system").alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = lambda i: {"id": i, "function": {"name": f"f{i}", "arguments": '{"x": 1, "y": "z"}'}}
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                q, a = r["q"] or "", r["a"] or ""
                said = [{"role": "user", "content": q}, {"role": "assistant", "content": "", "tool_calls": [call("1"), call("2")]}, {"role": "tool", "tool_call_id": "2", "content": "two"}, {"role": "tool", "tool_call_id": "1", "content": "one"}, {"role": "assistant", "content": a}]
                out.append((r["example_id"], "".join(markup_template.rendered(markup_template.turns_of(said, r["s"], None), thinking=False))))
            cols = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string())], names=["example_id", "text"])

    return rows.mapInArrow(run, "example_id bigint, text string").select("example_id", F.md5("text").alias("text"))


def tpl_inferred(spark: SparkSession, root: str) -> DataFrame:
    """TPL-10, TPL-15: slots found by probing a chat format, and ends of answers."""

    def render(messages: list[tuple[str, str]], opened: bool) -> str:
        said = messages if messages[0][0] == "system" else [("system", "Be brief."), *messages]
        body = "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in said)
        return body + ("<|im_start|>assistant\n" if opened else "")

    t = templates.inferred(render)
    tok = handlers.Options().tokenizer
    ends = [(n, templates.end_fixed(templates.template(n), tok)[1], len(templates.end_fixed(templates.template(n), tok)[0].stop_words)) for n in ("baichuan2", "llama3", "qwen3")]
    return spark.createDataFrame([("inferred", t.user[0], t.assistant[0], t.system[0], t.default_system, 0, 0), *[(n, "", "", "", "", e, k) for n, e, k in ends]], "name string, user string, assistant string, system string, default_system string, end int, stops int")


def conv_registered(spark: SparkSession, root: str) -> DataFrame:
    """CNV-05, CNV-09, UDF-04: a layout of one's own, registered by name."""
    if "asked_said" not in conversations.CONVERTERS:
        conversations.register_converter("asked_said", lambda df, m=None: df.select(F.array(conversations.turn("user", F.col("asked"))).alias("prompt"), F.array(conversations.turn("assistant", F.col("said"))).alias("response"), F.lit("").alias("system"), F.lit("").alias("tools"), "item_id"))
    rows = table(spark, root, "eval_items").select("item_id", F.col("question").alias("asked"), F.col("answer").alias("said"))
    return conversations.aligned(rows, "asked_said").select("item_id", F.get("prompt", F.lit(0))["content"].alias("asked"), F.get("response", F.lit(0))["content"].alias("said"))


QUERIES = {f.__name__: f for f in (src_majority, src_formats, src_registry, src_sniffed, src_line_counts, src_gunzip, src_exams, src_json_lines, src_cloud_json, src_examples, src_store, src_packed_store, src_cached, src_mock, src_logs, snk_texts, snk_tables, snk_keys, snk_preprocessed, stm_files, stm_sessions, record_fields, record_texts, tpl_markup, tpl_inferred, conv_registered)}

_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_STRIP = lambda x: f"regexp_replace({x}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"
_DOI = lambda x: f"NULLIF({_STRIP(f'''regexp_replace(lower({_STRIP(x)}), '^(https://doi[.]org/|http://doi[.]org/|https://dx[.]doi[.]org/|http://dx[.]doi[.]org/|doi:)', '')''')}, '')"
_LINES = "CASE WHEN text = '' OR text IS NULL THEN [] WHEN ends_with(text, chr(10)) THEN string_split(text, chr(10))[1:len(string_split(text, chr(10))) - 1] ELSE string_split(text, chr(10)) END"
_KIND = rf"CASE WHEN line IS NULL OR regexp_full_match(line, '{_SPACES}*') THEN 'empty' WHEN NOT json_valid(line) THEN 'malformed' WHEN json_type(line) = 'OBJECT' THEN 'object' ELSE 'other' END"
_J = f"WITH j AS (SELECT line_id, line, {_KIND} AS kind FROM job_lines), o AS (SELECT *, CASE WHEN kind = 'object' THEN line ELSE '{{}}' END AS o FROM j)"
_STR = lambda path: f"CASE WHEN json_type(o, '{path}') = 'VARCHAR' THEN json_extract_string(o, '{path}') END"
_SOLID = lambda path: f"COALESCE(CASE json_type(o, '{path}') WHEN 'NULL' THEN FALSE WHEN 'VARCHAR' THEN NOT regexp_full_match(json_extract_string(o, '{path}'), '{_SPACES}*') ELSE json_type(o, '{path}') IS NOT NULL END, FALSE)"
_NORMAL = lambda x: "NULLIF(" + _STRIP(f"replace(replace(replace(replace(nfc_normalize({x}), chr(0), ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10) || '..' || chr(10) || '..' || chr(10) || '..', '')") + ", '')"
_IM = "<|im_start|>{}' || chr(10) || '{}<|im_end|>' || chr(10) || '"
_CALLS = lambda m: f"chr(10) || chr(10) || '<{m}tool_calls>' || chr(10) || " + " || chr(10) || ".join(f"'<{m}invoke name=\"f{i}\">' || chr(10) || '<{m}parameter name=\"x\" string=\"false\">1</{m}parameter>' || chr(10) || '<{m}parameter name=\"y\" string=\"true\">z</{m}parameter>' || chr(10) || '</{m}invoke>'" for i in (1, 2)) + f" || chr(10) || '</{m}tool_calls>'"
_MT = markup_template

SQL = {
    "src_majority": "SELECT doc_id, text FROM documents",
    "src_formats": "SELECT k AS kind, doc_id, md5(COALESCE(text, '')) AS text FROM documents, (SELECT unnest(['arrow', 'options', 'parquet', 'text']) AS k)",
    "src_registry": "(SELECT 'few' AS entry, doc_id FROM documents ORDER BY doc_id LIMIT 50) UNION ALL SELECT 'ranked', doc_id FROM documents",
    "src_sniffed": f"WITH l AS (SELECT doc_id, {_LINES} AS l FROM documents) SELECT doc_id, i - 1 AS line_no, md5(regexp_replace(l[i], '\\r+$', '')) AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM l)",
    "src_line_counts": f"WITH l AS (SELECT doc_id, len({_LINES}) AS n, doc_id % 7 = 0 AS bad FROM documents) SELECT doc_id, CASE WHEN bad THEN 0 ELSE n END AS lines, CASE WHEN bad THEN 'EOFError' END AS error FROM l UNION ALL SELECT -1, CAST(SUM(n) FILTER (NOT bad) AS BIGINT), NULL FROM l",
    "src_gunzip": "SELECT doc_id, 1 AS round, CASE WHEN doc_id % 3 = 2 THEN 'failed' ELSE 'written' END AS status, CASE WHEN doc_id % 3 <> 2 THEN CAST(strlen(COALESCE(text, '')) AS BIGINT) END AS size_bytes FROM documents UNION ALL SELECT doc_id, 2, CASE WHEN doc_id % 3 = 2 THEN 'failed' ELSE 'skipped' END, NULL FROM documents",
    "src_exams": "SELECT question, a AS A, b AS B, c AS C, d AS D, answer FROM eval_items",
    "src_json_lines": "SELECT item_id, question, answer FROM eval_items UNION ALL SELECT -2, 'q', NULL",
    "src_cloud_json": "SELECT item_id, question FROM eval_items",
    "src_examples": "SELECT COALESCE(question, '') AS input, COALESCE(answer, '') AS target, COUNT(*) AS n FROM eval_items GROUP BY 1, 2",
    "src_store": f"WITH t AS (SELECT sample_id, sample_id // 3 AS d, COALESCE(input_ids, []) AS x FROM sft_tokens) SELECT row_number() OVER (ORDER BY d % 2, sample_id) - 1 AS seq_id, dense_rank() OVER (ORDER BY d % 2, d) - 1 AS doc_id, {sql_listed('x')} AS tokens FROM t",
    "src_packed_store": f"SELECT row_number() OVER (ORDER BY sample_id) - 1 AS seq_id, {sql_listed('COALESCE(input_ids, [])')} AS input_ids, {sql_listed('COALESCE(labels, [])')} AS labels FROM sft_tokens",
    "src_cached": "SELECT doc_id, text FROM documents",
    "src_mock": f"WITH n AS (SELECT i AS doc_id, CAST(('0x' || substr(md5(concat_ws('-', '7', i)), 1, 12)) AS BIGINT) % 99 + 1 AS n FROM (SELECT unnest(range(0, (SELECT COUNT(*) FROM documents))) AS i)) SELECT doc_id, {sql_listed('list_concat(range(1, n), [5])')} AS tokens FROM n",
    "src_logs": "WITH e AS (SELECT event_id, CAST(CAST(round(abs(value), 2) AS DECIMAL(12, 2)) AS DOUBLE) AS v FROM events) SELECT event_id AS step, v AS ms, CAST(1.5 AS DOUBLE) AS loss, v AS norm, CAST(NULL AS DOUBLE) AS mb FROM e UNION ALL SELECT NULL, NULL, NULL, NULL, v FROM e",
    "snk_texts": "SELECT md5(text) AS text, COUNT(*) AS n, 'train-00000' AS first FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "snk_tables": "SELECT 'table' AS kind, row_id, shard FROM doi_counts UNION ALL SELECT 'lines', row_id, shard FROM doi_counts, (SELECT unnest([1, 2]))",
    "snk_keys": f"SELECT sample_id, {sql_listed('input_ids')} AS input_ids, {sql_listed('labels')} AS labels FROM sft_tokens WHERE GREATEST(len(input_ids), COALESCE(len(labels), 0)) < 1024",
    "snk_preprocessed": """WITH d AS (SELECT COALESCE(_prompt[1].content, '') AS q, _response[1].content AS a FROM sft_examples WHERE len(_prompt) > 0 AND _response[1].content IS NOT NULL)
        SELECT md5('[256][260]' || hex(q) || '[261]' || hex(a) || '[257]') AS input_ids, md5(repeat('.', strlen(q) + 3) || hex(a) || '[257]') AS labels, COUNT(*) AS n FROM d WHERE strlen(q) + strlen(a) + 4 < 4096 GROUP BY 1, 2""",
    "stm_files": "SELECT event_id, round(value * 2, 6) AS twice, round(value, 6) AS value FROM events",
    "stm_sessions": """WITH e AS (SELECT user_id, ts, CASE WHEN ts >= LAG(ts) OVER w + INTERVAL 6 HOUR OR LAG(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM e)
        SELECT user_id, CAST(floor(epoch(MIN(ts))) AS BIGINT) AS start, CAST(floor(epoch(MAX(ts) + INTERVAL 6 HOUR)) AS BIGINT) AS "end", COUNT(*) AS n FROM s GROUP BY user_id, s""",
    "record_fields": f"""{_J} SELECT line_id, kind, {_DOI(f"COALESCE(NULLIF({_STR('$.doi')}, ''), NULLIF({_STR('$.externalids.doi')}, ''), NULLIF({_STR('$.externalids.DOI')}, ''))")} AS doi,
        {_SOLID('$.fullText')} OR {_SOLID('$.fulltext')} OR {_SOLID('$.full_text')} OR {_SOLID('$.content.text')} AS has_body FROM o""",
    "record_texts": f"""{_J}, t AS (SELECT *, concat_ws(chr(10) || chr(10), {_NORMAL(_STR('$.abstract'))}, {_NORMAL(_STR('$.fullText'))}) AS t, json_type(o, '$.fullText') IS NOT NULL AS has FROM o), r AS (SELECT line_id, t, CASE WHEN kind IN ('empty', 'malformed') THEN kind WHEN kind = 'other' OR NOT has THEN 'missing' WHEN length(t) < 200 THEN 'short' ELSE 'kept' END AS outcome FROM t)
        SELECT line_id, outcome, CASE WHEN outcome = 'kept' THEN md5(t) END AS text FROM r""",
    "tpl_markup": f"""WITH d AS (SELECT example_id, COALESCE(_system, '') AS s, COALESCE(_prompt[1].content, '') AS q, regexp_replace(COALESCE(_response[1].content, ''), '(?s)^\\s*<think>\\s*(.*?)\\s*</think>\\s*', '') AS a FROM sft_examples WHERE len(_prompt) = 1 AND len(_response) = 1)
        SELECT example_id, md5(s || '{_MT.USER}' || q || '{_MT.ASSISTANT}{_MT.THOUGHT}' || {_CALLS(_MT.MARKUP)} || '{_MT.END}{_MT.USER}<tool_result>one</tool_result>' || chr(10) || chr(10) || '<tool_result>two</tool_result>{_MT.ASSISTANT}{_MT.THOUGHT}' || a || '{_MT.END}') AS text FROM d""",
    "tpl_inferred": f"""SELECT 'inferred' AS name, '{_IM.format('user', '{{content}}')}<|im_start|>assistant' || chr(10) AS user, '{{{{content}}}}<|im_end|>' || chr(10) AS assistant, '{_IM.format('system', '{{content}}')}' AS system, 'Be brief.' AS default_system, 0 AS "end", 0 AS stops
        UNION ALL SELECT 'baichuan2', '', '', '', '', 257, 0 UNION ALL SELECT 'llama3', '', '', '', '', 257, 0 UNION ALL SELECT 'qwen3', '', '', '', '', 257, 0""",
    "conv_registered": "SELECT item_id, question AS asked, answer AS said FROM eval_items",
}
