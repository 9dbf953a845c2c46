import gzip
import json
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import corpus
from corpusloom.sources import files, gunzip, indexed, sinks
from corpusloom.streaming import streams


def test_majority_format():
    assert files.majority_format(["a.txt", "b.json", "c.json"]) == ("json", "json")
    assert files.majority_format(["a.txt", "b.json"]) == ("txt", "text")
    assert files.majority_format(["a.md", "b.md", "c.csv"]) == ("csv", "csv")
    assert files.majority_format(["x"]) == (None, None)


def test_reading(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{"x": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"x": 3}\n')
    (tmp_path / "c.txt").write_text("no\n")
    assert sorted(r["x"] for r in files.read_path(spark, str(tmp_path)).collect()) == [1, 2, 3]
    assert files.is_raw(str(tmp_path))
    assert len(files.find_files(str(tmp_path), (".json", ".jsonl"))) == 2
    with pytest.raises(FileNotFoundError):
        files.find_files(str(tmp_path), (".csv",))
    assert {r["path"].split("/")[-1]: r["lines"] for r in files.count_lines(spark, str(tmp_path)).collect()} == {"a.jsonl": 2, "b.jsonl": 1, "c.txt": 1, "TOTAL": 4}
    with pa.OSFile(str(tmp_path / "t.arrow"), "wb") as f, pa.ipc.new_file(f, pa.schema([("v", pa.int64())])) as w:
        w.write_table(pa.table({"v": [1, 2, 3]}))
    assert files.read_path(spark, str(tmp_path / "t.arrow")).agg(F.sum("v")).first()[0] == 6


def test_magic_decides(spark, tmp_path):
    (tmp_path / "plain.gz").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "packed").write_bytes(gzip.compress(b"three\n\xff\n"))
    got = sorted((r["path"].split("/")[-1], r["line_no"], r["line"]) for r in files.read_sniffed_lines(spark, str(tmp_path)).collect())
    assert got == [("packed", 0, "three"), ("packed", 1, "\ufffd"), ("plain.gz", 0, "one"), ("plain.gz", 1, "two")]
    assert files.sniffed_text(gzip.compress("é".encode())) == "é"


def test_registry(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"x": 1}\n')
    info = {"a": {"file_name": "d.json", "script_url": "s"}, "b": {"hf_hub_url": "h"}, "c": {}}
    e = files.entries("a, b", info, str(tmp_path))
    assert [x.kind for x in e] == ["file_name", "hf_hub_url"]
    assert files.read_entry(spark, e[0]).count() == 1
    with pytest.raises(KeyError):
        files.entries("z", info)
    with pytest.raises(ValueError, match="nowhere"):
        files.entries("c", info)
    with pytest.raises(NotImplementedError):
        files.read_entry(spark, e[1])
    assert files.read_with_options(spark, json.dumps({"format": "json", "path": str(tmp_path / "d.json")})).count() == 1


def test_exams_and_logs(spark, tmp_path):
    (tmp_path / "e.csv").write_text('"What ""is"" it?\nreally",a,b,c,d,A\nq2,a,b,c,d,B\n')
    got = files.read_choices(spark, [str(tmp_path / "e.csv")]).collect()
    assert [r["answer"] for r in got] == ["A", "B"]
    (tmp_path / "b.json").write_text(json.dumps({"examples": [{"input": "i", "target": "t"}]}))
    assert files.read_examples(spark, [str(tmp_path / "b.json")]).first()["target"] == "t"
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(Exception, match="no examples"):
        files.read_examples(spark, [str(tmp_path / "bad.json")]).collect()
    d = spark.createDataFrame([(" iteration  10/ 200 | elapsed time per iteration (ms): 12.5 | lm loss: 1.5E+00 | grad norm: 0.7 |",), ("memory (MB) | allocated: 99.5",), ("else",)], "value string")
    assert [tuple(r) for r in files.log_metrics(d).collect()] == [(10, 12.5, 1.5, 0.7)]
    assert [r["mb"] for r in files.log_memory(d).collect()] == [99.5]
    assert files.mock_documents(spark, 5, 1, 10).where(F.element_at("tokens", -1) != 0).count() == 0


def test_gunzip(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    (src / "sub").mkdir(parents=True)
    (src / "a.jsonl.gz").write_bytes(gzip.compress(b"1\n"))
    (src / "b.gz.GZ").write_bytes(gzip.compress(gzip.compress(b"22\n")))
    (src / "sub" / "c.gz.gz").write_bytes(gzip.compress(b"333\n"))
    (src / "d.gz").write_bytes(b"plain")
    (src / "e.txt").write_bytes(b"no job")
    jobs = gunzip.discover(str(src), str(out))
    assert [j.suffix_layers for j in jobs] == [1, 2, 1, 2]
    done = {r["source"].split("/")[-1]: r for r in gunzip.decompress(spark, jobs).collect()}
    assert {k: r["status"] for k, r in done.items()} == {"a.jsonl.gz": "written", "b.gz.GZ": "written", "c.gz.gz": "written", "d.gz": "failed"}
    assert (out / "b").read_bytes() == b"22\n"
    assert (out / "sub" / "c").read_bytes() == b"333\n"
    again = gunzip.decompress(spark, jobs)
    assert {r["status"]: r["n"] for r in gunzip.status_counts(again).collect()} == {"skipped": 3, "failed": 1}
    with pytest.raises(ValueError, match="one destination"):
        gunzip.decompress(spark, [gunzip.Job("x.gz", "d", 1), gunzip.Job("y.gz", "d", 1)])


def test_token_store(spark, tmp_path):
    prefix = str(tmp_path / "s")
    d = spark.createDataFrame([(i // 3, i, list(range(i % 5 + 1))) for i in range(50)], "doc int, seq int, tokens array<int>")
    assert indexed.write_store(d.repartition(4), prefix, ["doc", "seq"], "doc", "tokens") == (50, 17, 4 * 150)
    index = indexed.Index.read(f"{prefix}.idx")
    assert (len(index.lengths), index.ends.tolist()) == (50, [*range(0, 50, 3), 50])
    # one document of any size spreads over tasks and stays one
    one = spark.createDataFrame([(7, i, [i]) for i in range(90)], "doc int, seq int, tokens array<int>")
    assert indexed.write_store(one, str(tmp_path / "one"), ["seq"], "doc", "tokens")[:2] == (90, 1)
    assert [r["tokens"] for r in indexed.read_store(spark, str(tmp_path / "one"), 8).orderBy("seq_id").collect()] == [[i] for i in range(90)]
    assert indexed.merge_stores(str(tmp_path), str(tmp_path / "all"), ["one"], spark) == {"one": (90, 1, 360)}
    assert indexed.get(prefix, 4, 1, 2, mapped=True).tolist() == [1, 2]
    got = indexed.read_store(spark, prefix, tokens_per_task=20).orderBy("seq_id").collect()
    assert [(r["doc_id"], r["seq_id"], r["tokens"]) for r in got] == [(i // 3, i, list(range(i % 5 + 1))) for i in range(50)]
    assert indexed.get(prefix, 4, 1, 2).tolist() == [1, 2]
    b = indexed.Builder(str(tmp_path / "merged"))
    b.add_store(prefix)
    b.add_store(prefix)
    merged = b.finish()
    assert merged.ends[-1] == 100
    assert indexed.best_type(100) == np.uint16
    assert indexed.best_type(70_000) == np.int32
    (tmp_path / "bad.idx").write_bytes(b"x" * 40)
    with pytest.raises(ValueError, match="no index"):
        indexed.Index.read(str(tmp_path / "bad.idx"))
    for f in ("input_ids", "labels"):
        indexed.write_store(d, f"{prefix}_packed_{f}_document", ["doc", "seq"], "doc", "tokens")
    assert indexed.packed_store(spark, prefix).where("input_ids <> labels").count() == 0
    (tmp_path / "half_text_document.idx").write_bytes(b"")
    with pytest.raises(FileNotFoundError):
        indexed.merge_stores(str(tmp_path), str(tmp_path / "m"), ["half_text"])


def test_packed_store_reads_its_stores_without_a_join(spark, tmp_path):
    prefix = str(tmp_path / "s")
    rows = [(i, [i] * (i % 4), [-i] * (i % 7)) for i in range(60)]
    d = spark.createDataFrame(rows, "seq int, input_ids array<int>, labels array<int>")
    for f in ("input_ids", "labels"):
        indexed.write_store(d, f"{prefix}_packed_{f}_document", ["seq"], "seq", f)
    got = indexed.packed_store(spark, prefix)
    assert sorted((r["seq_id"], r["input_ids"], r["labels"]) for r in got.collect()) == rows
    # the listing of ranges is small whatever the tokens are, so a join of two readings broadcasts one of them through the driver
    assert re.findall("Join|BroadcastExchange", got._jdf.queryExecution().executedPlan().toString()) == []
    cut = indexed.packed_store(spark, prefix, tokens_per_task=20)
    assert sorted((r["seq_id"], r["input_ids"], r["labels"]) for r in cut.collect()) == rows
    assert cut.rdd.getNumPartitions() > 5  # ranges of equal tokens, cut at the same sequences in both stores
    indexed.write_store(d.limit(3), f"{prefix}_packed_labels_document", ["seq"], "seq", "labels")
    with pytest.raises(ValueError, match="equally long"):
        indexed.packed_store(spark, prefix)


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("a",), (None,), ("b",)], "text string").coalesce(1)
    sinks.write_texts(d, str(tmp_path / "t"), rows=1)
    assert sinks.number_shards(spark, str(tmp_path / "t")) == ["train-00000-of-00002.parquet", "train-00001-of-00002.parquet"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    with pytest.raises(Exception, match="exists"):
        sinks.write_texts(d, str(tmp_path / "t"))
    made = []

    def make():
        made.append(1)
        return d

    for _ in range(2):
        assert sinks.kept(spark, str(tmp_path / "k"), {"a": 1}, make).count() == 3
    assert made == [1]
    sinks.write_json_lines(d, str(tmp_path / "j"), compressed=True)
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_streams(spark, tmp_path):
    events = spark.createDataFrame([("a", f"2024-01-01 00:{m:02d}:00", 1.0) for m in (1, 2, 40)], "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    events.write.parquet(str(tmp_path / "in"))
    stream = streams.arriving(spark, str(tmp_path / "in"), events.schema)
    assert {r["n"] for r in streams.window_totals(events, "t", "k", "v", "30 minutes", "1 hour").collect()} == {1, 2}
    assert [r["n"] for r in streams.sessions(events, "t", "k", "10 minutes", "1 hour").orderBy("start").collect()] == [2, 1]
    q = streams.each_batch(stream, lambda d: corpus.key_counts(d, "k"), str(tmp_path / "out"), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first()["n"] == 3
    q = streams.to_parquet(stream, str(tmp_path / "copy"), str(tmp_path / "c2"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 3
    with pytest.raises(ValueError, match="saved"):
        streams.check_saving(True, "x")


def test_corpus_edges(spark):
    lines = spark.createDataFrame([(1, None, "clash"), (2, " ", ""), (3, "[1]", ""), (4, "{x", ""), (5, json.dumps({"fullText": "a" * 200}), ""), (6, json.dumps({"fullText": None, "abstract": "b" * 200}), ""), (7, json.dumps({"abstract": "b" * 300}), ""), (8, json.dumps({"fullText": "a" * 199}), ""), (9, '{"fullText": "\\ud800 é"}', "")], "line_id int, line string, kind string")
    got = {r["line_id"]: r["outcome"] for r in corpus.paper_texts(lines).collect()}
    assert got == {1: "empty", 2: "empty", 3: "missing", 4: "malformed", 5: "kept", 6: "kept", 7: "missing", 8: "short", 9: "short"}
    s = corpus.line_statistics(lines).first()
    assert (s["lines"], s["empty"], s["malformed"], s["not_object"], s["valid"]) == (9, 2, 1, 1, 5)
    none = lines.limit(0)
    assert corpus.line_statistics(none).first()["lines"] == 0
    a = spark.createDataFrame([("x",), ("x",), (None,)], "doi string")
    c = corpus.comparison(corpus.merged_counts(a, a.limit(0))).first()
    assert (c["unique_a"], c["only_a"], c["matched"], c["repeats_a"]) == (1, 1, 0, 1)
