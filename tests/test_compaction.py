import io
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusloom.operators import columnar_copy as cc
from corpusloom.operators import compaction


def encoded(table, **kw):
    out = io.BytesIO()
    pq.write_table(table, out, **kw)
    return out.getvalue()


def tables(n=20):
    return [pa.table({"a": [f"x{i}{j}" for j in range(5 + i)], "b": pa.array(range(5 + i), pa.int32()), "c": [None] * (4 + i) + [[1, 2]]}) for i in range(n)]


@pytest.mark.parametrize(
    ("options", "one"),
    [({"use_dictionary": False, "compression": "zstd"}, True), ({"use_dictionary": True}, False), ({"use_dictionary": False, "data_page_version": "2.0", "row_group_size": 3}, True), ({"use_dictionary": False, "compression": "none"}, True)],
)
def test_joined_files_read_as_their_parts(tmp_path, options, one):
    parts = tables()
    joined = cc.join_files([encoded(t, **options) for t in parts])
    assert pq.read_table(io.BytesIO(joined)).equals(pa.concat_tables(parts))
    assert (pq.ParquetFile(io.BytesIO(joined)).num_row_groups == 1) == one
    (tmp_path / "j.parquet").write_bytes(joined)
    assert duckdb.sql(f"SELECT COUNT(*), SUM(b) FROM '{tmp_path}/j.parquet'").fetchall() == [(sum(t.num_rows for t in parts), sum(sum(t["b"].to_pylist()) for t in parts))]


def test_files_without_rows_join_to_one_without_rows():
    empty = encoded(tables(1)[0].slice(0, 0))
    assert pq.read_table(io.BytesIO(cc.join_files([empty, empty]))).num_rows == 0


def test_different_schemas_and_other_files_are_errors():
    with pytest.raises(ValueError, match="schemas"):
        cc.join_files([encoded(pa.table({"a": [1]})), encoded(pa.table({"a": ["x"]}))])
    with pytest.raises(ValueError, match="Parquet"):
        cc.join_files([b"no such thing at all"])


def test_lost_rows_are_found():
    f, blocks = cc.blocks_of(encoded(tables(1)[0], use_dictionary=False))
    good = cc.join_blocks(f, blocks)
    blocks[0].rows += 1
    with pytest.raises(ValueError, match="row totals"):
        cc.check_join(good, f, blocks, 1)


def test_best_fit_keeps_within_the_capacity_and_near_the_bound():
    sizes = np.random.default_rng(1).integers(1, 400, 3000)
    to = compaction.best_fit_decreasing(sizes, 1000)
    fill = np.bincount(to, sizes)
    assert fill.max() <= 1000
    assert len(fill) <= np.ceil(sizes.sum() / 1000) + 1
    assert compaction.best_fit_decreasing(np.array([5000, 10]), 1000).tolist() == [0, 1]


def frames(spark, lines, jobs):
    return (
        spark.createDataFrame(jobs, "job_id bigint, source string, destination string, status string, n_rows int"),
        spark.createDataFrame(lines, "line_id bigint, source string, line_no int, line string, content string"),
    )


def test_every_line_comes_out_once_with_its_origin(spark):
    r = random.Random(3)
    lines, k = [], 0
    for s in [*(f"/in/a/{i}" for i in range(60)), "/in/hot", None]:
        for n in range(900 if s == "/in/hot" else r.randint(1, 9)):
            for _ in range(r.choice([1, 1, 2])):
                k += 1
                lines.append((k, s, n, r.choice(["", "é" * r.randint(0, 90), "x" * r.randint(0, 300), None]) if not lines or lines[-1][1:3] != (s, n) else lines[-1][3], "clash"))
    lines.append((k + 1, "/in/big", 0, "y" * 5000, ""))
    r.shuffle(lines)
    jobs = [(i, s, f"/corpus/out/{'ab'[i % 2]}/{i}", "written", 1) for i, s in enumerate(sorted({x[1] for x in lines if x[1]}))]
    j, d = frames(spark, lines, jobs)
    files = compaction.compacted_files(j, d, limit=2048, group_bytes=20_000)
    found = files.collect()
    assert all(f["n_bytes"] <= 2048 or f["n_blocks"] == 1 for f in found)
    first = {}
    for i, s, n, line, _ in sorted(lines):
        first.setdefault((s, n), line)
    got = compaction.read_files(files).collect()
    assert len(got) == len(first)
    assert {(x["source"], x["line_no"]): x["line"] for x in got} == first
    corpus = {x[1]: x[2].split("/")[3] for x in jobs}
    assert all(x["corpus"] == corpus.get(x["source"], "") for x in got)
    sizes = {}
    for (s, _), line in first.items():
        sizes[s] = sizes.get(s, 0) + len((line or "").encode()) + 1
    assert {x["source"]: x["n_bytes"] for x in compaction.source_sizes(compaction.encode_blocks(d, 2048)).collect()} == sizes


def test_small_sources_need_an_attempt_that_did_not_fail(spark):
    j, d = frames(spark, [(1, "a", 0, "x" * 100, ""), (2, "b", 0, "x" * 9000, "")], [(1, "a", "/corpus/out/c/a", "failed", 0), (2, "a", "/corpus/out/c/a", "written", 0), (3, "b", None, "written", 0), (4, "none", "d", "skipped", 0), (5, "bad", "d", "failed", 0), (6, None, None, "written", 0), (7, "odd", "d", None, 0)])
    assert sorted(r["source"] for r in compaction.small_sources(j, d).collect()) == ["a", "none", "odd"]


def test_empty_tables_give_nothing(spark):
    j, d = frames(spark, [], [])
    assert compaction.compacted_files(j, d).count() == 0
    assert compaction.small_sources(j, d).count() == 0


def test_directories_are_joined_by_schema(spark, tmp_path):
    for i, t in enumerate(tables(12)):
        pq.write_table(t, tmp_path / f"in{i}.parquet")
    pq.write_table(pa.table({"z": [1.5]}), tmp_path / "other.parquet")
    out = tmp_path / "out"
    done = compaction.compact_directory(spark, str(tmp_path), str(out), limit=40_000).collect()
    assert sum(r["n_files"] for r in done) == 13
    assert sum(r["n_rows"] for r in done) == sum(t.num_rows for t in tables(12)) + 1
    assert len(done) < 13
    whole = [pq.read_table(r["path"]) for r in done if "a" in pq.read_schema(r["path"]).names]
    assert sorted(pa.concat_tables(whole)["a"].to_pylist()) == sorted(x for t in tables(12) for x in t["a"].to_pylist())


def test_files_are_written_below_their_corpus(spark, tmp_path):
    j, d = frames(spark, [(1, "a", 0, "x", ""), (2, "b", 0, "y", "")], [(1, "a", "/corpus/out/c/a", "written", 0)])
    done = compaction.write_files(compaction.compacted_files(j, d), str(tmp_path)).collect()
    assert sorted(pq.read_table(r["path"])["line"].to_pylist()[0] for r in done) == ["x", "y"]


def test_a_small_corpus_beside_a_large_one_is_not_scattered(spark):
    lines = [(i, f"/in/{c}/{i}", 0, "x" * n, "") for i, (c, n) in enumerate([("large", 990)] * 200 + [("small", 40)] * 20)]
    j, d = frames(spark, lines, [(x[0], x[1], f"/corpus/out/{x[1].split('/')[2]}/{x[0]}", "written", 1) for x in lines])
    found = compaction.compacted_files(j, d, limit=2048, group_bytes=20_000).collect()
    assert sum(f["n_rows"] for f in found) == 220
    assert [f["n_rows"] for f in found if f["corpus"] == "small"] == [20]
