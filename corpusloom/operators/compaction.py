"""Millions of small files brought together into few of a bounded size, by copying encoded column blocks.

``encode_blocks`` turns the lines of the small files into encoded Parquet column blocks, one or more for each source, in
one range shuffle by (source, line number): a source of any size spreads over partitions. ``pack_blocks`` spreads the
blocks of each corpus by hash over groups of a bounded number of bytes, fits them best-fit by falling size into files and
joins each file's blocks by copying their bytes and writing a new footer. ``compact_directory`` does the same to a folder
of small Parquet files, which it reads and writes in tasks.
"""

from __future__ import annotations

import bisect
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import columnar_copy as cc
from corpusloom.session import shuffle_width
from corpusloom.sources import remote

#: Largest decompressed size of an output file.
FILE_LIMIT = 256 * 1024
#: Decompressed bytes that one task packs; each such group leaves at most one file part empty.
GROUP_BYTES = 64 << 20
_LINES = pa.schema([("source", pa.string()), ("line_no", pa.int32()), ("line", pa.string())])
_BLOCKS = "source string, first_line int, n_rows int, n_bytes bigint, grp binary, data binary"
_BLOCK_SCHEMA = pa.schema([("source", pa.string()), ("first_line", pa.int32()), ("n_rows", pa.int32()), ("n_bytes", pa.int64()), ("grp", pa.binary()), ("data", pa.binary())])


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """File number of each size: by falling size into the fullest file with room; one above the capacity gets its own."""
    gaps: list[tuple[int, int]] = []
    out, n = np.zeros(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        k = bisect.bisect_left(gaps, (s, -1))
        if k < len(gaps):
            gap, b = gaps.pop(k)
        else:
            gap, b, n = capacity, n, n + 1
        out[i] = b
        if gap > s:
            bisect.insort(gaps, (gap - s, b))
    return out


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal (source, line_no) in one batch the smallest line_id, before anything is shuffled."""
    for b in batches:
        keys = pd.DataFrame({"s": b.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False), "n": b.column(1).to_numpy(zero_copy_only=False), "i": b.column(2).to_numpy(zero_copy_only=False)})
        keep = keys.sort_values("i", kind="stable").drop_duplicates(["s", "n"]).index
        yield b if len(keep) == b.num_rows else b.take(pa.array(np.sort(keep.to_numpy())))


def _starts(new_source: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """First row of each block: at a new source, and within one before the limit would be passed."""
    out, at = [], np.append(np.flatnonzero(new_source), len(sizes))
    total = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        out.append(a)
        while total[b] - total[a] > limit:
            a = max(a + 1, int(np.searchsorted(total, total[a] + limit, side="right")) - 1)
            if a >= b:
                break
            out.append(a)
    return np.array(out, np.int64)


class _Spool:
    """Blocks encoded as row groups of one buffer, handed out with their footer bytes."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.open()

    def open(self) -> None:
        self.buffer = io.BytesIO()
        self.writer = pq.ParquetWriter(self.buffer, _LINES, compression="zstd", use_dictionary=False, write_statistics=False, store_schema=False)

    def add(self, t: pa.Table, n_bytes: int) -> None:
        self.writer.write_table(t, row_group_size=max(1, t.num_rows))
        self.rows.append((t.column(0)[0].as_py(), t.column(1)[0].as_py(), t.num_rows, n_bytes))

    def full(self) -> bool:
        return len(self.rows) >= 512 or self.buffer.tell() > 8 << 20

    def drain(self) -> pa.RecordBatch:
        self.writer.close()
        content = self.buffer.getvalue()
        groups = cc.group_slices(content)
        if len(groups) != len(self.rows) or any(g[cc.GROUP_ROWS][1] != r[2] for (g, _), r in zip(groups, self.rows, strict=True)):
            raise ValueError("blocks and row groups differ")
        data = [b"".join(content[(at := cc.chunk_start(m := c[cc.CHUNK_META][1])) : at + m[cc.META_COMPRESSED][1]] for c in g[cc.GROUP_COLUMNS][1][1]) for g, _ in groups]
        cols = [list(x) for x in zip(*self.rows, strict=True)]
        out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([*cols, [raw for _, raw in groups], data], _BLOCK_SCHEMA, strict=True)], schema=_BLOCK_SCHEMA)
        self.rows = []
        self.open()
        return out


def _encode(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool, pending = _Spool(), _LINES.empty_table()
        last: tuple | None = None
        for b in batches:
            if not b.num_rows:
                continue
            s, n = b.column(0), b.column(1)
            fresh = np.ones(b.num_rows, bool)
            codes, nos = s.dictionary_encode().indices.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
            codes, nos = np.nan_to_num(codes, nan=-1), np.nan_to_num(nos, nan=-1)
            fresh[1:] = (codes[1:] != codes[:-1]) | (nos[1:] != nos[:-1])
            fresh[0] = (s[0].as_py(), n[0].as_py()) != last
            last = (s[-1].as_py(), n[-1].as_py())
            t = pa.Table.from_batches([b]).select([0, 1, 3]).cast(_LINES)
            t = pa.concat_tables([pending, t if fresh.all() else t.filter(pa.array(fresh))]).combine_chunks()
            if not t.num_rows:
                continue
            sizes = pc.fill_null(pc.binary_length(t.column(2)), 0).to_numpy().astype(np.int64) + 1
            codes = np.nan_to_num(pc.index_in(t.column(0), pc.unique(t.column(0))).to_numpy(zero_copy_only=False), nan=-1)
            starts = _starts(np.diff(codes, prepend=np.nan) != 0, sizes, limit)
            for a, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                spool.add(t.slice(a, e - a), int(sizes[a:e].sum()))
                if spool.full():
                    yield spool.drain()
            pending = t.slice(int(starts[-1]))
        if pending.num_rows:
            spool.add(pending, int(pc.sum(pc.fill_null(pc.binary_length(pending.column(2)), 0)).as_py() + pending.num_rows))
        if spool.rows:
            yield spool.drain()

    return run


def encode_blocks(lines: DataFrame, limit: int = FILE_LIMIT) -> DataFrame:
    """(source, first_line, n_rows, n_bytes, grp, data): encoded column blocks of every (source, line_no) once.

    Of repeated lines the one of the smallest ``line_id`` counts. A null ``source`` or ``line_no`` is a value of its own,
    a null ``line`` stays null and counts as empty. ``n_bytes`` is the UTF-8 size of the lines plus one for each. A block
    holds one source and at most ``limit`` bytes, unless a single line is longer. No lines give no blocks.
    """
    rows = lines.select(F.col("source").cast("string"), F.col("line_no").cast("int"), F.col("line_id").cast("bigint"), F.col("line").cast("string"))
    thin = rows.mapInArrow(_thin, "source string, line_no int, line_id bigint, line string")
    spread = thin.repartitionByRange(shuffle_width(lines.sparkSession), "source", "line_no").sortWithinPartitions("source", "line_no", "line_id")
    return spread.mapInArrow(_encode(limit), _BLOCKS)


def source_sizes(blocks: DataFrame) -> DataFrame:
    """(source, n_lines, n_bytes) from the blocks' inventory."""
    return blocks.groupBy("source").agg(F.sum("n_rows").alias("n_lines"), F.sum("n_bytes").alias("n_bytes"))


def job_sources(jobs: DataFrame) -> DataFrame:
    """(source, corpus, readable): one row for each source; ``readable`` if an attempt at it is not failed.

    The corpus is the first folder of the smallest ``destination`` below ``/corpus/out``. A null status counts as not failed.
    """
    corpus = F.regexp_extract(F.min("destination"), "^/corpus/out/([^/]+)/", 1)
    return jobs.groupBy("source").agg(F.coalesce(corpus, F.lit("")).alias("corpus"), F.max(F.coalesce(F.col("status") != "failed", F.lit(True))).alias("readable"))


def small_sources(jobs: DataFrame, lines: DataFrame, below: int = 8192) -> DataFrame:
    """(source): the readable sources whose decompressed size is below ``below``; one without lines has size 0."""
    sizes = source_sizes(encode_blocks(lines))
    return job_sources(jobs).where("readable AND source IS NOT NULL").join(sizes, "source", "left").where(F.coalesce("n_bytes", F.lit(0)) < below).select("source")


def pack_blocks(blocks: DataFrame, corpus_of: DataFrame, groups: DataFrame, limit: int = FILE_LIMIT) -> DataFrame:
    """(corpus, file_id, n_blocks, n_rows, n_bytes, content): the files. ``corpus_of`` gives (source, corpus), ``groups`` (corpus, groups)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["source", "first_line"], ignore_index=True, na_position="first")
        to = best_fit_decreasing(frame["n_bytes"].to_numpy(), limit)
        empty = io.BytesIO()
        pq.write_table(_LINES.empty_table(), empty, compression="zstd", use_dictionary=False, write_statistics=False, store_schema=False)
        head, made = cc.footer(empty.getvalue()), []
        for k, part in frame.groupby(to, sort=True):
            content = cc.join_blocks(head, [cc.carried_block(g, d) for g, d in zip(part["grp"], part["data"], strict=True)])
            made.append((part["corpus"].iloc[0], f"{part['g'].iloc[0]:05d}-{k:06d}", len(part), int(part["n_rows"].sum()), int(part["n_bytes"].sum()), content))
        return pd.DataFrame(made, columns=["corpus", "file_id", "n_blocks", "n_rows", "n_bytes", "content"])

    with_corpus = blocks.join(corpus_of.select(F.col("source").alias("of"), "corpus"), F.col("source") == F.col("of"), "left")
    grouped = with_corpus.withColumn("corpus", F.coalesce("corpus", F.lit(""))).join(F.broadcast(groups), "corpus", "left")
    g = F.pmod(F.xxhash64("source", "first_line"), F.coalesce("groups", F.lit(1))).cast("int")
    spread = grouped.select("corpus", g.alias("g"), "source", "first_line", "n_rows", "n_bytes", "grp", "data")
    return spread.groupBy("corpus", "g").applyInPandas(run, "corpus string, file_id string, n_blocks int, n_rows int, n_bytes bigint, content binary")


def compacted_files(jobs: DataFrame, lines: DataFrame, limit: int = FILE_LIMIT, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The compacted files of all lines, apart for each corpus; see ``pack_blocks``. Lines of no job go to corpus ``''``."""
    corpora = job_sources(jobs)
    sizes = lines.groupBy(F.col("source").cast("string").alias("of")).agg(F.sum(F.coalesce(F.octet_length("line"), F.lit(0)) + 1).alias("n"))
    of_corpus = sizes.join(corpora, F.col("of") == F.col("source"), "left").groupBy(F.coalesce("corpus", F.lit("")).alias("corpus"))
    groups = of_corpus.agg(F.greatest(F.ceil(F.sum("n") / group_bytes), F.lit(1)).alias("groups"))
    return pack_blocks(encode_blocks(lines, limit), corpora, groups, limit)


def read_files(files: DataFrame) -> DataFrame:
    """(corpus, file_id, row_no, source, line_no, line): every row of the files, read from their contents."""
    schema = pa.schema([("corpus", pa.string()), ("file_id", pa.string()), ("row_no", pa.int32()), *_LINES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                t = pq.read_table(pa.BufferReader(b.column(2)[i].as_buffer()))
                n = t.num_rows
                out = pa.Table.from_arrays([pa.repeat(b.column(0)[i], n), pa.repeat(b.column(1)[i], n), pa.array(np.arange(n, dtype=np.int32)), *t.columns], schema=schema)
                yield from out.to_batches()

    return files.select("corpus", "file_id", "content").mapInArrow(run, "corpus string, file_id string, row_no int, source string, line_no int, line string")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes every file below ``folder`` and returns (path, n_rows, n_bytes). A task that is run again replaces its files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            paths = [f"{folder.rstrip('/')}/{c or 'unknown'}/part-{i}.parquet" for c, i in zip(frame["corpus"], frame["file_id"], strict=True)]
            for p, content in zip(paths, frame["content"], strict=True):
                remote.put(p, content)
            yield pd.DataFrame({"path": paths, "n_rows": frame["n_rows"], "n_bytes": frame["n_bytes"]})

    return files.mapInPandas(run, "path string, n_rows int, n_bytes bigint")


#: Bytes at the end of a file in which its footer is looked for first.
FOOTER_GUESS = 64 << 10


def compact_directory(spark: SparkSession, source: str, destination: str, limit: int = 128 << 20, group_files: int = 20_000, group_bytes: int = 4 << 30) -> DataFrame:
    """(path, n_files, n_rows, n_bytes): the Parquet files below ``source`` joined into files of at most ``limit`` bytes.

    Footers are read first, from the files' ends. A task joins files of one schema, at most about ``group_files`` and ``group_bytes``.

    Only files of equal schema come together; a file above the limit is copied alone. The result is lazy: files are
    written when it is read, each under a name of its own that a second run replaces. An empty folder gives no rows.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(source).select("path", F.col("length").alias("n"))

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for frame in batches:
            found = []
            for path in frame["path"]:
                end, size = remote.tail(path, FOOTER_GUESS)
                need = int.from_bytes(end[-8:-4], "little") + 8
                if need > len(end) and need <= size:
                    end, size = remote.tail(path, need)
                f = cc.footer(cc.MAGIC + end)
                raw = bytearray()
                cc.write_struct(raw, {cc.FILE_SCHEMA: f[cc.FILE_SCHEMA]})
                found.append(hashlib.md5(bytes(raw)).hexdigest())
            yield frame.assign(shape=found)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("path", ignore_index=True)
        made = []
        for k, part in frame.groupby(best_fit_decreasing(frame["n"].to_numpy(), limit), sort=True):
            content = cc.join_files([remote.whole(p) for p in part["path"]])
            path = f"{destination.rstrip('/')}/part-{part['shape'].iloc[0][:8]}-{part['g'].iloc[0]:05d}-{k:06d}.parquet"
            remote.put(path, content)
            made.append((path, len(part), cc.footer(content)[cc.FILE_ROWS][1], len(content)))
        return pd.DataFrame(made, columns=["path", "n_files", "n_rows", "n_bytes"])

    n_files, n_bytes = listed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, -(-n_files // group_files), -(-n_bytes // group_bytes))
    shaped = listed.repartition(shuffle_width(spark)).mapInPandas(shapes, "path string, n bigint, shape string")
    return shaped.withColumn("g", F.pmod(F.xxhash64("path"), F.lit(groups)).cast("int")).groupBy("shape", "g").applyInPandas(run, "path string, n_files int, n_rows bigint, n_bytes bigint")
