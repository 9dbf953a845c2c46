"""The binary token store: a file of tokens behind one another and an index of lengths, pointers and document ends.

The index begins with a magic, a version, a code of the token type and two counts; then lengths (int32), byte pointers (int64),
document ends (int64) and, if there are any, modes (int8). Stores are read by tasks in ranges of sequences, of which each maps
its own part of the index, and written by tasks: every part knows its offsets in the tokens and in the index from the sizes of
those before it and copies itself there, so no bytes go through the driver.
"""

from __future__ import annotations

import os
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
#: Code of each token type (fixed values).
TYPES = {1: np.uint8, 2: np.int8, 3: np.int16, 4: np.int32, 5: np.int64, 6: np.float64, 7: np.float32, 8: np.uint16}
SMALL_VOCABULARY = 65_500


def best_type(vocabulary: int | None):
    """The narrowest type that holds all ids of a vocabulary."""
    return np.uint16 if vocabulary is not None and vocabulary < SMALL_VOCABULARY else np.int32


def pointers(lengths: np.ndarray, width: int) -> np.ndarray:
    """Where each sequence begins, in bytes."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1] * np.int64(width), out=out[1:])
    return out


class Index:
    """An index in memory."""

    def __init__(self, dtype, lengths: np.ndarray, ends: np.ndarray, modes: np.ndarray | None = None) -> None:
        self.dtype, self.lengths, self.ends, self.modes = np.dtype(dtype), np.asarray(lengths, np.int32), np.asarray(ends, np.int64), modes
        self.starts = pointers(self.lengths.astype(np.int64), self.dtype.itemsize)

    @classmethod
    def read(cls, path: str) -> Index:
        with open(path, "rb") as f:
            if f.read(9) != MAGIC:
                raise ValueError(f"{path} is no index")
            version, code, sequences, documents = struct.unpack("<QBQQ", f.read(25))
            if version != VERSION:
                raise ValueError(f"version {version}")
            lengths = np.frombuffer(f.read(4 * sequences), "<i4")
            f.seek(8 * sequences, 1)
            ends = np.frombuffer(f.read(8 * documents), "<i8")
            rest = f.read()
        out = cls(TYPES[code], lengths, ends, np.frombuffer(rest, np.int8) if rest else None)
        if len(ends) == 0 or ends[-1] != len(lengths):
            raise ValueError("the last document doesn't end with the last sequence")
        return out

    def write(self, path: str) -> None:
        code = next(k for k, t in TYPES.items() if np.dtype(t) == self.dtype)
        with open(path, "wb") as f:
            f.write(MAGIC + struct.pack("<QBQQ", VERSION, code, len(self.lengths), len(self.ends)))
            for a, kind in ((self.lengths, "<i4"), (self.starts, "<i8"), (self.ends, "<i8")):
                f.write(a.astype(kind).tobytes())
            if self.modes is not None:
                f.write(self.modes.astype(np.int8).tobytes())


class Builder:
    """Writes a store sequence by sequence."""

    def __init__(self, prefix: str, dtype=np.int32) -> None:
        self.prefix, self.dtype, self.lengths, self.ends, self.modes = prefix, np.dtype(dtype), [], [0], []
        self.file = open(f"{prefix}.bin", "wb", buffering=1 << 20)  # noqa: SIM115

    def add(self, tokens, mode: int = 0) -> None:
        data = np.asarray(tokens, self.dtype)
        self.file.write(data.tobytes())
        self.lengths.append(len(data))
        self.modes.append(mode)

    def add_document(self, sequences) -> None:
        for s in sequences:
            self.add(s)
        self.end_document()

    def end_document(self) -> None:
        self.ends.append(len(self.lengths))

    def add_store(self, prefix: str) -> None:
        """Another store behind this one; its token type must be the same, its document ends are moved."""
        other = Index.read(f"{prefix}.idx")
        if other.dtype != self.dtype:
            raise ValueError("the stores have different token types")
        at = len(self.lengths)
        self.lengths += other.lengths.tolist()
        self.ends += (other.ends[1:] + at).tolist()
        self.modes += other.modes.tolist() if other.modes is not None else [0] * len(other.lengths)
        with open(f"{prefix}.bin", "rb") as f:
            while part := f.read(16 << 20):
                self.file.write(part)

    def finish(self) -> Index:
        self.file.close()
        modes = np.array(self.modes, np.int8) if any(self.modes) else None
        index = Index(self.dtype, np.array(self.lengths, np.int32), np.array(self.ends, np.int64), modes)
        index.write(f"{self.prefix}.idx")
        return index


_HEAD = len(MAGIC) + 25


def header(path: str) -> tuple[np.dtype, int, int]:
    """Token type, sequences and documents (with the empty one at the beginning) of an index."""
    with open(path, "rb") as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no index")
        version, code, sequences, documents = struct.unpack("<QBQQ", f.read(25))
    if version != VERSION:
        raise ValueError(f"version {version}")
    return np.dtype(TYPES[code]), sequences, documents


class Mapped:
    """An index mapped from its file: only what is looked at is read."""

    def __init__(self, prefix: str) -> None:
        path = f"{prefix}.idx"
        self.dtype, n, d = header(path)
        part = lambda kind, at, size: np.memmap(path, kind, "r", at, (size,)) if size else np.zeros(0, kind)
        self.lengths, self.starts, self.ends = part("<i4", _HEAD, n), part("<i8", _HEAD + 4 * n, n), part("<i8", _HEAD + 12 * n, d)


def get(prefix: str, sequence: int, offset: int = 0, length: int | None = None, mapped: bool = False) -> np.ndarray:
    """Tokens of a sequence, or of a part of it; read from the file, or mapped."""
    index = Mapped(prefix)
    n = int(index.lengths[sequence]) - offset if length is None else length
    at = int(index.starts[sequence]) + offset * index.dtype.itemsize
    return np.memmap(f"{prefix}.bin", index.dtype, "r", at, (n,)) if mapped and n else np.fromfile(f"{prefix}.bin", index.dtype, n, offset=at)


def _side_by_side(spark: SparkSession, stores: dict[str, str], tokens_per_task: int) -> DataFrame:
    """(doc_id, seq_id, a column of tokens for each name in ``stores``): equally long stores, cut at the same sequences into ranges of about
    equal tokens of all of them, one for each task. Documents are those of the first.

    The driver looks up the ranges' bounds in the mapped indexes, a task maps the parts of its range.
    """
    indexes = [Mapped(s) for s in stores.values()]
    n = len(indexes[0].lengths)
    before = lambda i: sum(int(x.starts[i]) // x.dtype.itemsize for x in indexes)
    size = before(n - 1) + sum(int(x.lengths[-1]) for x in indexes) if n else 0
    cuts = [bisect_left(range(n), at, key=before) for at in range(tokens_per_task, size, tokens_per_task)]
    bounds = sorted({0, *cuts, n})
    ranges = list(zip(bounds[:-1], bounds[1:], strict=True))

    def rows(prefix: str, own: Mapped, lo: int, hi: int) -> list[np.ndarray]:
        lengths, starts = own.lengths[lo:hi].astype(np.int64), own.starts[lo:hi]
        data = np.fromfile(f"{prefix}.bin", own.dtype, int(lengths.sum()), offset=int(starts[0]))
        at = ((starts - starts[0]) // own.dtype.itemsize).astype(int)
        return [data[s : s + n].astype(np.int32) for s, n in zip(at, lengths, strict=True)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {name: (s, Mapped(s)) for name, s in stores.items()}
        ends = next(iter(own.values()))[1].ends
        for frame in batches:
            for a, b in zip(frame["a"], frame["b"], strict=True):
                for lo in range(a, b, 4096):
                    hi = min(lo + 4096, b)
                    seq = np.arange(lo, hi)
                    first, last = np.searchsorted(ends, [lo, hi], side="right")
                    yield pd.DataFrame({"doc_id": first - 1 + np.searchsorted(np.asarray(ends[first:last]), seq, side="right"), "seq_id": seq} | {name: rows(s, x, lo, hi) for name, (s, x) in own.items()})

    listed = spark.createDataFrame(ranges or [(0, 0)], "a bigint, b bigint").repartition(max(1, len(ranges)), "a")
    return listed.mapInPandas(run, ", ".join(["doc_id bigint", "seq_id bigint", *(f"`{name}` array<int>" for name in stores)]))


def read_store(spark: SparkSession, prefix: str, tokens_per_task: int = 4 << 20) -> DataFrame:
    """(doc_id, seq_id, tokens): a store, cut into ranges of sequences of about equal tokens, one for each task."""
    return _side_by_side(spark, {"tokens": prefix}, tokens_per_task)


def _copied(spark: SparkSession, parts: list[tuple[str, bool]], target: str, dtype) -> tuple[int, int, int]:
    """(sequences, documents, bytes) of ``target``, the stores of ``parts`` behind one another, copied by tasks to their offsets.

    A part whose flag is set ends within a document that the next one goes on with.
    """
    width, at, jobs = np.dtype(dtype).itemsize, [0, 0, 0], []
    for name, open_end in parts:
        kind, n, d = header(f"{name}.idx")
        if kind != np.dtype(dtype):
            raise ValueError("the stores have different token types")
        size = os.path.getsize(f"{name}.bin")
        jobs.append((name, *at, bool(open_end)))
        at = [at[0] + n, at[1] + d - 1 - open_end, at[2] + size]
    sequences, documents, size = at
    code = next(k for k, t in TYPES.items() if np.dtype(t) == np.dtype(dtype))
    modes = any(os.path.getsize(f"{n}.idx") > _HEAD + 12 * header(f"{n}.idx")[1] + 8 * header(f"{n}.idx")[2] for n, _ in parts)
    with open(f"{target}.bin", "wb") as f:
        f.truncate(size)
    with open(f"{target}.idx", "wb") as f:
        f.write(MAGIC + struct.pack("<QBQQ", VERSION, code, sequences, documents + 1))
        f.truncate(_HEAD + 12 * sequences + 8 * (documents + 1) + (sequences if modes else 0))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, s, d, b, open_end in frame[["name", "s", "d", "b", "open_end"]].itertuples(index=False):
                own = Mapped(name)
                n, ends = len(own.lengths), np.asarray(own.ends[1:])
                with open(f"{target}.idx", "r+b") as f:
                    spans = [(_HEAD + 4 * s, own.lengths), (_HEAD + 4 * sequences + 8 * s, own.starts + b), (_HEAD + 12 * sequences + 8 * (d + 1), (ends[:-1] if open_end else ends) + s)]
                    if modes:
                        rest = np.fromfile(f"{name}.idx", np.int8, offset=_HEAD + 12 * n + 8 * len(own.ends))
                        spans.append((_HEAD + 12 * sequences + 8 * (documents + 1) + s, rest if len(rest) else np.zeros(n, np.int8)))
                    for place, values in spans:
                        f.seek(place)
                        f.write(values.tobytes())
                with open(f"{name}.bin", "rb") as source, open(f"{target}.bin", "r+b") as f:
                    f.seek(b)
                    while part := source.read(16 << 20):
                        f.write(part)
            yield pd.DataFrame({"name": frame["name"]})

    if jobs:
        listed = spark.createDataFrame(jobs, "name string, s bigint, d bigint, b bigint, open_end boolean").repartition(len(jobs), "name")
        listed.mapInPandas(run, "name string").count()
    return sequences, documents, size


def write_store(df: DataFrame, prefix: str, order: list[str], document: str, tokens: str, dtype=np.int32) -> tuple[int, int, int]:
    """Writes rows in ``order``, one document for each run of ``document``: (sequences, documents, bytes).

    Parts are written by range, side by side; a document of any size spreads over them. Each then copies itself to its place in the one store.
    The folder of ``prefix`` must be one that all tasks and the driver see.
    """
    folder = f"{prefix}_parts"
    os.makedirs(folder, exist_ok=True)
    kind = df.schema[document].dataType.simpleString()
    parted = df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        builder, first, last, n = Builder(f"{folder}/{part:06d}", dtype), None, None, 0
        for frame in batches:
            for d, t in zip(frame[document], frame[tokens], strict=True):
                if n and d != last:
                    builder.end_document()
                builder.add(t)
                first, last, n = (d if not n else first), d, n + 1
        if n:
            builder.end_document()
        builder.finish()
        yield pd.DataFrame({"part": [part], "n": [n], "first": [first], "last": [last]})

    done = parted.select(document, tokens, *[o for o in order if o not in (document, tokens)]).mapInPandas(run, f"part int, n bigint, first {kind}, last {kind}").collect()
    held = sorted((r for r in done if r["n"]), key=lambda r: r["part"])
    following = [*held[1:], None]
    whole = _copied(df.sparkSession, [(f"{folder}/{r['part']:06d}", f is not None and f["first"] == r["last"]) for r, f in zip(held, following, strict=True)], prefix, dtype)
    for r in done:
        for suffix in ("bin", "idx"):
            os.remove(f"{folder}/{r['part']:06d}.{suffix}")
    os.rmdir(folder)
    return whole


def merge_stores(folder: str, prefix: str, keys: list[str], spark: SparkSession | None = None) -> dict[str, tuple[int, int, int]]:
    """For each key the stores of a folder whose names hold it, in order of their names, as one; half a store is an error.

    Gives (sequences, documents, bytes) of each. Tasks copy the stores to their places.
    """
    spark, out = spark or SparkSession.builder.getOrCreate(), {}
    for key in keys:
        names = sorted({os.path.splitext(n)[0] for n in os.listdir(folder) if key in n and n.endswith((".bin", ".idx"))})
        for n in names:
            if not all(os.path.exists(f"{folder}/{n}.{s}") for s in ("bin", "idx")):
                raise FileNotFoundError(f"{n} is half a store")
        if names:
            out[key] = _copied(spark, [(f"{folder}/{n}", False) for n in names], f"{prefix}_{key}", header(f"{folder}/{names[0]}.idx")[0])
    return out


def packed_store(spark: SparkSession, prefix: str, tokens_per_task: int = 4 << 20) -> DataFrame:
    """(seq_id, one column for each field) of the stores ``prefix_packed_<field>_document``, which must be equally long.

    A task reads its range of sequences from every store, so no tokens are shuffled for a join or broadcast.
    """
    folder, base = os.path.split(prefix)
    head, tail = f"{base}_packed_", "_document.idx"
    fields = sorted(n[len(head) : -len(tail)] for n in os.listdir(folder or ".") if n.startswith(head) and n.endswith(tail))
    stores = {f: f"{prefix}_packed_{f}_document" for f in fields}
    if len({header(f"{s}.idx")[1] for s in stores.values()}) != 1:
        raise ValueError("the stores of a packed set are not equally long")
    return _side_by_side(spark, stores, tokens_per_task).drop("doc_id")
