"""Pieces of token samples as small byte strings, so that tokens move through shuffles compressed and in few bytes.

Labels are the tokens themselves or -100 nearly always, so they are kept as the places where one changes into the other.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.tokens import IGNORE

_HEAD = struct.Struct("<BIII")
_NARROW, _OWN_LABELS, _BEGINS_TRAINED = 1, 2, 4


def encoded(ids: np.ndarray, labels: np.ndarray | None, codec: pa.Codec) -> bytes:
    """Tokens and labels of equal length; null labels are -100 throughout."""
    narrow = len(ids) == 0 or (ids.min() >= 0 and ids.max() < 65536)
    flags, edges = _NARROW if narrow else 0, np.zeros(0, np.int32)
    if labels is not None:
        trained = labels != IGNORE
        if bool((labels[trained] == ids[trained]).all()):
            edges = (np.flatnonzero(trained[1:] != trained[:-1]) + 1).astype(np.int32)
            flags |= _BEGINS_TRAINED if len(trained) and trained[0] else 0
        else:
            flags, edges = flags | _OWN_LABELS, labels.astype(np.int32)
    raw = ids.astype(np.uint16 if narrow else np.int32).tobytes() + edges.tobytes()
    return _HEAD.pack(flags, len(ids), len(edges), len(raw)) + codec.compress(raw, asbytes=True)


def length(payload: bytes) -> int:
    """Tokens of a payload."""
    return _HEAD.unpack_from(payload)[1]


def decoded(payload: bytes, codec: pa.Codec) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, labels) of ``encoded``."""
    flags, n, m, size = _HEAD.unpack_from(payload)
    raw = codec.decompress(memoryview(payload)[_HEAD.size :], size, asbytes=True) if size else b""
    width = 2 if flags & _NARROW else 4
    ids = np.frombuffer(raw, np.uint16 if flags & _NARROW else np.int32, n).astype(np.int32)
    edges = np.frombuffer(raw, np.int32, m, n * width)
    if flags & _OWN_LABELS:
        return ids, edges
    trained = np.zeros(n, np.int8)
    trained[edges] = 1
    on = (np.cumsum(trained) + bool(flags & _BEGINS_TRAINED)) % 2 == 1
    return ids, np.where(on, ids, IGNORE).astype(np.int32)


def pieces(df: DataFrame, capacity: int, sample_id: str, ids: str, labels: str, pad: int) -> DataFrame:
    """(sample_id, piece, payload): every sample without its padding, cut into pieces of ``capacity``.

    Labels that are too short are filled with -100, longer ones cut. Null tokens are -1. Samples without tokens have no piece.
    """
    schema = pa.schema([("sample_id", pa.int64()), ("piece", pa.int32()), ("payload", pa.binary())])

    def values(column: pa.ListArray, missing: int) -> tuple[np.ndarray, np.ndarray]:
        flat = column.values
        flat = flat.fill_null(missing) if flat.null_count else flat
        return flat.to_numpy(zero_copy_only=False), column.offsets.to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for b in batches:
            own, out = b.column(0).to_pylist(), []
            (x, at), (y, y_at) = values(b.column(1), -1), values(b.column(2), IGNORE)
            held, labelled = b.column(1).is_valid().to_pylist(), b.column(2).is_valid().to_pylist()
            for i, sample in enumerate(own):
                if not held[i]:
                    continue
                t = x[at[i] : at[i + 1]]
                real = np.flatnonzero(t != pad)
                t = t[: real[-1] + 1] if len(real) else t[:0]
                lab = None
                if labelled[i]:
                    lab = y[y_at[i] : y_at[i + 1]][: len(t)]
                    lab = lab if len(lab) == len(t) else np.concatenate([lab, np.full(len(t) - len(lab), IGNORE, np.int32)])
                for k, a in enumerate(range(0, len(t), capacity)):
                    out.append((sample, k, encoded(t[a : a + capacity], None if lab is None else lab[a : a + capacity], codec)))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], f.type) for j, f in enumerate(schema)], schema=schema)

    from pyspark.sql import functions as F

    rows = df.select(F.col(sample_id).cast("bigint").alias("sample_id"), F.col(ids).cast("array<int>").alias("x"), F.col(labels).cast("array<int>").alias("y"))
    return rows.mapInArrow(run, "sample_id bigint, piece int, payload binary")
