"""Oversized token samples cut into overlapping pieces by content-defined chunking.

A rolling hash over the last tokens marks landmarks; the first landmark between the smallest and the largest
piece size is moved to the best natural boundary near it (end of turn, paragraph, sentence, word). Landmark and
boundary depend on the tokens around them alone, so an edit changes the pieces beside it and the cuts further on
fall where they fell before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import IGNORE, PAD, length_without_padding

ANSWER_END, TURNS = 257, (260, 261, 262)
TURN, PARAGRAPH, SENTENCE, WORD = 4, 3, 2, 1


@dataclass(frozen=True)
class Cuts:
    """Sizes in tokens. ``smallest`` counts the overlap; about one token in ``spacing`` is a landmark."""

    largest: int = 2048
    overlap: int = 128
    smallest: int = 1024
    radius: int = 192
    spacing: int = 256
    window: int = 32

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.smallest <= self.largest:
            raise ValueError("0 <= overlap < smallest <= largest is needed")


def _mixed(x: np.ndarray) -> np.ndarray:
    z = x.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(27))


def landmarks(tokens: np.ndarray, window: int, spacing: int) -> np.ndarray:
    """Positions p at which the hash of the ``window`` tokens before p is a multiple of ``spacing``."""
    if len(tokens) < window:
        return np.zeros(0, np.int64)
    base = np.uint64(0x100000001B3)
    g, h = _mixed(tokens), np.zeros(len(tokens) - window + 1, np.uint64)
    for j in range(window):
        h = h * base + g[j : j + len(h)]
    h ^= h >> np.uint64(33)
    return np.flatnonzero(h % np.uint64(spacing) == 0) + window


def boundary_levels(t: np.ndarray) -> np.ndarray:
    """For each position p in 0..n the level of a cut before token p; 0 is no boundary, -1 inside a character."""
    n = len(t)
    level = np.zeros(n + 1, np.int8)
    if n < 2:
        return level
    space, newline = np.isin(t, (32, 9, 10, 13)), t == 10
    before, after = t[:-1], t[1:]
    inner = level[1:n]
    inner[(after >= 128) & (after < 192) & (before >= 128) & (before < 256)] = -1
    inner[~space[:-1] & space[1:]] = WORD
    closing = np.isin(t, (34, 39, 41, 93, 125))
    ends = np.isin(t, (46, 33, 63))
    ends[2:] |= (t[:-2] == 0xE2) & (t[1:-1] == 0x80) & (t[2:] == 0xA6)
    ends[2:] |= (t[:-2] == 0xE3) & (t[1:-1] == 0x80) & (t[2:] == 0x82)
    stop = ends.copy()
    for _ in range(2):
        stop[1:] |= closing[1:] & stop[:-1]
    inner[stop[:-1] & space[1:]] = SENTENCE
    inner[newline[:-1] & ~newline[1:]] = SENTENCE
    two = np.zeros(n, bool)
    two[1:] = newline[1:] & newline[:-1]
    inner[two[:-1] & ~newline[1:]] = PARAGRAPH
    inner[(before == ANSWER_END) | np.isin(after, TURNS)] = TURN
    return level


def cut_points(t: np.ndarray, c: Cuts) -> list[tuple[int, int]]:
    """(start, end) of the pieces of one sample, in order; one piece if it isn't oversized."""
    n = len(t)
    if n <= c.largest:
        return [(0, n)]
    marks, level = landmarks(t, c.window, c.spacing), boundary_levels(t)
    out, s = [], 0
    while n - s > c.largest:
        lo, hi = s + c.smallest, s + c.largest
        i = int(np.searchsorted(marks, lo))
        mark = int(marks[i]) if i < len(marks) and marks[i] <= hi else hi
        for a, b in ((max(lo, mark - c.radius), min(hi, mark + c.radius)), (lo, hi)):
            near = level[a : b + 1]
            best = int(near.max())
            if best > 0:
                at = np.flatnonzero(near == best) + a
                e = int(at[np.abs(at - mark).argmin()])
                break
        else:
            whole = np.flatnonzero(level[lo : hi + 1] == 0) + lo
            e = int(whole[np.abs(whole - mark).argmin()]) if len(whole) else hi
        out.append((s, e))
        s = e - c.overlap
    return [*out, (s, n)]


def split_oversized(df: DataFrame, cuts: Cuts = Cuts(), sample_id: str = "sample_id", ids: str = "input_ids", labels: str = "labels", pad: int = PAD) -> DataFrame:  # noqa: B008
    """(sample_id, piece, n_pieces, start, input_ids, labels): the pieces of every sample over ``cuts.largest`` tokens.

    Padding at the end doesn't count and isn't in a piece. Samples that fit, null and empty ones among them, give no
    rows. Null ``labels`` give null labels; labels that are too short are filled with -100, longer ones cut. Repeated
    samples are cut alike, each under its own id; a null id stays null. Other columns of ``df`` play no part.
    """
    schema = pa.schema([("sample_id", pa.int64()), ("piece", pa.int32()), ("n_pieces", pa.int32()), ("start", pa.int32()), ("input_ids", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col: dict[str, list] = {f.name: [] for f in schema}
            for i in range(b.num_rows):
                n = b.column(3)[i].as_py()
                t = b.column(1)[i].values.to_numpy(zero_copy_only=False)[:n]
                t = np.where(np.isnan(t), -1, t).astype(np.int32) if t.dtype.kind == "f" else t
                lab = b.column(2)[i]
                if lab.is_valid:
                    y = lab.values.to_numpy(zero_copy_only=False)
                    y = np.where(np.isnan(y), IGNORE, y).astype(np.int32) if y.dtype.kind == "f" else y
                    y = np.concatenate([y[:n], np.full(max(0, n - len(y)), IGNORE, np.int32)])
                pieces = cut_points(t, cuts)
                for k, (s, e) in enumerate(pieces):
                    col["sample_id"].append(b.column(0)[i].as_py())
                    col["piece"].append(k)
                    col["n_pieces"].append(len(pieces))
                    col["start"].append(s)
                    col["input_ids"].append(t[s:e])
                    col["labels"].append(y[s:e] if lab.is_valid else None)
            yield pa.RecordBatch.from_pydict(col, schema=schema)

    long = df.select(F.col(sample_id).cast("bigint").alias("sample_id"), F.col(ids).cast("array<int>").alias("input_ids"), F.col(labels).cast("array<int>").alias("labels")).where(F.size("input_ids") > cuts.largest)
    return long.withColumn("n", length_without_padding("input_ids", pad)).where(F.col("n") > cuts.largest).mapInArrow(run, "sample_id bigint, piece int, n_pieces int, start int, input_ids array<int>, labels array<int>")
