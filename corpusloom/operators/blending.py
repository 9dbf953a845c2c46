"""Schedules that blend a few datasets into one sequence: by largest deficit, exactly, or interleaved at random.

Tasks make blocks of positions side by side. Where a block begins, the greedy rule's counts are within a few of weight times position;
each task finds them by running the rule some way before its block from such a guess. The driver then checks that every block ends with
the counts the next one began with, and has those that don't run again from the right ones, so the whole is what one run from the
beginning gives. Random draws depend on the position alone, and counts of blocks give each its start. One row for each block
and dataset reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Positions that one task makes.
BLOCK = 1 << 20
#: Positions that a task runs before its block.
RUN_UP = 1 << 14
#: Rows generated at a time.
STEP = 65_536


def normalized(weights: list[float]) -> list[float]:
    total = sum(weights)
    if total <= 0:
        raise ValueError("weights must have a positive sum")
    return [w / total for w in weights]


def dataset_sizes(weights: list[float], size: int, margin: float = 0.5) -> list[int]:
    """Samples to draw from each dataset: its share, rounded up, and ``margin`` percent more."""
    return [math.ceil(math.ceil(size * w) * (1 + margin / 100)) for w in normalized(weights)]


def blend_list(parts: list[str]) -> tuple[list[float] | None, list[str]]:
    """Weights and names of a flat list: of an odd number, or with a weight that is no number, all are names."""
    if len(parts) % 2 or not parts:
        return None, list(parts)
    try:
        return [float(x) for x in parts[::2]], list(parts[1::2])
    except ValueError:
        return None, list(parts)


def _deficits(weights: np.ndarray, limits: np.ndarray | None, at: int, end: int, taken: np.ndarray) -> Iterator[tuple[int, int]]:
    """(dataset, sample) of the positions ``at`` .. ``end`` - 1, with ``taken`` samples of each before; ``taken`` is kept up to date."""
    w, c = weights.tolist(), taken.tolist()
    most = [float("inf")] * len(w) if limits is None else limits.tolist()
    sets = range(len(w))
    for i in range(at, end):
        n, best, k = i if i > 1 else 1, -float("inf"), 0
        for j in sets:
            if c[j] < most[j] and (e := w[j] * n - c[j]) > best:
                best, k = e, j
        yield k, c[k]
        c[k] += 1
        taken[k] = c[k]


def _guess(weights: np.ndarray, limits: np.ndarray | None, at: int) -> np.ndarray:
    """Counts near weight times position that add up to the position and keep the limits."""
    share = weights * at
    out = np.floor(share).astype(np.int64)
    if limits is not None:
        out = np.minimum(out, limits)
    for k in np.argsort(out - share, kind="stable").tolist() * 2:
        if out.sum() < at and (limits is None or out[k] < limits[k]):
            out[k] += 1
    return out


def _frame(rows: list[tuple[int, int]], at: int) -> pd.DataFrame:
    d, s = zip(*rows, strict=True)
    return pd.DataFrame({"pos": np.arange(at, at + len(rows)), "dataset_id": np.array(d, np.int16), "sample_id": np.array(s, np.int64)})


def _greedy(spark: SparkSession, weights: np.ndarray, limits: np.ndarray | None, size: int, block: int) -> DataFrame:
    bounds = [(a, min(a + block, size)) for a in range(0, size, block)]
    known: dict[int, list[int]] = {0: [0] * len(weights)}

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for b, given in zip(frame["b"], frame["given"], strict=True):
                a, e = bounds[b]
                if given is None:
                    first = max(a - RUN_UP, 0)
                    taken = _guess(weights, limits, first)
                    for _ in _deficits(weights, limits, first, a, taken):
                        pass
                else:
                    taken = np.array(given, np.int64)
                began = taken.tolist()
                for _ in _deficits(weights, limits, a, e, taken):
                    pass
                out.append((b, began, taken.tolist()))
            yield pd.DataFrame(out, columns=["b", "began", "ended"])

    todo, ran = list(range(len(bounds) - 1)), {}
    while todo:
        rows = spark.createDataFrame([(b, known.get(b)) for b in todo], "b int, given array<bigint>").repartition(len(todo), "b")
        ran |= {r["b"]: (list(r["began"]), list(r["ended"])) for r in rows.mapInPandas(ends, "b int, began array<bigint>, ended array<bigint>").collect()}
        todo = []
        for b in range(len(bounds) - 1):
            if ran[b][0] != known[b]:
                # this block ran from other counts than the one before it ended with: again, and those behind it stay as they are
                todo.append(b)
                break
            known[b + 1] = ran[b][1]

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, e, given in zip(frame["a"], frame["e"], frame["given"], strict=True):
                rows, at = [], int(a)
                for row in _deficits(weights, limits, int(a), int(e), np.array(given, np.int64)):
                    rows.append(row)
                    if len(rows) == STEP:
                        yield _frame(rows, at)
                        at, rows = at + STEP, []
                if rows:
                    yield _frame(rows, at)

    listed = spark.createDataFrame([(a, e, known[b]) for b, (a, e) in enumerate(bounds)], "a bigint, e bigint, given array<bigint>").repartition(max(1, len(bounds)), "a")
    return listed.mapInPandas(make, _SCHEDULE)


_SCHEDULE = "pos bigint, dataset_id smallint, sample_id bigint"


def weighted_blend(spark: SparkSession, weights: list[float], size: int, block: int = BLOCK) -> DataFrame:
    """(pos, dataset_id, sample_id): at each position the dataset furthest behind its weight; of equal ones the first."""
    return _greedy(spark, np.array(normalized(weights)), None, size, block)


def exhaustive_blend(spark: SparkSession, sizes: list[int], block: int = BLOCK) -> DataFrame:
    """As ``weighted_blend`` with weights in proportion to ``sizes``, every dataset drawn exactly as often as its size."""
    n = np.array(sizes, np.int64)
    return _greedy(spark, n / max(n.sum(), 1), n, int(n.sum()), block)


def interleaved(spark: SparkSession, sizes: list[int], probabilities: list[float], seed: int, until: str = "first_exhausted", block: int = BLOCK) -> DataFrame:
    """(pos, dataset_id, sample_id): datasets drawn at random, each in its own order, by the MD5 of seed and position.

    Ends with the first dataset that is used up, or, under ``all_exhausted``, when every one has been, those used up before
    beginning again. An empty dataset ends it at once or is never drawn.
    """
    if until not in ("first_exhausted", "all_exhausted"):
        raise ValueError(until)
    p = normalized(probabilities)
    usable = [k for k, n in enumerate(sizes) if n and p[k] > 0]
    if not usable or (until == "first_exhausted" and len(usable) < len(sizes)):
        return spark.createDataFrame([], _SCHEDULE)
    whole, at, cuts = sum(p[k] for k in usable), 0.0, []
    for k in usable:
        at += p[k] / whole
        cuts.append(at)

    def drawn(blocks: DataFrame) -> DataFrame:
        every = blocks.select("b", "given", F.explode(F.sequence("a", F.col("e") - 1)).alias("pos"))
        u = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("pos").cast("string"))), 1, 12), 16, 10).cast("double") / float(16**12)
        pick = F.lit(usable[-1])
        for k, cut in list(zip(usable, cuts, strict=True))[-2::-1]:
            pick = F.when(u < cut, k).otherwise(pick)
        return every.select("b", "given", "pos", pick.cast("smallint").alias("dataset_id"))

    def blocks_of(bounds: list[tuple[int, int, int, list[int]]]) -> DataFrame:
        return spark.createDataFrame(bounds, "b int, a bigint, e bigint, given array<bigint>").repartition(max(1, len(bounds)), "b")

    # blocks are counted until enough positions are known, twice as many each time
    needs = {k: sizes[k] for k in usable}
    reach = min if until == "first_exhausted" else max
    expected = math.ceil(reach(needs[k] / (p[k] / whole) for k in usable) * 1.05)
    block = max(1, min(block, max(expected, 1024)))
    n_blocks = max(1, -(-expected // block))
    counts: dict[tuple[int, int], int] = {}
    done = 0
    while True:
        more = blocks_of([(b, b * block, (b + 1) * block, []) for b in range(done, n_blocks)])
        counts |= {(r["b"], r["dataset_id"]): r["count"] for r in drawn(more).groupBy("b", "dataset_id").count().collect()}
        done = n_blocks
        enough = [sum(counts.get((b, k), 0) for b in range(done)) >= needs[k] for k in usable]
        if any(enough) if until == "first_exhausted" else all(enough):
            break
        n_blocks *= 2
    starts, taken = [], [0] * len(sizes)
    last: dict[int, tuple[int, int]] = {}
    for b in range(done):
        starts.append(list(taken))
        for k in usable:
            c = counts.get((b, k), 0)
            if k not in last and taken[k] + c >= needs[k]:
                last[k] = (b, needs[k] - taken[k])
            taken[k] += c
    edge = (min if until == "first_exhausted" else max)(b for b, _ in last.values())
    own = [(k, r) for k, (b, r) in last.items() if b == edge]
    rows = drawn(blocks_of([(edge, edge * block, (edge + 1) * block, [])])).where(F.col("dataset_id").isin([k for k, _ in own])).select("pos", "dataset_id").toPandas().sort_values("pos")
    found = [int(rows[rows["dataset_id"] == k]["pos"].iloc[r - 1]) for k, r in own]
    end = (min if until == "first_exhausted" else max)(found) + 1
    bounds = [(b, b * block, min((b + 1) * block, end), starts[b]) for b in range(done) if b * block < end]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counted = None, None
        n = np.array(sizes, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column(0).to_numpy()
            ids = batch.column(3).to_numpy()
            rank = np.empty(len(ids), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(ids)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if blocks[i] != now:
                    now, counted = blocks[i], np.array(batch.column(1)[i].as_py(), np.int64)
                for k in np.unique(ids[i:j]):
                    at = np.flatnonzero(ids[i:j] == k) + i
                    rank[at] = (counted[k] + np.arange(len(at))) % n[k]
                    counted[k] += len(at)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(rank)], names=["pos", "dataset_id", "sample_id"])

    return drawn(blocks_of(bounds)).mapInArrow(numbered, _SCHEDULE)


@dataclass(frozen=True)
class Blend:
    """Datasets by name and, if they are to be weighted, their weights."""

    names: list[str]
    weights: list[float] | None = None


def split_blend(spark: SparkSession, blend: Blend, sizes: dict[str, int], size: int | None, block: int = BLOCK) -> DataFrame:
    """The schedule of one split of datasets of ``sizes``: by weights and then as many as ``size`` asks for of each, or in proportion to the sizes.

    By weights every dataset's share is rounded up, and what is blended is their sum. Without weights the blend has at most as many as there are, and
    all of them, each once, if no size is given. A single dataset without weights is read in order. Weights without a size are an error.
    """
    have = [sizes[n] for n in blend.names]
    if len(blend.names) == 1:
        n = have[0] if size is None else size
        return spark.range(n).select(F.col("id").alias("pos"), F.lit(0).cast("smallint").alias("dataset_id"), (F.col("id") % max(have[0], 1)).alias("sample_id"))
    if blend.weights is not None:
        if size is None:
            raise ValueError("weights need a size")
        return weighted_blend(spark, blend.weights, sum(dataset_sizes(blend.weights, size, 0.0)), block)
    if size is None or size >= sum(have):
        return exhaustive_blend(spark, have, block)
    return weighted_blend(spark, [float(n) for n in have], size, block)


def blends_by_split(spark: SparkSession, blends: dict[str, Blend | None] | Blend, sizes: dict[str, dict[str, int]], wanted: dict[str, int | None], block: int = BLOCK) -> dict[str, DataFrame | None]:
    """The schedule of each split, none for a split without datasets.

    ``blends`` is one blend for all splits, cut from the same datasets, or one for each; ``sizes`` gives each split's rows of each
    dataset, ``wanted`` each split's size. A split of no rows that one blend would give has none.
    """
    out: dict[str, DataFrame | None] = {}
    for split, have in sizes.items():
        b = blends if isinstance(blends, Blend) else blends.get(split)
        held = b is not None and any(have.get(n) for n in b.names)
        out[split] = split_blend(spark, b, have, wanted.get(split), block) if held else None
    return out


def blended_rows(schedule: DataFrame, datasets: list[DataFrame], ordinal: str = "ord") -> DataFrame:
    """The datasets' rows in the order of a schedule, joined by (dataset, ordinal)."""
    out = None
    for k, d in enumerate(datasets):
        rows = d.withColumn("dataset_id", F.lit(k).cast("smallint")).withColumnRenamed(ordinal, "sample_id")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return schedule.join(out, ["dataset_id", "sample_id"])
