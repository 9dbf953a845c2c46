"""Samples of varying length packed into containers of fixed capacity by the sum-of-squares rule.

Only (id, piece, length) rows are packed: they are spread by hash over groups of a bounded number of items, each
packed by one task that keeps, for every residual gap, the number of open containers. Items go in, the large ones by falling
length and the small ones behind them in seeded order, each to the gap after which the sum of the squared counts of open containers is smallest. The items of the
containers that stay open are then packed again by the same rule, in the group and over ever fewer groups, until one group holds them or nothing is gained,
so what is lost at the borders of groups doesn't grow with their number. Tokens move compressed, once for the join to their
places and once for the containers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import payloads
from corpusloom.llm.tokens import IGNORE, PAD, length_without_padding
from corpusloom.session import checkpointed

#: Items that one task packs at a time: about a second and a few MB.
ITEMS_PER_GROUP = 32_768
#: Items of less than this share of the capacity fill gaps; they come last, in seeded order.
SMALL = 8
#: Times that a group's open containers are packed again.
AGAIN = 4
#: Rounds over the items of open containers.
ROUNDS = 6


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item, the items taken in the order given; lengths lie in 1..capacity."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    out, n = np.zeros(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max // 4
    for i, s in enumerate(lengths.tolist()):
        at = count[s:]
        change = 2 * (count[: capacity + 1 - s] - at) + 2
        change[0] = 1 - 2 * at[0]
        change[at == 0] = never
        # equal changes: the smallest gap; a new container adds one at its gap
        k = int(change.argmin())
        if change[k] < (2 * count[capacity - s] + 1 if s < capacity else 0):
            b = open_at[k + s].pop()
            count[k + s] -= 1
            gap = k
        else:
            b, gap, n = n, capacity - s, n + 1
        if gap:
            open_at[gap].append(b)
            count[gap] += 1
        out[i] = b
    return out


def pack_group(lengths: np.ndarray, capacity: int, seed: int = 0) -> np.ndarray:
    """Container number of each item. Small items come last, in seeded order, as they would leave equal gaps by falling length.

    What lies in containers left open is packed again in another order, by the same rule, as often as that saves any.
    """
    draw = np.random.default_rng(seed)
    falling = np.argsort(-lengths, kind="stable")
    large = lengths[falling] >= capacity / SMALL
    order = np.concatenate([falling[large], draw.permutation(falling[~large])])
    bins = np.empty(len(lengths), np.int64)
    bins[order] = sum_of_squares(lengths[order], capacity)
    for k in range(AGAIN):
        fill = np.bincount(bins, lengths).astype(np.int64)
        loose = np.flatnonzero(fill[bins] < capacity)
        loose = draw.permutation(loose) if k % 2 == 0 else loose[np.argsort(-lengths[loose], kind="stable")]
        again = sum_of_squares(lengths[loose], capacity)
        if not len(loose) or again.max() + 1 >= (fill < capacity).sum():
            break
        bins[loose] = again + len(fill)
        bins = np.unique(bins, return_inverse=True)[1]
    return bins


def _grouped(items: DataFrame, capacity: int, groups: int, round_no: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n", "sample_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins = pack_group(frame["n"].to_numpy(), capacity)
        n = frame["n"].to_numpy().astype(np.int64)
        order = np.argsort(bins, kind="stable")
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        began, runs = np.cumsum(n[order]) - n[order], np.diff(np.append(first, len(order)))
        at, slot = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        at[order] = began - np.repeat(began[first], runs)
        slot[order] = np.arange(len(n)) - np.repeat(first, runs)
        free = capacity - np.bincount(bins, n).astype(np.int64)
        pack_id = bins + (frame["g"].to_numpy().astype(np.int64) + (round_no << 24) << 32)
        return frame[["sample_id", "piece", "start", "n"]].assign(pack_id=pack_id, slot=slot, at=at, free=free[bins])

    g = F.pmod(F.xxhash64("sample_id", "piece", F.lit(round_no)), F.lit(groups)).cast("int")
    return items.select("sample_id", "piece", "start", "n", g.alias("g")).groupBy("g").applyInPandas(run, "sample_id bigint, piece int, start int, n int, pack_id bigint, slot int, at int, free int")


def items_of(df: DataFrame, capacity: int, sample_id: str = "sample_id", ids: str = "input_ids", pad: int = PAD) -> DataFrame:
    """(sample_id, piece, start, n): each sample once, or its pieces of full capacity and the rest if it is longer."""
    n = df.select(F.col(sample_id).cast("bigint").alias("sample_id"), length_without_padding(ids, pad).alias("all")).where(F.col("all") > 0)
    at = F.explode(F.sequence(F.lit(0), F.floor((F.col("all") - 1) / capacity).cast("int")))
    return n.select("sample_id", at.alias("piece"), "all").select("sample_id", "piece", (F.col("piece") * capacity).alias("start"), F.least(F.lit(capacity), F.col("all") - F.col("piece") * capacity).alias("n"))


def places(df: DataFrame, capacity: int = 2048, sample_id: str = "sample_id", ids: str = "input_ids", pad: int = PAD, items_per_group: int = ITEMS_PER_GROUP) -> DataFrame:
    """(sample_id, piece, start, n, pack_id, slot, at): where every sample lies.

    ``start`` is where the piece begins in its sample, ``at`` where it begins in container ``pack_id`` and ``slot`` its
    rank there. Samples without tokens (null, empty, padding only) have no place. Ids should be unique; rows of one id
    are packed as often as they occur, but their tokens can then not be told apart. Other columns play no part.
    """
    items = checkpointed(items_of(df, capacity, sample_id, ids, pad))
    left, done = items.count(), []
    groups = max(1, -(-left // items_per_group))
    for round_no in range(ROUNDS):
        packed = _grouped(items, capacity, groups, round_no)
        if groups == 1 or round_no == ROUNDS - 1:
            done.append(packed)
            break
        packed = checkpointed(packed)
        done.append(packed.where("free = 0"))
        items = packed.where("free > 0")
        before, left = left, items.count()
        if left > 0.9 * before:
            done.append(items)
            break
        groups = max(1, -(-left // items_per_group))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)

    return out.drop("free")


def packed_samples(df: DataFrame, capacity: int = 2048, sample_id: str = "sample_id", ids: str = "input_ids", labels: str = "labels", pad: int = PAD, items_per_group: int = ITEMS_PER_GROUP) -> DataFrame:
    """(pack_id, n_samples, n_tokens, n_free, sample_ids, lengths, input_ids, labels): the containers, filled up with padding.

    ``labels`` that are null count as -100 throughout, ones too short are filled with -100; so is the padding. Null tokens are -1.
    ``lengths`` are those of the pieces, in order, from which positions and masks follow. An empty table gives no rows. Of ids that recur each
    place takes a piece of its length, the first in the order of their bytes.
    """
    where = places(df, capacity, sample_id, ids, pad, items_per_group).select("sample_id", "piece", "n", "pack_id", "slot")
    rows = payloads.pieces(df, capacity, sample_id, ids, labels, pad).withColumnRenamed("piece", "_piece").withColumnRenamed("sample_id", "_sample")
    same = F.col("_sample").eqNullSafe(F.col("sample_id")) & (F.col("_piece") == F.col("piece"))
    put = rows.join(where.hint("shuffle_hash"), same).select("pack_id", "slot", "sample_id", "n", "payload")
    packs = put.groupBy("pack_id").agg(F.sort_array(F.collect_list(F.struct("slot", "sample_id", "n", "payload"))).alias("all"))
    schema = pa.schema([("pack_id", pa.int64()), ("n_samples", pa.int32()), ("n_tokens", pa.int32()), ("n_free", pa.int32()), ("sample_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("input_ids", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                counts, ids_of, lengths_of = [], [], []
                x, y = np.full(part.num_rows * capacity, pad, np.int32), np.full(part.num_rows * capacity, IGNORE, np.int32)
                for k, items in enumerate(part.column("all").to_pylist()):
                    i, done = k * capacity, -1
                    own: list[tuple] = []
                    for item in items:
                        # ids that recur meet each other's places: a place takes the first piece of its length
                        if item["slot"] == done or payloads.length(item["payload"]) != item["n"]:
                            continue
                        t, lab = payloads.decoded(item["payload"], codec)
                        x[i : i + len(t)], y[i : i + len(t)] = t, lab
                        i, done = i + len(t), item["slot"]
                        own.append((item["sample_id"], item["n"]))
                    counts.append(i - k * capacity)
                    ids_of.append([o[0] for o in own])
                    lengths_of.append([o[1] for o in own])
                offsets = pa.array(np.arange(0, (part.num_rows + 1) * capacity, capacity, dtype=np.int32))
                rows = [part.column("pack_id"), pa.array(map(len, ids_of), pa.int32()), pa.array(counts, pa.int32()), pa.array([capacity - c for c in counts], pa.int32()), pa.array(ids_of, pa.list_(pa.int64())), pa.array(lengths_of, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*rows, pa.ListArray.from_arrays(offsets, pa.array(x)), pa.ListArray.from_arrays(offsets, pa.array(y))], schema=schema)

    return packs.mapInArrow(run, "pack_id bigint, n_samples int, n_tokens int, n_free int, sample_ids array<bigint>, lengths array<int>, input_ids array<int>, labels array<int>")
