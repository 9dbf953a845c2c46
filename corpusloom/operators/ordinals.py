"""Ordinals, prefix sums, splits and orders of datasets that are addressed by position, without a window over all rows."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from corpusloom.session import checkpointed, shuffle_width


def with_prefix(df: DataFrame, order: list[str], value: Column | None = None, name: str = "ord") -> DataFrame:
    """``df`` with the sum of ``value`` (1 by default) over all rows before each in ``order``, which must be unique.

    Rows are range-partitioned by ``order``, sorted and kept in the checkpoint folder; the partitions' totals (one row each)
    give the offsets, and each partition is then summed where it lies, without another shuffle. Null values count 0.
    """
    n = shuffle_width(df.sparkSession)
    v = F.coalesce(value if value is not None else F.lit(1), F.lit(0)).cast("bigint")
    parted = checkpointed(df.withColumn("__prefix_v", v).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__prefix_p", F.spark_partition_id()))
    offsets, at = {}, 0
    for r in sorted(parted.groupBy("__prefix_p").agg(F.sum("__prefix_v").alias("t")).collect(), key=lambda r: r["__prefix_p"]):
        offsets[r["__prefix_p"]] = at
        at += r["t"]
    kept = [c for c in parted.columns if c not in ("__prefix_v", "__prefix_p", name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            if total is None:
                total = offsets[b.column("__prefix_p")[0].as_py()]
            own = b.column("__prefix_v").to_numpy(zero_copy_only=False)
            sums = total + np.cumsum(own)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(sums - own, pa.int64())], names=[*kept, name])
            total = int(sums[-1])

    schema = StructType([*[parted.schema[c] for c in kept], StructField(name, LongType())])
    return parted.mapInArrow(run, schema)


def split_weights(text: str) -> list[float]:
    """Three shares from a text such as ``99,1,0``: numbers in it, filled with 0, relative to their sum."""
    values = [float(x) for x in re.findall(r"\d+(?:\.\d+)?|\.\d+", text)][:3]
    values += [0.0] * (3 - len(values))
    total = sum(values)
    if total <= 0:
        raise ValueError(f"no share in {text!r}")
    return [v / total for v in values]


def split_bounds(shares: list[float]) -> list[tuple[float, float] | None]:
    """Begin and end of each split as shares of the whole; none for a split of no width."""
    out, at = [], 0.0
    for s in shares:
        out.append((at, at + s) if s > 0 else None)
        at += s
    return out


def common_bounds(a: list[tuple[float, float] | None], b: list[tuple[float, float] | None]) -> list[tuple[float, float] | None]:
    """What two lists of bounds have in common, split by split; none where they don't overlap."""
    both = [None if x is None or y is None else (max(x[0], y[0]), min(x[1], y[1])) for x, y in zip(a, b, strict=True)]
    return [v if v is not None and v[0] < v[1] else None for v in both]


def split_ranges(shares: list[float], n: int) -> list[tuple[int, int]]:
    """Ordinals [first, last) of each split of ``n`` rows; bounds are rounded half to even."""
    at, out = 0.0, []
    for s in shares:
        out.append((round(at * n), round((at + s) * n)))
        at += s
    return out


def contiguous_split(df: DataFrame, shares: list[float], names: tuple[str, ...], ordinal: str = "ord", n: int | None = None) -> DataFrame:
    """``df`` with the name of the split of each ordinal."""
    n = df.count() if n is None else n
    out = F.lit(None).cast("string")
    for (a, b), name in zip(split_ranges(shares, n), names, strict=True):
        out = F.when((F.col(ordinal) >= a) & (F.col(ordinal) < b), name).otherwise(out)
    return df.withColumn("split", out)


def sub_ranges(n: int, gap: int) -> list[tuple[int, int]]:
    """[first, last) of full gaps and the remainder."""
    if gap <= 0:
        raise ValueError("the gap must be positive")
    return [(a, min(a + gap, n)) for a in range(0, n, gap)]


def even_part(ordinal: Column, n: int, parts: int) -> Column:
    """Part of an ordinal when ``n`` rows go to ``parts`` of equal size, the first ones one larger."""
    small, large = divmod(n, parts)
    first = large * (small + 1)
    return F.when(ordinal < first, F.floor(ordinal / (small + 1))).otherwise(large + F.floor((ordinal - first) / max(small, 1))).cast("int")


def seeded(seed: int | Column, *ids: str) -> Column:
    """Sort key of a seeded order that any engine can compute."""
    s = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat_ws("-", s, *[F.col(i).cast("string") for i in ids]))


def epoch_order(df: DataFrame, row_id: str, epochs: int, seed: int, separate_last: bool = False) -> DataFrame:
    """(epoch, row_id, pos): every row in every epoch, all epochs shuffled together, or the last one apart behind them."""
    every = df.select(row_id, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    last = (F.col("epoch") == epochs - 1) & F.lit(separate_last and epochs > 1)
    return with_prefix(every.withColumn("late", last.cast("int")).withColumn("order", seeded(seed, "epoch", row_id)), ["late", "order", "epoch", row_id], name="pos").select("epoch", row_id, "pos")


def repeated_order(df: DataFrame, row_id: str, n: int, seed: int, shuffle: bool = True, pad_to: int = 0, reshuffle: bool = False) -> DataFrame:
    """(pos, row_id): whole permutations behind one another until there are ``n`` rows; sequential unless ``shuffle``.

    With ``pad_to`` every repetition is filled up to a multiple of it with the first rows by ``row_id``; with ``reshuffle`` all
    repetitions are shuffled together once more.
    """
    placed = with_prefix(df.select(row_id), [row_id], name="_o")
    size = placed.count()
    if not size:
        return placed.select(F.col("_o").alias("pos"), row_id)
    extra = -size % pad_to if pad_to else 0
    times = max(1, -(-n // (size + extra)))
    one = placed.withColumn("_copy", F.lit(0))
    for k in range(-(-extra // size)):
        one = one.unionByName(placed.where(F.col("_o") < extra - k * size).withColumn("_copy", F.lit(k + 1)))
    every = one.withColumn("_e", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    key = seeded(seed, "_e", "_copy", row_id) if shuffle or reshuffle else F.lit("")
    order = ["_k", "_e", "_copy", "_o"] if reshuffle else ["_e", "_k", "_copy", "_o"]
    return with_prefix(every.withColumn("_k", key), order, name="pos").select("pos", row_id)


def separate_final_epoch(samples: int, per_epoch: int, threshold: float = 0.8) -> bool:
    """Whether the final epoch, of which only part is needed, is shuffled apart: fewer samples than the share of one epoch."""
    if per_epoch <= 0 or samples <= per_epoch:
        return False
    rest = samples - (math.ceil(samples / per_epoch) - 1) * per_epoch
    return rest < int(threshold * per_epoch)


def resampled(df: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """``n`` rows: a seeded permutation's head, or all rows and draws with replacement by a seeded MD5; column ``draw`` numbers them."""
    total = df.count()
    if not total:
        return df.withColumn("draw", F.lit(0).cast("bigint"))
    placed = with_prefix(df.withColumn("_k", seeded(seed, row_id)), ["_k", row_id], name="draw").drop("_k")
    if n <= total:
        return placed.where(F.col("draw") < n)
    drawn_at = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit("draw"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("bigint")
    extra = df.sparkSession.range(total, n).select(F.col("id").alias("_d"), (drawn_at % total).alias("_t"))
    drawn = placed.join(extra, F.col("draw") == F.col("_t")).withColumn("draw", F.col("_d")).drop("_d", "_t")
    return placed.unionByName(drawn)


def support_set(df: DataFrame, group: str, row_id: str, k: int, seed: int) -> DataFrame:
    """At most ``k`` rows of each group in seeded order with their rank from 1. A group is ranked after every task
    has cut it to its own first ``k``, so no task sees more than ``k`` rows of a group from each other."""
    ranked = lambda d, *by: d.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("_k", row_id))).where(F.col("rank") <= k)
    salted = df.withColumn("_k", seeded(seed, row_id)).withColumn("_s", F.pmod(F.xxhash64(row_id), F.lit(64)))
    return ranked(ranked(salted, group, "_s").drop("rank"), group).drop("_k", "_s")


def samples_in(tokens: int, length: int, extra: int = 1, drop_last: bool = True) -> int:
    """Samples of ``length`` tokens, with ``extra`` shared tokens, in a stream of ``tokens``."""
    n = max(tokens - extra, 0)
    return n // length if drop_last else -(-n // length)


def epochs_needed(tokens: int, length: int, samples: int, extra: int = 1) -> int:
    """Fewest epochs that give ``samples``, at least one."""
    return max(1, -(-(samples * length + extra) // tokens))


def sample_boundaries(documents: DataFrame, order: list[str], size: Column, length: int, extra: int = 1, drop_last: bool = True) -> DataFrame:
    """(sample, document columns in ``order``, offset): where each sample of a stream of documents begins, and where the last ends.

    Boundaries follow from prefix sums in closed form; documents without tokens hold none. Each document explodes to
    the boundaries inside it.
    """
    held = with_prefix(documents.withColumn("n_tokens", size).where("n_tokens > 0"), order, F.col("n_tokens"), "start")
    total = held.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] or 0
    count = samples_in(total, length, extra, drop_last)
    if extra:
        low = F.ceil(F.col("start") / length)
        high = F.floor((F.col("start") + F.col("n_tokens") - 1) / length)
    else:
        low = F.when(F.col("start") == 0, F.lit(0)).otherwise(F.floor(F.col("start") / length) + 1)
        high = F.floor((F.col("start") + F.col("n_tokens")) / length)
    end = F.col("start") + F.col("n_tokens")
    holds_last = (end > total - 1) & (F.col("start") <= total - 1) if extra else (end >= total) & (F.col("start") < total)
    last_start = F.lit(count * length > total - extra) & holds_last
    inside = F.when(F.least(high, F.lit(count)) >= low, F.sequence(low, F.least(high, F.lit(count)))).otherwise(F.array().cast("array<bigint>"))
    own = F.when(last_start, F.array_union(inside, F.array(F.lit(count).cast("bigint")))).otherwise(inside)
    at = F.least(F.col("sample") * length, F.lit(total - extra)) - F.col("start")
    return held.select(*order, "start", F.explode(own).alias("sample")).select("sample", *order, at.alias("offset"))


def chunks(documents: DataFrame, order: list[str], size: Column, length: int) -> DataFrame:
    """(chunk, document columns, from, n): the parts of documents in blocks of ``length`` tokens of their stream; the remainder is dropped."""
    held = with_prefix(documents.withColumn("n_tokens", size).where("n_tokens > 0"), order, F.col("n_tokens"), "start")
    total = held.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] or 0
    whole = total // length
    parts = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("n_tokens") - 1) / length))
    begin = F.greatest(F.col("start"), F.col("chunk") * length)
    end = F.least(F.col("start") + F.col("n_tokens"), (F.col("chunk") + 1) * length)
    return held.select(*order, "start", "n_tokens", F.explode(parts).alias("chunk")).where(F.col("chunk") < whole).select("chunk", *order, (begin - F.col("start")).alias("from"), (end - begin).alias("n"))


def sample_documents(documents: DataFrame, order: list[str], size: Column, length: int, extra: int = 1, filler: int = -100) -> DataFrame:
    """(sample, document_ids, idx): the documents of which each sample of ``length + extra`` tokens has some, in order.

    Both arrays are filled up to the sample's tokens. ``order`` must be one column. A document explodes to the samples it reaches into;
    a sample gathers at most as many documents as it has tokens. Tokens that don't fill a sample are dropped.
    """
    (doc,) = order
    held = with_prefix(documents.withColumn("n_tokens", size).where("n_tokens > 0"), order, F.col("n_tokens"), "start")
    total = held.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] or 0
    count = samples_in(total, length, extra)
    low = F.greatest(F.floor((F.col("start") - length - extra) / length) + 1, F.lit(0))
    high = F.least(F.floor((F.col("start") + F.col("n_tokens") - 1) / length), F.lit(count - 1))
    each = held.where(high >= low).select(F.col(doc).alias("_d"), F.explode(F.sequence(low, high)).alias("sample"))
    fill = lambda c: F.concat(c, F.array_repeat(F.lit(filler).cast("bigint"), F.lit(length + extra) - F.size(c)))
    gathered = each.groupBy("sample").agg(F.sort_array(F.collect_list(F.col("_d").cast("bigint"))).alias("_ids"))
    return gathered.select("sample", fill(F.col("_ids")).alias("document_ids"), fill(F.array(F.col("sample").cast("bigint"))).alias("idx"))


def shuffled(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """``df`` with its position ``pos`` in a seeded order of all rows, whatever the size of a buffer would be."""
    return with_prefix(df.withColumn("_k", seeded(seed, row_id)), ["_k", row_id], name="pos").drop("_k")


def train_validation(df: DataFrame, row_id: str, size: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, validation): seeded; ``size`` over 1 counts rows, below it is a share, rounded up. The two are disjoint and make up ``df``."""
    placed = shuffled(df, row_id, seed)
    n = placed.count()
    held = min(n, int(size) if size > 1 else math.ceil(n * size))
    return placed.where(F.col("pos") >= held).drop("pos"), placed.where(F.col("pos") < held).drop("pos")


def data_module(splits: dict[str, DataFrame]) -> dict[str, DataFrame | dict[str, DataFrame]]:
    """``train_dataset`` and ``eval_dataset`` of named splits: ``validation``, or else every ``validation_<name>`` by name."""
    out: dict = {"train_dataset": splits["train"]} if "train" in splits else {}
    named = {k.removeprefix("validation_"): v for k, v in splits.items() if k.startswith("validation_")}
    held = splits.get("validation", named or None)
    return out if held is None else out | {"eval_dataset": held}


def head_of_groups(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group in an order, with their rank; every task cuts its own part of a group first."""
    ranked = lambda d, *by: d.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("rank") <= n)
    salted = df.withColumn("_s", F.pmod(F.xxhash64(order), F.lit(64)))
    return ranked(ranked(salted, group, "_s").drop("rank"), group).drop("_s")


def seeded_choices(df: DataFrame, row_id: str, counters: int) -> DataFrame:
    """(counter, row_id): for each counter from 0 one row, drawn by the counter as seed; a small number of counters, no sort."""
    picks = [F.min(F.struct(seeded(c, row_id).alias("k"), F.col(row_id).alias("v"))).alias(f"c{c}") for c in range(counters)]
    best = df.agg(*picks).select(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(f"c{c}.v").alias(row_id)) for c in range(counters)]).alias("x"))
    return best.select(F.explode("x").alias("x")).select("x.*").where(F.col(row_id).isNotNull())


def padded_parts(df: DataFrame, ordinal: str, n: int, parts: int) -> DataFrame:
    """``df`` with its ``part`` and ``padding``: parts that are one row short get the row of ordinal 0 once more, marked."""
    own = df.withColumns({"part": even_part(F.col(ordinal), n, parts), "padding": F.lit(False)})
    short = list(range(n % parts, parts)) if n % parts else []
    if not short:
        return own
    more = df.where(F.col(ordinal) == 0).withColumns({"part": F.explode(F.array(*[F.lit(p) for p in short])), "padding": F.lit(True)})
    return own.unionByName(more)


def owner_of(starts: list[int], position: int) -> int:
    """Index of the range that holds a position, of ranges that begin at ``starts``."""
    return bisect_right(starts, position) - 1


def batch_and_rank(position: Column, micro: int, ranks: int) -> tuple[Column, Column]:
    """Global batch and data-parallel rank of a position read in order."""
    size = micro * ranks
    return F.floor(position / size), F.floor((position % size) / micro)


def loader_order(df: DataFrame, row_id: str, kind: str, micro: int, ranks: int, consumed: int = 0, seed: int = 0) -> DataFrame:
    """(row_id, pos, rank) of what is left to read: ``single`` in order, batch by batch; ``cyclic`` in a bucket of each rank's own, shuffled."""
    if kind == "single":
        placed = with_prefix(df.select(row_id), [row_id], name="pos")
        return placed.where(F.col("pos") >= consumed).withColumn("rank", batch_and_rank(F.col("pos"), micro, ranks)[1].cast("int"))
    if kind == "cyclic":
        return bucket_order(df, row_id, consumed, micro, ranks, seed).select(row_id, "pos", "rank")
    raise ValueError(f"unknown kind of loader {kind!r}")


def collated(df: DataFrame, batch: str, ids: str, labels: str, multiple: int, pad: int, left: bool = False) -> DataFrame:
    """``df`` with ids, labels and ``attention_mask`` of each batch filled to its longest row, rounded up to a multiple.

    Batches are of a bounded number of rows. Null ids are none; labels null or too short are filled with -100.
    """
    x = F.coalesce(ids, F.array().cast("array<int>"))
    longest = F.max(F.size(x)).over(Window.partitionBy(batch))
    d = df.withColumns({"_x": x, "_y": F.coalesce(labels, F.array().cast("array<int>"))}).withColumn("_n", (F.ceil(longest / multiple) * multiple).cast("int"))

    def fill(c: str, filler: int) -> Column:
        own = F.slice(F.concat(F.col(c), F.array_repeat(F.lit(filler), F.greatest(F.size("_x") - F.size(c), F.lit(0)))), F.lit(1), F.size("_x"))
        more = F.array_repeat(F.lit(filler), F.col("_n") - F.size("_x"))
        return F.concat(more, own) if left else F.concat(own, more)

    mask = [F.array_repeat(F.lit(1), F.size("_x")), F.array_repeat(F.lit(0), F.col("_n") - F.size("_x"))]
    made = {ids: fill("_x", pad), labels: fill("_y", -100), "attention_mask": F.concat(*(mask[::-1] if left else mask))}
    return d.withColumns(made).drop("_x", "_y", "_n")


def rank_domains(world: int, tensor: int, pipeline: int) -> list[list[int]]:
    """Ranks that read the same part of the data, of a machine of ``world`` ranks: one list for each position in the stages' data parallel groups."""
    stage = world // pipeline
    groups = [list(range(i * stage + j, (i + 1) * stage, tensor)) for i in range(pipeline) for j in range(tensor)]
    return [list(ranks) for ranks in zip(*groups, strict=True)] if groups else []


def rank_of(position: Column, ranks: int) -> Column:
    """Rank of a position dealt out in turn."""
    return position % ranks


def prefix_pointers(df: DataFrame, order: list[str], size: Column, width: int) -> DataFrame:
    """Byte pointers of sequences stored behind one another, ``width`` bytes a token."""
    return with_prefix(df, order, size * width, "pointer")


def bucket_order(df: DataFrame, row_id: str, consumed: int, micro: int, ranks: int, seed: int) -> DataFrame:
    """(rank, row_id, pos) of an epoch in which each rank shuffles its own contiguous bucket, from ``consumed`` samples on."""
    placed = with_prefix(df.select(row_id), [row_id])
    n = placed.count()
    per_rank = n // (micro * ranks) * micro
    epoch, offset = divmod(consumed, max(per_rank * ranks, 1))
    own = placed.withColumn("rank", F.floor(F.col("ord") / max(per_rank, 1)).cast("int")).where(F.col("rank") < ranks).withColumn("_k", seeded(seed + epoch, row_id))
    ordered = with_prefix(own, ["rank", "_k", row_id], name="_g")
    return ordered.withColumn("pos", F.col("_g") - F.col("rank") * per_rank).where(F.col("pos") >= offset // ranks).select("rank", row_id, "pos")
