"""Greedy packing of samples into rows of one length, and cuts of samples that are too long.

The greedy rule takes the longest sample left that fits, so its result depends on how many samples there are of each length and
on nothing else. The plan is made from that histogram, of at most as many rows as the length; samples join their slots
by (length, rank among equals). Batches, if any, are packed apart, each in one task.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.arrays import IGNORE, inferred_lengths, prompt_runs
from corpusloom.session import checkpointed, shuffle_width


def greedy_runs(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Packs as (pattern, how often it recurs); a pattern lists (length, number) from the longest down.

    A pattern recurs until one of its lengths runs short, so there are about as many as there are lengths.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if left and max(left) > capacity:
        raise ValueError("a sample is longer than a pack")
    if 0 in left:
        raise ValueError("a sample has no tokens")
    lengths, out = sorted(left), []
    while lengths:
        room, pattern, end = capacity, [], len(lengths)
        while (i := bisect_right(lengths, room, 0, end) - 1) >= 0:
            n = lengths[i]
            take = min(left[n], room // n)
            pattern.append((n, take))
            room, end = room - take * n, i
        often = min(left[n] // take for n, take in pattern)
        for n, take in pattern:
            left[n] -= take * often
        lengths = [n for n in lengths if left[n]]
        out.append((pattern, often))
    return out


def greedy(histogram: dict[int, int], capacity: int) -> list[list[int]]:
    """Lengths of each pack in the order they go in: the longest that fits, again and again."""
    return [[n for n, take in pattern for _ in range(take)] for pattern, often in greedy_runs(histogram, capacity) for _ in range(often)]


_SEGMENT = "struct<first:bigint,last:bigint,pack:bigint,slot:int,each:int,at:int>"


def _segments(histogram: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int, int, int, int]]]:
    """For each length the ranks [first, last) that go, ``each`` to a pack, into packs from ``pack`` at ``slot`` and token ``at``."""
    out: dict[int, list] = {}
    seen: dict[int, int] = {}
    pack = 0
    for pattern, often in greedy_runs(histogram, capacity):
        slot = at = 0
        for n, take in pattern:
            first = seen.get(n, 0)
            seen[n] = first + take * often
            out.setdefault(n, []).append((first, seen[n], pack, slot, take, at))
            slot, at = slot + take, at + take * n
        pack += often
    return out


def slots(samples: DataFrame, length: str, order: str, capacity: int) -> DataFrame:
    """``samples`` with ``pack``, ``slot`` and ``at``; of equal lengths the last in ``order`` goes first. Lengths lie in 1..capacity.

    A length that a large share of samples has is ranked in ranges of ``order``, so no task ranks it alone. What is broadcast
    has at most a row for each length.
    """
    spark = samples.sparkSession
    histogram = {r["n"]: r["c"] for r in samples.groupBy(F.col(length).cast("int").alias("n")).agg(F.count("*").alias("c")).collect()}
    plan = F.broadcast(spark.createDataFrame([(n, v) for n, v in _segments(histogram, capacity).items()], f"_n int, _s array<{_SEGMENT}>"))
    parted = checkpointed(samples.withColumn("_n", F.col(length).cast("int")).repartitionByRange(shuffle_width(spark), "_n", F.desc(order)).withColumn("_p", F.spark_partition_id()))
    sizes = parted.groupBy("_n", "_p").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("_n").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_n", "_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    own = F.row_number().over(Window.partitionBy("_n", "_p").orderBy(F.desc(order))) - 1
    ranked = parted.withColumn("_r", own).join(offsets, ["_n", "_p"]).withColumn("_r", F.col("_r") + F.col("_o"))
    found = ranked.join(plan, "_n").withColumn("_g", F.element_at(F.filter("_s", lambda g: (g["first"] <= F.col("_r")) & (F.col("_r") < g["last"])), 1))
    k, each = F.col("_r") - F.col("_g.first"), F.col("_g.each")
    return found.withColumns({"pack": F.col("_g.pack") + F.floor(k / each), "slot": (F.col("_g.slot") + k % each).cast("int"), "at": (F.col("_g.at") + k % each * F.col("_n")).cast("int")}).drop("_n", "_p", "_o", "_r", "_s", "_g")


def batch_slots(samples: DataFrame, length: str, order: str, capacity: int, batch: str) -> DataFrame:
    """(batch, order, pack, slot): as ``slots``, each batch of a bounded number of samples by itself."""
    kinds = {f.name: f.dataType.simpleString() for f in samples.schema}

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([length, order], ascending=[True, False], ignore_index=True)
        rank = frame.groupby(length).cumcount()
        plan = _segments(frame[length].value_counts().to_dict(), capacity)
        packs, places = [], []
        for n, r in zip(frame[length], rank, strict=True):
            g = next(g for g in plan[n] if g[0] <= r < g[1])
            packs.append(g[2] + (r - g[0]) // g[4])
            places.append(g[3] + (r - g[0]) % g[4])
        return pd.DataFrame({batch: frame[batch], order: frame[order], "pack": packs, "slot": places})

    return samples.select(batch, order, length).groupBy(batch).applyInPandas(run, f"`{batch}` {kinds[batch]}, `{order}` {kinds[order]}, pack bigint, slot int")


def packed(samples: DataFrame, sample_id: str, length: int, pad: int, neat: bool = False, extra: int = 0, batch: str | None = None, with_positions: bool = False) -> DataFrame:
    """Rows of exactly ``length + extra`` tokens of samples with ``input_ids`` and ``labels``, each shorter than ``length``.

    The capacity is ``length`` with ``extra`` of one, ``length - 1`` without. Masks number the segments from 1 and are 0 over the padding
    if ``neat``, else 1 throughout. Longer samples are left out unless ``neat``, which cuts them to ``length - 1``.
    """
    capacity = length if extra else length - 1
    n = F.size("input_ids")
    fit = samples.where(n > 0)
    if neat and not extra:
        fit = fit.withColumn("input_ids", F.slice("input_ids", 1, capacity)).withColumn("labels", F.slice("labels", 1, capacity))
    fit = fit.withColumn("_len", F.size("input_ids")).where(F.col("_len") <= capacity)
    sizes = fit.select(sample_id, "_len", *([batch] if batch else []))
    where = batch_slots(sizes, "_len", sample_id, capacity, batch) if batch else slots(sizes, "_len", sample_id, capacity)
    placed = fit.join(where.drop("_len", "at"), [sample_id, *([batch] if batch else [])])
    keys = [*([batch] if batch else []), "pack"]
    parts = F.sort_array(F.collect_list(F.struct("slot", "input_ids", "labels")))
    rows = placed.groupBy(*keys).agg(parts.alias("p"))
    used = F.size(F.flatten("p.input_ids"))
    fill = F.lit(length + extra) - used
    marks = F.flatten(F.transform("p", lambda x, i: F.transform(x["input_ids"], lambda _: (i + 1) if neat else F.lit(1))))
    out = [
        F.concat(F.flatten("p.input_ids"), F.array_repeat(F.lit(pad), fill)).alias("input_ids"),
        F.concat(marks, F.array_repeat(F.lit(0 if neat else 1), fill)).alias("attention_mask"),
        F.concat(F.flatten("p.labels"), F.array_repeat(F.lit(IGNORE), fill)).alias("labels"),
    ]
    if with_positions:
        out.append(F.concat(F.flatten(F.transform("p", lambda x: F.transform(x["input_ids"], lambda _, j: j))), F.array_repeat(F.lit(0), fill)).alias("position_ids"))
    return rows.select(*keys, F.size("p").alias("n_samples"), used.alias("n_tokens"), *out)


def plain_cut(c: Column, length: int) -> Column:
    """The first ``length`` tokens."""
    return F.slice(c, F.lit(1), F.lit(length))


def cut_pairwise(df: DataFrame, length: int) -> DataFrame:
    """Chosen and rejected samples cut together: the prompt against the longer of the two answers."""
    prompt = F.coalesce(F.array_position(F.transform("chosen_labels", lambda x: x != IGNORE), True) - 1, F.size("chosen_labels")).cast("int")
    d = df.withColumn("_p", prompt)
    longest = F.greatest(F.size("chosen_input_ids"), F.size("rejected_input_ids")) - F.col("_p")
    source, target = inferred_lengths(F.col("_p"), longest, length)
    d = d.withColumn("_s", source).withColumn("_t", target)
    out = []
    for side in ("chosen", "rejected"):
        ids = F.concat(F.slice(f"{side}_input_ids", F.lit(1), F.col("_s")), F.slice(f"{side}_input_ids", F.col("_p") + 1, F.col("_t")))
        labels = F.concat(F.array_repeat(F.lit(IGNORE), F.col("_s")), F.slice(f"{side}_input_ids", F.col("_p") + 1, F.col("_t")))
        out += [ids.alias(f"{side}_input_ids"), labels.alias(f"{side}_labels")]
    keep = [c for c in df.columns if c not in ("chosen_input_ids", "chosen_labels", "rejected_input_ids", "rejected_labels")]
    return d.select(*keep, *out)


def cut_turns(df: DataFrame, length: int) -> DataFrame:
    """Samples over ``length`` cut turn by turn: each prompt run of -100 with the answer behind it shares the room left."""
    runs = F.transform(prompt_runs(F.col("labels")), lambda r: F.struct(r["begin"].alias("a"), F.coalesce(r["end"], F.size("labels")).alias("b")))
    full = F.transform(runs, lambda r, i: F.struct(r["a"].alias("a"), r["b"].alias("b"), F.coalesce(F.get(runs, i + 1)["a"], F.size("labels")).alias("c")))
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("used"), none.alias("x"), none.alias("y"))

    def step(s, r):
        source, target = inferred_lengths(r["b"] - r["a"], r["c"] - r["b"], F.lit(length) - s["used"])
        source, target = source.cast("int"), target.cast("int")
        part = lambda c, at, n: F.slice(F.col(c), at + 1, n)
        more = F.struct((s["used"] + source + target).alias("used"), F.concat(s["x"], part("input_ids", r["a"], source), part("input_ids", r["b"], target)).alias("x"), F.concat(s["y"], part("labels", r["a"], source), part("labels", r["b"], target)).alias("y"))
        return F.when(s["used"] >= length, s).otherwise(more)

    cut = F.aggregate(full, start, step)
    long = F.col("_c").isNotNull()
    return df.withColumn("_c", F.when(F.size("input_ids") > length, cut)).withColumns({"input_ids": F.when(long, F.col("_c.x")).otherwise(F.col("input_ids")), "labels": F.when(long, F.col("_c.y")).otherwise(F.col("labels"))}).drop("_c")


def pairwise_rows(df: DataFrame, row_id: str) -> DataFrame:
    """All chosen samples and, behind them, all rejected ones."""
    side = lambda k, name: df.select(F.lit(k).alias("side"), row_id, F.col(f"{name}_input_ids").alias("input_ids"), F.col(f"{name}_labels").alias("labels"))
    return side(0, "chosen").unionByName(side(1, "rejected"))
