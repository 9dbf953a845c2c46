"""Documents of several, overlapping sources combined to target shares of tokens, with capped repetition.

A text that came in several sources can stand for any of them. Texts are grouped by membership pattern, the set of
sources that have them with the number of documents in each; a min-cost flow on the driver routes the patterns' tokens to the sources' quotas, where the k-th use
of a pattern costs more than the one before, so nothing is repeated while something fresh would do. Each pattern's texts
then lie behind one another in seeded order on a tape; a source's flow is an interval on it, going round as often as the
flow needs, and a text is used once for every time its start is passed, by its documents of the source in turn. Positions on the tape come from sums over
hash buckets first, then within a bucket, so no task orders a whole source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.flow import Network
from corpusloom.llm.token_counts import VOCABULARY, with_token_counts
from corpusloom.session import checkpointed

#: Patterns that the flow distinguishes; texts of rarer ones are laid out document by document, each with its own source's.
PATTERNS = 5000
#: Texts of a hash bucket of a pattern, about; buckets double until the largest pattern's hold no more. There are 4,096 at least.
TEXTS_PER_BUCKET = 50_000
_PATTERN = "array<struct<source:string,n:bigint>>"
#: Uses of a pattern that have a price of their own; further ones cost alike.
PRICED = 24


@dataclass(frozen=True)
class Target:
    share: float
    most: int | None


#: Sources, or (source, documents of each text) where that isn't one.
Pattern = tuple[str | tuple[str, int], ...]


@dataclass
class Plan:
    """``routes``: pattern -> [(source, first, last)] intervals on the pattern's tape; ``quota``, ``got``: source -> tokens."""

    routes: dict[Pattern, list[tuple[str, int, int]]]
    quota: dict[str, int]
    got: dict[str, int]
    total: int


def _send(sizes: dict[Pattern, int], targets: dict[str, Target], quota: dict[str, int]) -> dict[tuple[Pattern, str], int]:
    patterns, sources = sorted(sizes), sorted(quota)
    node = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    net, arcs = Network(2 + len(patterns) + len(sources)), {}
    for i, p in enumerate(patterns):
        held = [(m, 1) if isinstance(m, str) else m for m in p]
        caps = [None if targets[s].most is None else targets[s].most * n for s, n in held]
        # every document has its source's cap, so a text has the sum of its documents' caps
        most = sum((quota[s] // sizes[p] + 1 if m is None else m) for (s, _), m in zip(held, caps, strict=True))
        for k in range(min(most, PRICED)):
            net.arc(0, 2 + i, sizes[p], k * k)
        if most > PRICED:
            net.arc(0, 2 + i, sizes[p] * (most - PRICED), PRICED * PRICED)
        for (s, _), m in zip(held, caps, strict=True):
            arcs[p, s] = net.arc(2 + i, node[s], min(quota[s], sizes[p] * m) if m is not None else quota[s])
    for s in sources:
        net.arc(node[s], 1, quota[s])
    net.run(0, 1)
    return {k: net.flow(i) for k, i in arcs.items()}


def plan(sizes: dict[Pattern, int], targets: dict[str, Target], total: int) -> Plan:
    """Routes tokens of patterns to sources. Shares are taken relative to their sum.

    What a source can't give (no or too few documents at its cap) is spread over the sources that met their quota, in
    proportion to their shares, so the whole stays as large as wanted while it can.
    """
    sizes = {p: n for p, n in sizes.items() if n > 0}
    whole = sum(t.share for t in targets.values() if t.share > 0)
    shares = {s: t.share / whole for s, t in targets.items() if t.share > 0}
    quota = {s: round(total * v) for s, v in shares.items()}
    flows: dict[tuple[Pattern, str], int] = {}
    got = dict.fromkeys(quota, 0)
    for _ in range(len(quota) + 1):
        flows = _send(sizes, targets, quota)
        got = dict.fromkeys(quota, 0)
        for (_, s), n in flows.items():
            got[s] += n
        short = total - sum(got.values())
        open_ = [s for s in quota if got[s] >= quota[s]]
        if short <= len(quota) or not open_:
            break
        wide = sum(shares[s] for s in open_)
        quota = {s: (quota[s] + int(short * shares[s] / wide) if s in open_ else got[s]) for s in quota}
    routes: dict[Pattern, list[tuple[str, int, int]]] = {}
    at: dict[Pattern, int] = {}
    for (p, s), n in sorted(flows.items()):
        if n:
            a = at.get(p, 0)
            routes.setdefault(p, []).append((s, a, a + n))
            at[p] = a + n
    return Plan(routes, {s: round(total * v) for s, v in shares.items()}, got, total)


def read_targets(targets: DataFrame) -> dict[str, Target]:
    """source -> target, of the rows with a source and a positive share; of a repeated source the largest share counts."""
    rows = targets.where("source IS NOT NULL AND target_share > 0").groupBy("source").agg(F.max(F.struct("target_share", "max_repeat")).alias("t")).collect()
    return {r["source"]: Target(float(r["t"]["target_share"]), None if r["t"]["max_repeat"] is None else max(0, int(r["t"]["max_repeat"]))) for r in rows}


def counted(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, key) of every document, written to the checkpoint folder; ``key`` is of the whole text."""
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), "text")
    return checkpointed(with_token_counts(keyed, "text", ["doc_id", "source", "key"], vocabulary))


def held_by(rows: DataFrame, sources: list[str]) -> DataFrame:
    """The documents of ``sources`` that have tokens."""
    return rows.where(F.col("source").isin(sources) & (F.col("n_tokens") > 0))


def texts_of(held: DataFrame, copies: bool) -> DataFrame:
    """(key, n_tokens, members): every text once, with its sources and its documents in each, one without ``copies``, by source."""
    of_source = held.groupBy("key", "source").agg((F.count("*") if copies else F.max(F.lit(1))).cast("bigint").alias("n"), F.first("n_tokens").alias("n_tokens"))
    return of_source.groupBy("key").agg(F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("members"))


def mixed(documents: DataFrame, targets: DataFrame, seed: int = 1, vocabulary: str = VOCABULARY, copies: bool = False) -> tuple[DataFrame, DataFrame]:
    """The chosen documents, (doc_id, source, repeats, n_tokens), and the report, one row for each target.

    The total is the tokens of all documents. A text that several sources have is used for each at most that source's cap, and its
    uses for them together are spread evenly. With ``copies`` the cap is each document's: a text that a source has in several
    documents is used by all of them in turn. Without, a document that copies an earlier text of its source isn't used
    beside it. Documents without a source, without a target or without tokens are not chosen; a null cap is none, a
    target without documents gets nothing and shows in the report. Ties of hashes are broken by the text's key.
    """
    wanted = read_targets(targets)
    rows = counted(documents, vocabulary)
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    spark = documents.sparkSession
    held = held_by(rows, sorted(wanted))
    texts = texts_of(held, copies).withColumn("pattern", F.col("members"))
    tops = texts.groupBy("pattern").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("texts")).orderBy(F.desc("n"), "pattern").limit(PATTERNS + 1).collect()
    folded = len(tops) > PATTERNS
    if folded:
        kept = F.broadcast(spark.createDataFrame([(list(r["pattern"]),) for r in tops[:PATTERNS]], f"kept {_PATTERN}"))
        rare = F.flatten(F.transform("members", lambda m: F.array_repeat(F.array(F.struct(m["source"].alias("source"), F.lit(1).cast("bigint").alias("n"))), m["n"].cast("int"))))
        texts = texts.join(kept, F.col("pattern") == F.col("kept"), "left").withColumn("pattern", F.explode(F.when(F.col("kept").isNull(), rare).otherwise(F.array("pattern")))).drop("kept")
        tops = texts.groupBy("pattern").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("texts")).collect()
    bits = max(12, math.ceil(math.log2(max([r["texts"] for r in tops], default=1) / TEXTS_PER_BUCKET + 1)))
    texts = texts.withColumn("order", F.xxhash64("key", F.lit(seed))).withColumn("bucket", F.shiftrightunsigned("order", 64 - bits).cast("int"))
    sizes = {tuple((m["source"], m["n"]) for m in r["pattern"]): int(r["n"]) for r in tops}
    p = plan(sizes, wanted, total)
    routes = spark.createDataFrame([(list(k), sizes[k], [(s, a, b) for s, a, b in v]) for k, v in p.routes.items()], f"pattern {_PATTERN}, size bigint, parts array<struct<source:string,first:bigint,last:bigint>>")
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = texts.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("n")).select("pattern", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("pattern", "bucket").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = texts.join(offsets, ["pattern", "bucket"]).withColumn("at", F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    used = placed.join(F.broadcast(routes), "pattern").select("key", "members", "size", "at", F.explode("parts").alias("part"))
    # starts at, at + size, at + 2 size ... that fall into [first, last)
    passed = F.floor((F.col("part.last") - 1 - F.col("at")) / F.col("size")) - F.floor((F.col("part.first") - 1 - F.col("at")) / F.col("size"))
    member = F.element_at(F.filter("members", lambda m: m["source"] == F.col("part.source")), 1)
    uses = used.select("key", F.col("part.source").alias("source"), passed.alias("uses"), member["n"].alias("n")).where("uses > 0")
    if folded:
        uses = uses.groupBy("key", "source").agg(F.sum("uses").alias("uses"), F.first("n").alias("n"))
    # a text's documents take its uses in turn
    ranked = held.withColumn("turn", F.row_number().over(Window.partitionBy("key", "source").orderBy("doc_id")) - 1)
    repeats = F.floor(F.col("uses") / F.col("n")) + F.when(F.col("turn") < F.col("uses") % F.col("n"), 1).otherwise(0)
    chosen = ranked.join(uses, ["key", "source"]).where("turn < n").select("doc_id", "source", repeats.cast("int").alias("repeats"), "n_tokens").where("repeats > 0")
    wide = spark.createDataFrame([(s, t.share, p.quota[s], p.got[s]) for s, t in sorted(wanted.items())] or [], "source string, target_share double, quota bigint, routed bigint")
    given = chosen.groupBy("source").agg(F.count("*").alias("n_documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"))
    has = rows.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    report = F.broadcast(wide).join(given, "source", "left").join(has, "source", "left").na.fill(0, ["n_documents", "most_repeats", "tokens", "available"])
    report = report.withColumn("actual_share", F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy()), F.lit(1))).withColumn("wanted_total", F.lit(total))
    return chosen, report
