"""Documents of sentences cut into blocks of about a target length, in one fold over each document's sentence sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.operators.ordinals import with_prefix

#: Documents with a longer sentence give no blocks.
LONG_SENTENCE = 512


def _blocks(sizes: Column, target: Column, fewest: int, left: int, short: Column | None, seed: int, doc: Column) -> Column:
    """(first, last, target) of each block: it ends when it is long enough and at least ``left`` sentences remain, or at the end.

    ``short`` is the share of blocks whose target is drawn between 2 and the greatest from a hash of document and first sentence.
    """
    none = F.array().cast("array<struct<first:int,last:int,target:int>>")

    def goal(first: Column) -> Column:
        if short is None:
            return target
        # draws by MD5, which any engine can compute
        drawn = lambda what: F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit(what), doc.cast("string"), first.cast("string"))), 1, 12), 16, 10).cast("bigint")
        return F.when(drawn("short") % 1_000_000 < short * 1_000_000, 2 + drawn("size") % (target - 1)).otherwise(target).cast("int")

    start = F.struct(F.lit(0).alias("first"), F.lit(0).alias("length"), none.alias("out"))

    def step(s: Column, x: Column) -> Column:
        length, count, remain = s["length"] + x["n"], x["i"] + 1 - s["first"], F.size(sizes) - x["i"] - 1
        ends = ((length >= goal(s["first"])) & (remain >= left) & (count >= fewest)) | (remain == 0)
        block = F.struct(s["first"].alias("first"), (x["i"] + 1).alias("last"), goal(s["first"]).alias("target"))
        return F.when(ends, F.struct((x["i"] + 1).alias("first"), F.lit(0).alias("length"), F.concat(s["out"], F.array(block)).alias("out"))).otherwise(F.struct(s["first"].alias("first"), length.alias("length"), s["out"].alias("out")))

    numbered = F.transform(sizes, lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    fits = (F.size(sizes) >= fewest) & ~F.exists(sizes, lambda n: n > LONG_SENTENCE)
    return F.when(fits, F.aggregate(numbered, start, step, lambda s: s["out"])).otherwise(none)


def sentence_blocks(df: DataFrame, doc: str, sizes: str, target: int, fewest: int = 2, short: float = 0.0, seed: int = 1) -> DataFrame:
    """(doc, block, first, last, target): spans [first, last) of sentences of about ``target`` tokens.

    Documents of fewer than ``fewest`` sentences, or with a very long one, give none; a share ``short`` of the blocks aims at fewer tokens.
    """
    made = _blocks(F.col(sizes), F.lit(target), fewest, 2, F.lit(short) if short else None, seed, F.col(doc))
    return df.select(doc, F.posexplode(made).alias("block", "b")).select(doc, "block", "b.*")


def titled_blocks(df: DataFrame, doc: str, sizes: str, title: str, longest: int, single: bool = False) -> DataFrame:
    """(doc, first, last, block_id): spans of sentences that fit beside their document's title; ids count over all documents."""
    fewest = 1 if single else 2
    made = _blocks(F.col(sizes), F.lit(longest) - F.col(title), fewest, fewest, None, 0, F.col(doc))
    rows = df.select(doc, F.posexplode(made).alias("k", "b")).select(doc, "k", F.col("b.first").alias("first"), F.col("b.last").alias("last"))
    return with_prefix(rows, [doc, "k"], name="block_id").drop("k")


def sentence_sizes(c: Column) -> Column:
    """UTF-8 bytes of each sentence of a text."""
    from corpusloom.functions.text import sentences

    return let(sentences(c), lambda parts: F.transform(parts, lambda s: F.octet_length(s)))
