"""The whole way from raw records to token tables: read, align, tokenize, leave out what is too long or pack, write, and find again."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import conversations, handlers, knapsack
from corpusloom.operators.ordinals import with_prefix
from corpusloom.sources import files, sinks

#: Handlers that need no aligned dialogue.
RAW = ("general_pretrain", "alpaca_pretrain", "sharegpt_pretrain", "forum_pretrain", "general_instruction", "marked_turns", "role_id_turns", "every_prefix", "code_instruction")


@dataclass(frozen=True)
class Config:
    """``source`` is a file or folder; ``base`` confines relative paths; ``layout`` aligns dialogues unless the handler takes raw records."""

    source: str
    output: str
    handler: str = "general_pretrain"
    layout: str = "alpaca"
    columns: conversations.Mapping | None = None
    keys: tuple[str, ...] = ("input_ids",)
    length: int = 4096
    pack: bool = False
    neat: bool = False
    base: str | None = None
    options: handlers.Options = field(default_factory=handlers.Options)

    def check(self) -> Config:
        """An error if the parts don't fit each other."""
        if self.pack and self.handler in RAW[:4]:
            raise ValueError("texts aren't packed; they are cut into samples when they are read")
        if self.neat and not self.pack:
            raise ValueError("neat packing needs packing")
        if self.length < 2:
            raise ValueError("a length of at least 2 is needed")
        return self


def confined(path: str, base: str | None) -> str:
    """The path, a relative one below ``base``; an error if it leads out of it."""
    if base is None or os.path.isabs(path) or "://" in path:
        return path
    root = os.path.realpath(base)
    full = os.path.realpath(os.path.join(root, path))
    if os.path.commonpath([root, full]) != root:
        raise ValueError(f"{path!r} leads out of {base!r}")
    return full


def token_rows(df: DataFrame, c: Config) -> DataFrame:
    """(row, seq, token columns) of raw records in the order in which they were read."""
    numbered = df.withColumn("row", F.monotonically_increasing_id())
    if c.handler not in RAW:
        m = (c.columns or (conversations.OPENAI if c.layout in ("openai", "chat") else conversations.Mapping())).renamed(extra=("row",))
        numbered = conversations.aligned(numbered, c.layout, m)
    return handlers.tokenized(numbered, c.handler, "row", c.options)


def packed_rows(tokens: DataFrame, c: Config) -> DataFrame:
    """The token rows as packs of ``length``; rows too long are left out, or cut if ``neat``. Rows are numbered, as one record may give several."""
    one = with_prefix(tokens, ["row", "seq"], name="sample")
    return knapsack.packed(one, "sample", c.length, c.options.tokenizer.pad, neat=c.neat)


def pack_statistics(tokens: DataFrame, packs: DataFrame, length: int) -> DataFrame:
    """(samples, fitting, packs): all token rows, those shorter than the length, and the packs made of them; one row."""
    n = packs.count()
    return tokens.agg(F.count("*").alias("samples"), F.count_if((F.size("input_ids") > 0) & (F.size("input_ids") < length)).alias("fitting"), F.lit(n).cast("bigint").alias("packs"))


def preprocess(spark: SparkSession, c: Config) -> list[str]:
    """Runs the way as configured and writes one table for each key, or one of packs; the tables' names. Nothing that exists is overwritten."""
    c.check()
    source, output = confined(c.source, c.base), confined(c.output, c.base)
    tokens = token_rows(files.read_path(spark, source), c)
    if c.pack:
        name = sinks.prefix_of(f"{output}_packed", "all")
        sinks.write_table(packed_rows(tokens, c), name)
        return [name]
    fit = handlers.without_long(tokens, list(c.keys), c.length) if c.handler not in RAW[:4] else tokens
    names = []
    for k in c.keys:
        names.append(sinks.prefix_of(output, k))
        sinks.write_table(fit.select("row", "seq", k), names[-1])
    return names


def output_prefixes(paths: list[str], output: str | None = None) -> dict[str, str]:
    """The prefix under which each raw path's tables are kept: beside it, or below ``output``, with its own name if there are several paths."""
    out = {}
    for path in (p.strip().strip("\"'") for p in paths):
        if not path:
            continue
        if os.path.isdir(path):
            own = os.path.basename(os.path.normpath(path))
            beside = os.path.join(path, own)
        elif os.path.isfile(path):
            beside = os.path.splitext(path)[0]
            own = os.path.basename(beside)
        else:
            raise FileNotFoundError(path)
        out[path] = beside if not output else output if len(paths) == 1 else f"{output}_{own}"
    return out


def converted(spark: SparkSession, paths: list[str], c: Config, output: str | None = None) -> dict[str, list[str]]:
    """Runs ``preprocess`` for every raw path whose tables aren't there yet; the tables of each path."""
    out = {}
    for path, prefix in output_prefixes(paths, output).items():
        names = [sinks.prefix_of(f"{prefix}_packed", "all")] if c.pack else [sinks.prefix_of(prefix, k) for k in c.keys]
        if not all(sinks.is_saved(n) for n in names):
            names = preprocess(spark, Config(**{**c.__dict__, "source": path, "output": prefix}))
        out[path] = names
    return out
