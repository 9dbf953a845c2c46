"""Token counts of texts by a public byte-pair vocabulary, whose file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranks of a byte-level BPE, on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the vocabulary's texts are split before merging (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoding(vocabulary: str):
    """The tokenizer of a file of ranks, built once for each Python worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(vocabulary).read_bytes().splitlines() if line)}
    return tiktoken.Encoding(Path(vocabulary).stem, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``, the tokens of the whole ``text``; 0 for null and empty texts."""
    fields = df.select(*keep).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(vocabulary).encode_ordinary
        for b in batches:
            counts = [len(tokens(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(counts, pa.int64())], names=[*keep, "n_tokens"])

    return df.select(*keep, F.col(text)).mapInArrow(run, f"{ddl}, n_tokens bigint")
