"""Tokenizers behind one protocol; the default needs no files: a UTF-8 byte is its own id, special tokens follow from 256."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache
from typing import Protocol

# Ids of the byte tokenizer's special tokens (fixed values).
SPECIAL = {"bos": 256, "eos": 257, "pad": 258, "eod": 259, "user": 260, "assistant": 261, "system": 262}


class Tokenizer(Protocol):
    bos: int | None
    eos: int
    pad: int
    eod: int
    size: int

    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...

    def token(self, name: str) -> int: ...


@dataclass(frozen=True)
class ByteTokenizer:
    bos: int | None = SPECIAL["bos"]
    eos: int = SPECIAL["eos"]
    pad: int = SPECIAL["pad"]
    eod: int = SPECIAL["eod"]
    size: int = 263

    def encode(self, text: str) -> list[int]:
        return list(text.encode("utf-8", "replace"))

    def decode(self, ids: list[int]) -> str:
        return bytes(i for i in ids if 0 <= i < 256).decode("utf-8", "replace")

    def token(self, name: str) -> int:
        """Id of a special token's text; unknown ones fall on a fixed id behind the special tokens."""
        return SPECIAL.get(name.strip("<|>"), self.size)


@dataclass(frozen=True)
class FileTokenizer:
    """A vocabulary in a file of the ``tokenizers``, ``tiktoken`` or ``sentencepiece`` libraries, by its suffix."""

    path: str
    bos: int | None = None
    eos: int = 0
    pad: int = 0
    eod: int = 0
    size: int = field(default=0)

    def encode(self, text: str) -> list[int]:
        return _loaded(self.path)[0](text)

    def decode(self, ids: list[int]) -> str:
        return _loaded(self.path)[1](ids)

    def token(self, name: str) -> int:
        ids = self.encode(name)
        if len(ids) != 1:
            raise ValueError(f"{name!r} is not one token")
        return ids[0]


@cache
def _loaded(path: str):
    if path.endswith(".json"):
        from tokenizers import Tokenizer as Fast

        t = Fast.from_file(path)
        return (lambda s: t.encode(s, add_special_tokens=False).ids), t.decode
    if path.endswith(".model"):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda s: p.encode(s)), p.decode
    if path.endswith(".tiktoken"):
        import base64
        from pathlib import Path

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in Path(path).read_bytes().splitlines() if x)}
        e = tiktoken.Encoding(Path(path).stem, pat_str=r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=ranks, special_tokens={})
        return e.encode_ordinary, e.decode
    raise ValueError(f"unknown kind of vocabulary: {path}")


def padded_vocabulary(size: int, multiple: int = 128) -> int:
    """The size rounded up to a multiple."""
    return -(-size // multiple) * multiple


def single_token(tokenizer: Tokenizer, text: str) -> int:
    """The id of a text that must be one token."""
    ids = tokenizer.encode(text)
    if len(ids) != 1:
        raise ValueError(f"{text!r} is {len(ids)} tokens")
    return ids[0]
