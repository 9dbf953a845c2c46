"""Documents that contain passages of held-out test items.

Documents are searched in two steps. A filter over whole Arrow batches hashes every run of ``least`` words of every
document with a rolling Karp-Rabin hash and keeps the documents in which one of the items' runs occurs: the shared-token
seeds. Only those are tiled: greedy string tiling marks, for each item with a seed, the longest common run first, found by
Karp-Rabin, then the next that doesn't overlap, down to ``least`` words. Tiles that another item has as well don't count.
Items of more than ``ITEM_LIMIT`` bytes are searched in blocks, and what is an item's own is decided for each document over the
matches of all blocks together. One pass over all documents before that keeps those in which a bit filter of bounded size, made of the runs of all
items, has a run; only they are written and searched block by block. The filter lets some documents too many through and none too few.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checkpointed

#: Words of the shortest run that counts as a leak.
LEAST = 12
#: UTF-8 bytes of item texts that are sent to the tasks at once; more are searched in as many blocks. Their index takes about four times as many.
ITEM_LIMIT = 16 << 20

#: Bits of the filter of all items' runs, as a power of two, at most; and bits that each run sets.
FILTER_POWER, PROBES = 29, 6
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)

_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i", "ſ": "s"}
# A word broken at a line's end: the hyphen, the break and whatever marks the next line's start.
_BROKEN = re.compile("(?<=[^\\W\\d_])[-‐‑¬][^\\S\\r\\n\\x0b\\x0c\\x85\\u2028\\u2029]*(?:\\r\\n|[\\r\\n\\x0b\\x0c\\x85\\u2028\\u2029])[^\\w\\n]*(?=[^\\W\\d_])")
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
_WORD = re.compile("[^\\W_]+")
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def words(text: str | None) -> list[str]:
    """The words of a text: letters and digits, whatever their case, accents, ligatures and width.

    A word broken by a hyphen at a line's end is one word, whatever marks the next line begins with.
    """
    if not text:
        return []
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
        if not text.isascii():
            text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    if "-" in text or not text.isascii():
        text = _BROKEN.sub("", text)
    text = text.casefold()
    if not text.isascii():
        for letter, spelled in _LETTERS.items():
            if letter in text:
                text = text.replace(letter, spelled)
    return _WORD.findall(text)


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` codes, as uint64."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # hash of a run = hash of its first half times a power plus that of its second: log(length) passes
    powers = {1: _BASE}
    level, size = codes.astype(np.uint64), 1
    out, done = None, 0
    k = length
    while k:
        if k & 1:
            part = level[done : done + n]
            out = part.copy() if out is None else out * np.uint64(powers[size]) + part
            done += size
        k >>= 1
        if k:
            powers[2 * size] = powers[size] * powers[size] & _MASK
            level = level[: len(level) - size] * np.uint64(powers[size]) + level[size:]
            size *= 2
    return out


@dataclass
class Items:
    """Texts of test items as word codes, with an index of the hashes of all runs of ``least`` words.

    The texts lie behind one another in ``words_of``, text k from ``begins[k]`` on; ``seeds`` are the runs' hashes in order, ``at`` where
    each run begins in ``words_of``, and ``text_of`` whose text it is. All are arrays, 20 bytes a word.
    """

    least: int
    owner: np.ndarray
    codes: dict[str, int]
    words_of: np.ndarray
    begins: np.ndarray
    seeds: np.ndarray
    at: np.ndarray
    text_of: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]], least: int) -> Items:
        """``rows``: (item id, text); texts shorter than ``least`` words can't leak."""
        codes: dict[str, int] = {}
        owner, texts = [], []
        for item, text in rows:
            seq = words(text)
            if len(seq) >= least:
                owner.append(item)
                texts.append(np.array([codes.setdefault(w, len(codes) + 1) for w in seq], np.uint32))
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        hashes = [run_hashes(mixed(t.astype(np.uint64)), least) for t in texts]
        none = np.zeros(0, np.uint64)
        seeds = np.concatenate([none, *hashes])
        at = np.concatenate([none, *[np.arange(len(h)) + b for h, b in zip(hashes, begins, strict=False)]]).astype(np.int64)
        text_of = np.repeat(np.arange(len(texts), dtype=np.int32), [len(h) for h in hashes])
        order = np.argsort(seeds, kind="stable")
        return cls(least, np.array(owner, object), codes, np.concatenate([np.zeros(0, np.uint32), *texts]), begins, seeds[order], at[order].astype(np.int32 if len(at) < 1 << 31 else np.int64), text_of[order])

    def seeded(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are of a run of some item."""
        if not len(self.seeds):
            return np.zeros(len(hashes), bool)
        i = np.searchsorted(self.seeds, hashes)
        return self.seeds[np.minimum(i, len(self.seeds) - 1)] == hashes

    def text(self, k: int) -> np.ndarray:
        return self.words_of[self.begins[k] : self.begins[k + 1]]

    def meetings(self, document: np.ndarray, hashes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """text -> [(position in the document, in the text)] of the runs at ``document`` whose hashes are given."""
        low, high = np.searchsorted(self.seeds, hashes), np.searchsorted(self.seeds, hashes, side="right")
        n = high - low
        # all meetings behind one another: the n-th run of equal hash for each position
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        texts = self.text_of[at]
        pairs = np.stack([np.repeat(document, n), self.at[at] - self.begins[texts]], 1)
        order = np.argsort(texts, kind="stable")
        cuts = np.flatnonzero(np.diff(texts[order])) + 1
        return {int(texts[g[0]]): [tuple(p) for p in pairs[g].tolist()] for g in np.split(order, cuts) if len(g)}


def mixed(codes: np.ndarray) -> np.ndarray:
    """Codes spread over 64 bits."""
    z = (codes + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(31))


class WordCodes(dict):
    """64 bits of each word, whatever the vocabulary; kept for words that recur."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = code = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return code


class RunFilter:
    """Which runs of ``least`` words some item has, with few wrong yes and no wrong no."""

    def __init__(self, texts: Iterator[str | None], runs: int, least: int) -> None:
        self.least, self.power = least, max(10, min(FILTER_POWER, int(np.ceil(np.log2(max(runs, 1) * 12)))))
        flags, codes = np.zeros(1 << self.power, bool), WordCodes()
        for text in texts:
            hashes = self._hashes(text, codes)
            for f in _FACTORS[:PROBES]:
                flags[(hashes * f) >> np.uint64(64 - self.power)] = True
        self.bits = np.packbits(flags)

    def _hashes(self, text: str | None, codes: WordCodes) -> np.ndarray:
        seq = words(text)
        return run_hashes(np.fromiter(map(codes.__getitem__, seq), np.uint64, len(seq)), self.least)

    def any(self, text: str | None, codes: WordCodes) -> bool:
        hashes = self._hashes(text, codes)
        for f in _FACTORS[:PROBES]:
            at = (hashes * f) >> np.uint64(64 - self.power)
            hashes = hashes[(self.bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1]
            if not len(hashes):
                return False
        return True


def tiles(document: np.ndarray, text: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (position in document, in text, length) of the longest common runs that don't overlap.

    ``seeds`` are pairs of positions at which runs of ``least`` words agree. Each is grown to its maximal match; the longest
    is marked first (of equal ones the first in the document, then in the text), and what is left of the others is
    tried again as long as it has ``least`` words.
    """
    heap, at = [], set(seeds)
    for d, t in at:
        if (d - 1, t - 1) in at:
            continue
        m = min(len(document) - d, len(text) - t)
        differ = np.flatnonzero(document[d : d + m] != text[t : t + m])
        n = int(differ[0]) if len(differ) else m
        if n >= least:
            heapq.heappush(heap, (-n, d, t))
    in_document, in_text = np.zeros(len(document), bool), np.zeros(len(text), bool)
    out = []
    while heap:
        n, d, t = heapq.heappop(heap)
        n = -n
        taken = np.flatnonzero(in_document[d : d + n] | in_text[t : t + n])
        if not len(taken):
            in_document[d : d + n] = in_text[t : t + n] = True
            out.append((d, t, n))
            continue
        edges = np.concatenate([[-1], taken, [n]])
        for a, b in zip(edges[:-1] + 1, edges[1:], strict=True):
            if b - a >= least:
                heapq.heappush(heap, (-int(b - a), d + int(a), t + int(a)))
    return sorted(out)


def matches(document: np.ndarray, hits: np.ndarray, hashes: np.ndarray, items: Items) -> tuple[list[tuple[int, int, list[tuple[int, int]]]], list[tuple[int, int, int]]]:
    """[(item, words of the text, [(position in document, length) of its tiles])] and [(first, end, item)] of all maximal runs."""
    places = np.flatnonzero(hits)
    by = items.meetings(places, hashes[places])
    marked = [(items.owner[k], len(items.text(k)), [(d, n) for d, _, n in tiles(document, items.text(k), seeds, items.least)]) for k, seeds in by.items()]
    spans: list[tuple[int, int, int]] = []
    for k, seeds in by.items():
        # maximal runs of every item, tiled or not, decide what is an item's own
        at = set(seeds)
        for d, t in seeds:
            if (d - 1, t - 1) in at:
                continue
            own = items.text(k)
            m = min(len(document) - d, len(own) - t)
            differ = np.flatnonzero(document[d : d + m] != own[t : t + m])
            n = int(differ[0]) if len(differ) else m
            if n >= items.least:
                spans.append((d, d + n, items.owner[k]))
    return marked, spans


def owned(marked: list[tuple[int, int, list[tuple[int, int]]]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(item, words of its longest own tile, words of its tiles, share of its text covered) of a document's ``matches``.

    A tile counts if no other item has the very same run of words.
    """
    out: dict[int, list[float]] = {}
    for item, size, found in marked:
        own = [n for d, n in found if not any(a <= d and d + n <= b and o != item for a, b, o in spans)]
        if own:
            old = out.get(item, [0, 0, 0.0])
            out[item] = [max(old[0], *own), old[1] + sum(own), max(old[2], sum(own) / size)]
    return [(item, int(a), int(b), float(c)) for item, (a, b, c) in sorted(out.items())]


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("longest", pa.int32()), ("words", pa.int32()), ("share", pa.float64())])
_DDL = "doc_id bigint, item_id bigint, longest int, words int, share double"
_MATCHES = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("found", pa.binary())])


def _search(items: Items, whole: bool = True):
    """Rows of (doc_id, text, row) to what leaked, or, if the items aren't the ``whole``, to each row's pickled ``matches``."""
    schema = _FOUND if whole else _MATCHES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, least = items.codes, items.least
        get = code.get
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            rows: list[tuple] = []
            for i, text in enumerate(texts):
                seq = words(text)
                if len(seq) < least:
                    continue
                coded = np.fromiter(map(get, seq, repeat(0)), np.uint64, len(seq))
                # a foreign word ends every run: no run without one, no seed
                foreign = np.flatnonzero(coded == 0)
                if len(foreign) and np.diff(foreign, prepend=-1, append=len(coded)).max() <= least:
                    continue
                hashes = run_hashes(mixed(coded), least)
                hits = items.seeded(hashes)
                if hits.any():
                    found = matches(coded, hits, hashes, items)
                    if whole:
                        rows += [(ids[i].as_py(), *x) for x in owned(*found)]
                    else:
                        rows.append((b.column(2)[i].as_py(), ids[i].as_py(), pickle.dumps(found)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _decide(frame: pd.DataFrame) -> pd.DataFrame:
    """What leaked into one document, from its matches in every block."""
    marked, spans = [], []
    for found in frame["found"]:
        m, s = pickle.loads(found)
        marked += m
        spans += s
    rows = [(frame["doc_id"].iloc[0], *x) for x in owned(marked, spans)]
    return pd.DataFrame(rows, columns=_FOUND.names).astype({"doc_id": "Int64", "item_id": "Int64"})


def leaked_items(documents: DataFrame, items: DataFrame, texts: tuple[str, ...] = ("passage", "question"), least: int = LEAST, coverage: float = 0.0, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, longest, words, share): documents with a run of at least ``least`` words that one item alone has.

    ``longest`` and ``words`` are the words of the item's longest own tile and of all of them, in any order; ``share`` is the
    part of the item's best text that they cover, of which at least ``coverage`` is required. Null and short texts on either side
    match nothing, repeated documents count each, runs within one item may repeat, and empty tables give no rows.
    """
    size = items.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_LIMIT))
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where(F.length("text") >= 2 * least - 1)
    held = items.select(F.col(item_id).cast("bigint").alias("item_id"), *texts)
    block = lambda k: held if blocks == 1 else held.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
    if blocks > 1:
        # a word takes two bytes at least, so there are at most half as many runs as bytes
        runs = documents.sparkSession.sparkContext.broadcast(RunFilter((t for k in range(blocks) for r in block(k).toLocalIterator() for t in r[1:]), size // 2, least))

        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes = WordCodes()
            for b in batches:
                yield b.filter(pa.array([runs.value.any(t, codes) for t in b.column(1).to_pylist()], pa.bool_()))

        rows = rows.mapInArrow(likely, "doc_id bigint, text string")
        # one number for each row, as ids may repeat; written, as numbers of rows read again could differ
        rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()))
    out = None
    for k in range(blocks):
        index = Items.of([(r[0], t) for r in block(k).collect() for t in r[1:]], least)
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            return _search(shared.value, blocks == 1)(batches)

        found = rows.mapInArrow(run, _DDL if blocks == 1 else "row bigint, doc_id bigint, found binary")
        out = found if out is None else out.unionByName(found)
    if blocks > 1:
        out = out.groupBy("row").applyInPandas(_decide, _DDL)
    return out.where(F.col("share") >= coverage)
