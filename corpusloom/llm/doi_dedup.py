"""Records that differ only in formatting: canonical keys, external sort, scan of adjacent runs.

Plan: one projection computes the canonical key on Arrow batches and writes (key, id) to the checkpoint folder, as both the
sample for the bounds and the shuffle read it; rows are range-partitioned by
(key, id), so that a key holding any share of the rows spreads over as many partitions as it needs; each
partition is sorted externally by Spark and written to the checkpoint folder; the scan then walks adjacent
rows, comparing full keys. What crosses a partition border is settled from one summary per partition
(two keys and two ids each, as many as there are shuffle partitions).
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.session import checkpointed, shuffle_width

# Pairs of an object that neither JSON nor Python can read, such as ``{doi=10.1/x, id=3}``.
_PAIR = re.compile(r"""["']?(\w+)["']?\s*[:=]\s*(.*?)(?=[,;]\s*["']?\w+["']?\s*[:=]|\}\s*$)""", re.S)
# Escapes that stand for punctuation or invisible characters.
_ESCAPES = r"%2[0-9A-Fa-f]|\\u[0-9a-fA-F]{4}|\\[nrt]"
_DOI = r"(?P<doi>10\pN{4}.*)"


def _letters(texts: pa.Array) -> pa.Array:
    """Letters and digits only, lower case; an escape counts as punctuation."""
    if pc.any(pc.match_substring_regex(texts, r"[%\\]")).as_py():
        texts = pc.replace_substring_regex(texts, _ESCAPES, " ")
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", "")


def _from_doi(words: pa.Array) -> pa.Array:
    """From the first DOI on, null without one."""
    return pc.struct_field(pc.extract_regex(words, _DOI), "doi")


def _leaves(value, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
    """(path, text) of every value in an object; lists count their places."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from _leaves(inner, (*path, str(name)))
    elif isinstance(value, (list, tuple)):
        for k, inner in enumerate(value):
            yield from _leaves(inner, (*path, str(k)))
    else:
        yield path, "null" if value is None else str(value)


def _fields(text: str) -> list[tuple[tuple[str, ...], str]]:
    """(path, text) of the values of an object as JSON, Python or a map writes it; nested ones with their whole path."""
    text = text[text.index("{") :].strip()
    for read in (json.loads, ast.literal_eval):
        try:
            found = read(text)
        except (ValueError, SyntaxError, RecursionError, MemoryError, TypeError):
            continue
        if isinstance(found, dict):
            return list(_leaves(found))
    return [((name,), "null" if value.strip() == "None" else value) for name, value in _PAIR.findall(text)]


def _object_keys(texts: pa.Array) -> list[str | None]:
    """Keys of objects: their fields, compared likewise, in the order of names; null if no value holds a DOI."""
    fields = [_fields(t) for t in texts.to_pylist()]
    flat = [x for f in fields for x in f]
    if not flat:
        return [None] * len(fields)
    steps = _letters(pa.array([step for path, _ in flat for step in path], pa.string())).to_pylist()
    names, at = [], 0
    for path, _ in flat:
        names.append(".".join(steps[at : at + len(path)]))
        at += len(path)
    words = _letters(pa.array([v.encode("utf-8", "replace").decode() for _, v in flat], pa.string()))
    dois = _from_doi(words)
    values, held, at, out = pc.coalesce(dois, words).to_pylist(), dois.is_valid().to_pylist(), 0, []
    for f in fields:
        end = at + len(f)
        out.append("o:" + "|".join(sorted(f"{n}={v}" for n, v in zip(names[at:end], values[at:end], strict=True))) if any(held[at:end]) else None)
        at = end
    return out


def doi_keys(texts: pa.Array) -> pa.Array:
    """Canonical keys of an array of DOI fields; see ``doi_key``."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    plain = pc.binary_join_element_wise(pa.scalar("d:"), _from_doi(_letters(texts)), "")
    objects = pc.fill_null(pc.match_substring_regex(texts, r"(?s)\{.*[:=].*\}\s*$"), False)
    if not pc.any(objects).as_py():
        return plain
    return pc.replace_with_mask(plain, objects, pa.array(_object_keys(texts.filter(objects)), pa.string()))


def doi_key(c: Column) -> Column:
    """Canonical key of a DOI field: ``d:`` and the DOI's letters and digits, or ``o:`` and an object's sorted pairs.

    Null where the field is null or holds no DOI (``10`` and at least four digits). An object that holds no DOI
    in any of its values has no DOI either. Runs on Arrow batches, several times as fast as regular expressions of the JVM.
    """
    return F.arrow_udf(doi_keys, StringType()).asNondeterministic()(c)


def _words(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def text_key(c: Column) -> Column:
    """Canonical key of any text: its letters and digits in order; null without any."""
    return F.nullif(_words(c), F.lit(""))


def fields_key(*cols: str) -> Column:
    """Canonical key of a record of several fields, in any order of the fields named."""
    return F.array_join(F.array_sort(F.array(*[F.concat(F.lit(f"{n}="), F.coalesce(_words(F.col(n).cast("string")), F.lit("~"))) for n in cols])), "|")


def sorted_keys(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """(key, row_id) of the rows with a key, range-partitioned and sorted, in the checkpoint folder."""
    n = shuffle_width(df.sparkSession)
    rows = checkpointed(df.select(key.alias("key"), F.col(row_id).cast("bigint").alias("row_id")).where("key IS NOT NULL"))
    return checkpointed(rows.repartitionByRange(n, "key", "row_id").sortWithinPartitions("key", "row_id"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition that has rows: its first and last key, the first id of its last run."""
    from pyspark import TaskContext

    first = last = None
    head = 0
    for b in batches:
        if not b.num_rows:
            continue
        keys, ids = b.column(0), b.column(1)
        if first is None:
            first = keys[0].as_py()
        end = keys[-1].as_py()
        if end != last:
            at = int(np.argmax(pc.equal(keys, keys[-1]).to_numpy(zero_copy_only=False)))
            last, head = end, ids[at].as_py()
    if first is not None:
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "first_key": [first], "last_key": [last], "head_id": [head]}, schema=pa.schema([("part", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("head_id", pa.int64())]))


def carried(ends: list) -> dict[int, int]:
    """For each partition whose first run began before it: the id at which that run began."""
    out: dict[int, int] = {}
    before_key = before_id = None
    for e in sorted(ends, key=lambda e: e["part"]):
        head = e["head_id"]
        if e["first_key"] == before_key:
            out[e["part"]] = before_id
            if e["last_key"] == e["first_key"]:
                head = before_id
        before_key, before_id = e["last_key"], head
    return out


def _scan(carry: dict[int, int]):
    schema = pa.schema([("key", pa.string()), ("row_id", pa.int64()), ("first_id", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        began, head = False, carry.get(TaskContext.get().partitionId())
        last: pa.Scalar | None = None
        for b in batches:
            if not b.num_rows:
                continue
            keys, ids = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
            new = np.ones(len(ids), bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
            new[0] = keys[0].as_py() != last if began else head is None
            run = np.cumsum(new)
            starts = ids[new]
            firsts = np.concatenate([[head if head is not None else 0], starts])[run]
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids), pa.array(firsts.astype(np.int64))], schema=schema)
            began, head, last = True, int(firsts[-1]), keys[-1].as_py()

    return scan


def key_runs(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """(key, row_id, first_id): every row that has a key, with the smallest id of the rows of equal key.

    Ids must be unique; repeated ids come out as often as they came in. Rows whose key is null are left out.
    An empty table gives no rows. Other columns of ``df``, whatever their names, play no part.
    """
    runs = sorted_keys(df, key, row_id)
    ends = runs.mapInArrow(_ends, "part int, first_key string, last_key string, head_id bigint").collect()
    return runs.mapInArrow(_scan(carried(ends)), "key string, row_id bigint, first_id bigint")


def repeats(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """(first_id, row_id) of every row that repeats an earlier one."""
    return key_runs(df, key, row_id).where("row_id <> first_id").select("first_id", "row_id")


def records(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """(first_id, key, n_rows): one row for each record, with the exact number of its rows.

    Copies of one record are counted where they lie before they are shuffled.
    """
    return key_runs(df, key, row_id).groupBy("first_id").agg(F.min("key").alias("key"), F.count("*").alias("n_rows"))
