"""JSON records of papers: line classes, identifiers and texts, read with the standard JSON grammar.

Spark's own parsers accept text behind a value and refuse NaN and repeated names, so lines are parsed in Arrow batches.
``strict`` refuses NaN and infinities as well, which the two readers of such lines do differently.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_IDS = ("externalids", "externalIds", "external_ids")
_BODIES = ("fullText", "fulltext", "full_text")


def _refuse(name: str):
    raise ValueError(name)


def parse(line: str | None, strict: bool = False):
    """(class, value): ``empty``, ``malformed``, ``other`` (valid, but no object) or ``object`` with the object."""
    if line is None or not line.strip():
        return "empty", None
    try:
        value = json.loads(line, parse_constant=_refuse) if strict else json.loads(line)
    except (ValueError, RecursionError):
        return "malformed", None
    return ("object", value) if isinstance(value, dict) else ("other", None)


def raw_identifier(record: dict) -> str | None:
    """The identifier before it is normalised: the top one if it is truthy, else the first truthy one of the id objects."""
    own = record.get("doi")
    if own:
        return own if isinstance(own, str) else str(own)
    for ids in (record.get(k) for k in _IDS):
        held = (ids.get("doi") or ids.get("DOI")) if isinstance(ids, dict) else None
        if held:
            return held if isinstance(held, str) else str(held)
    return None


def has_body(record: dict) -> bool:
    """Whether a body is there: a text that isn't blank, or any other value but null."""
    content = record.get("content")
    values = [record.get(k) for k in _BODIES] + ([content.get("text")] if isinstance(content, dict) else [])
    return any(v.strip() != "" if isinstance(v, str) else v is not None for v in values)


def classified(lines: DataFrame, line: str = "line", field: str = "fullText", strict: bool = False) -> DataFrame:
    """The columns of ``lines`` and ``kind``, ``raw_doi``, ``has_body``, ``has_field``, ``abstract``, ``body``.

    ``kind`` is as in ``parse``; the rest is null or false unless it is ``object``. ``abstract`` and ``body`` (of ``field``) are null unless
    they are texts; ``has_field`` tells a null field from a missing one. Columns named like those are replaced.
    """
    new = ["kind", "raw_doi", "has_body", "has_field", "abstract", "body"]
    kept = [c for c in lines.columns if c not in new]
    at = kept.index(line)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(*[f"`{c}`" for c in kept]).schema)

    def text(v):
        return v if isinstance(v, str) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in new]
            for value in b.column(at).to_pylist():
                kind, r = parse(value, strict)
                row = (kind, None, False, False, None, None) if r is None else (kind, raw_identifier(r), has_body(r), field in r, text(r.get("abstract")), text(r.get(field)))
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            types = (pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.string())
            made = [pa.array([_clean(x) for x in c] if t == pa.string() else c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*kept, *new])

    return lines.select(*[f"`{c}`" for c in kept]).mapInArrow(run, f"{ddl}, kind string, raw_doi string, has_body boolean, has_field boolean, abstract string, body string")


def _clean(text: str | None) -> str | None:
    """Without lone surrogates, which JSON escapes may hold and UTF-8 can't."""
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode()
