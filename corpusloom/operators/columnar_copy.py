"""Parquet files joined by copying their encoded column data and writing a new footer; nothing is decoded.

A Parquet footer is a Thrift struct in the compact protocol. ``read_struct`` and ``write_struct`` carry such structs as
``{field id: (type, value)}``, so fields that this module doesn't know survive. ``join_files`` copies either whole row
groups (always possible for equal schemas) or, where every chunk of a column has the same codec and no dictionary page,
the pages of each column behind one another, which gives one row group in place of many small ones.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

MAGIC = b"PAR1"
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)

# Field ids of the Parquet format (fixed values of the public specification).
FILE_SCHEMA, FILE_ROWS, FILE_GROUPS = 2, 3, 4
GROUP_COLUMNS, GROUP_BYTES, GROUP_ROWS, GROUP_OFFSET, GROUP_COMPRESSED, GROUP_ORDINAL = 1, 2, 3, 5, 6, 7
CHUNK_OFFSET, CHUNK_META, CHUNK_INDEXES = 2, 3, (4, 5, 6, 7)
META_TYPE, META_ENCODINGS, META_PATH, META_CODEC, META_VALUES, META_BYTES, META_COMPRESSED = 1, 2, 3, 4, 5, 6, 7
META_DATA_OFFSET, META_INDEX_OFFSET, META_DICTIONARY_OFFSET, META_STATISTICS, META_ENCODING_STATS = 9, 10, 11, 12, 13
META_BLOOM = (14, 15)


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[i]
        i += 1
        out |= (x & 127) << shift
        if x < 128:
            return out, i
        shift += 7


def _value(b: bytes, i: int, kind: int):
    if kind in (I16, I32, I64):
        n, i = _varint(b, i)
        return (n >> 1) ^ -(n & 1), i
    if kind == BINARY:
        n, i = _varint(b, i)
        return b[i : i + n], i + n
    if kind == STRUCT:
        return read_struct(b, i)
    if kind in (LIST, SET):
        head = b[i]
        i += 1
        n, of = head >> 4, head & 15
        if n == 15:
            n, i = _varint(b, i)
        items = []
        for _ in range(n):
            x, i = (b[i], i + 1) if of in (TRUE, FALSE) else _value(b, i, of)
            items.append(x)
        return (of, items), i
    if kind == BYTE:
        return b[i], i + 1
    if kind == DOUBLE:
        return b[i : i + 8], i + 8
    if kind == MAP:
        n, i = _varint(b, i)
        if not n:
            return (0, []), i
        kinds, pairs = b[i], []
        i += 1
        for _ in range(n):
            k, i = _value(b, i, kinds >> 4)
            v, i = _value(b, i, kinds & 15)
            pairs.append((k, v))
        return (kinds, pairs), i
    raise ValueError(f"unknown Thrift type {kind}")


def read_struct(b: bytes, i: int = 0) -> tuple[dict, int]:
    """A Thrift struct at ``i`` and the position behind it."""
    out: dict = {}
    field = 0
    while True:
        head = b[i]
        i += 1
        if not head:
            return out, i
        kind = head & 15
        if head >> 4:
            field += head >> 4
        else:
            n, i = _varint(b, i)
            field = (n >> 1) ^ -(n & 1)
        if kind in (TRUE, FALSE):
            out[field] = (kind, None)
        else:
            x, i = _value(b, i, kind)
            out[field] = (kind, x)


def _put_varint(out: bytearray, n: int) -> None:
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)


def _put(out: bytearray, kind: int, x) -> None:
    if kind in (I16, I32, I64):
        _put_varint(out, (x << 1) ^ (x >> 63))
    elif kind == BINARY:
        _put_varint(out, len(x))
        out += x
    elif kind == STRUCT:
        write_struct(out, x)
    elif kind in (LIST, SET):
        of, items = x
        if len(items) < 15:
            out.append(len(items) << 4 | of)
        else:
            out.append(0xF0 | of)
            _put_varint(out, len(items))
        for y in items:
            if of in (TRUE, FALSE):
                out.append(y)
            else:
                _put(out, of, y)
    elif kind == BYTE:
        out.append(x)
    elif kind == DOUBLE:
        out += x
    elif kind == MAP:
        kinds, pairs = x
        _put_varint(out, len(pairs))
        if pairs:
            out.append(kinds)
            for k, v in pairs:
                _put(out, kinds >> 4, k)
                _put(out, kinds & 15, v)


def write_struct(out: bytearray, fields: dict) -> None:
    """``fields`` appended to ``out``."""
    last = 0
    for field in sorted(fields):
        kind, x = fields[field]
        if 0 < field - last < 16:
            out.append(field - last << 4 | kind)
        else:
            out.append(kind)
            _put_varint(out, (field << 1) ^ (field >> 63))
        last = field
        if kind not in (TRUE, FALSE):
            _put(out, kind, x)
    out.append(0)


def footer(content: bytes) -> dict:
    """The footer of a whole Parquet file; an error if it isn't one."""
    if len(content) < 12 or content[:4] != MAGIC or content[-4:] != MAGIC:
        raise ValueError("not a Parquet file")
    n = struct.unpack("<I", content[-8:-4])[0]
    return read_struct(content[len(content) - 8 - n : len(content) - 8])[0]


@dataclass
class Chunk:
    """Encoded pages of one column in one row group, with the metadata that describes them."""

    meta: dict
    data: bytes

    @property
    def start(self) -> int:
        return chunk_start(self.meta)

    def plain(self) -> tuple | None:
        """What must be equal for pages to follow one another; none if they need their own dictionary."""
        m = self.meta
        return None if META_DICTIONARY_OFFSET in m else (m[META_TYPE][1], m[META_CODEC][1], tuple(m[META_PATH][1][1]))


@dataclass
class Block:
    """One row group: its rows and its column chunks."""

    rows: int
    chunks: list[Chunk]


def chunk_start(meta: dict) -> int:
    """Where a column chunk begins: at its dictionary page if it has one."""
    at = [meta[k][1] for k in (META_DICTIONARY_OFFSET, META_DATA_OFFSET) if k in meta and meta[k][1] > 0]
    return min(at)


def blocks_of(content: bytes) -> tuple[dict, list[Block]]:
    """Footer and row groups of a file."""
    f = footer(content)
    out = []
    for g in f[FILE_GROUPS][1][1]:
        chunks = []
        for c in g[GROUP_COLUMNS][1][1]:
            m = c[CHUNK_META][1]
            at = chunk_start(m)
            chunks.append(Chunk(m, content[at : at + m[META_COMPRESSED][1]]))
        out.append(Block(g[GROUP_ROWS][1], chunks))
    return f, out


def _moved(meta: dict, at: int) -> dict:
    by = at - chunk_start(meta)
    out = {k: v for k, v in meta.items() if k not in META_BLOOM}
    for k in (META_DATA_OFFSET, META_INDEX_OFFSET, META_DICTIONARY_OFFSET):
        if k in out:
            out[k] = (out[k][0], out[k][1] + by)
    return out


def _joined(metas: list[dict], at: int) -> dict:
    """Metadata of a chunk that holds the pages of several; their statistics don't hold for it."""
    out = {k: v for k, v in _moved(metas[0], at).items() if k not in (META_STATISTICS, META_ENCODING_STATS)}
    for k in (META_VALUES, META_BYTES, META_COMPRESSED):
        out[k] = (I64, sum(m[k][1] for m in metas))
    encodings = sorted({e for m in metas for e in m[META_ENCODINGS][1][1]})
    out[META_ENCODINGS] = (LIST, (metas[0][META_ENCODINGS][1][0], encodings))
    return out


def join_blocks(schema_footer: dict, blocks: list[Block]) -> bytes:
    """One Parquet file of ``blocks`` in order, all of the schema of ``schema_footer``.

    Columns whose pages may follow one another in every block are joined into one row group, else each block stays one.
    """
    pages = len(blocks) > 1 and all((kinds := {b.chunks[i].plain() for b in blocks}) and len(kinds) == 1 and None not in kinds for i in range(len(blocks[0].chunks)))
    out, groups = bytearray(MAGIC), []

    def group(rows: int, columns: list[list[Chunk]]) -> None:
        began, made, plain = len(out), [], 0
        for parts in columns:
            at = len(out)
            for p in parts:
                out.extend(p.data)
            metas = [p.meta for p in parts]
            meta = _joined(metas, at) if len(metas) > 1 else _moved(metas[0], at)
            plain += meta[META_BYTES][1]
            made.append({CHUNK_OFFSET: (I64, at), CHUNK_META: (STRUCT, meta)})
        groups.append({GROUP_COLUMNS: (LIST, (STRUCT, made)), GROUP_BYTES: (I64, plain), GROUP_ROWS: (I64, rows), GROUP_OFFSET: (I64, began), GROUP_COMPRESSED: (I64, len(out) - began), GROUP_ORDINAL: (I16, len(groups))})

    if pages:
        group(sum(b.rows for b in blocks), [[b.chunks[i] for b in blocks] for i in range(len(blocks[0].chunks))])
    else:
        for b in blocks:
            group(b.rows, [[c] for c in b.chunks])
    if len(groups) > 32767:
        for g in groups:
            g.pop(GROUP_ORDINAL)
    rows = sum(b.rows for b in blocks)
    f = schema_footer | {FILE_ROWS: (I64, rows), FILE_GROUPS: (LIST, (STRUCT, groups))}
    head = len(out)
    write_struct(out, f)
    out += struct.pack("<I", len(out) - head) + MAGIC
    check_join(bytes(out), schema_footer, blocks, 1 if pages else len(blocks))
    return bytes(out)


def check_join(content: bytes, schema_footer: dict, blocks: list[Block], groups: int) -> None:
    """Reads the new footer back: same schema, as many row groups, rows, values and bytes as went in, or an error."""
    f = footer(content)
    found = f[FILE_GROUPS][1][1]
    if f[FILE_SCHEMA] != schema_footer[FILE_SCHEMA]:
        raise ValueError("the schema changed")
    if len(found) != groups:
        raise ValueError(f"{len(found)} row groups in place of {groups}")
    if not f[FILE_ROWS][1] == sum(g[GROUP_ROWS][1] for g in found) == sum(b.rows for b in blocks):
        raise ValueError("row totals differ")
    for key in (META_VALUES, META_COMPRESSED):
        if sum(c[CHUNK_META][1][key][1] for g in found for c in g[GROUP_COLUMNS][1][1]) != sum(c.meta[key][1] for b in blocks for c in b.chunks):
            raise ValueError("value or byte totals differ")


def same_schema(footers: list[dict]) -> bool:
    """Whether all footers describe the same columns."""
    return all(f[FILE_SCHEMA] == footers[0][FILE_SCHEMA] for f in footers)


def join_files(contents: list[bytes]) -> bytes:
    """One file with the rows of all, in order. Files of different schemas are an error; files without rows add none."""
    read = [blocks_of(c) for c in contents]
    if not same_schema([f for f, _ in read]):
        raise ValueError("the files have different schemas")
    return join_blocks(read[0][0], [b for _, blocks in read for b in blocks if b.rows])


def group_slices(content: bytes) -> list[tuple[dict, bytes]]:
    """Each row group's metadata with the very bytes it has in the footer."""
    n = struct.unpack("<I", content[-8:-4])[0]
    b, i, field, out = content[len(content) - 8 - n : len(content) - 8], 0, 0, []
    while b[i]:
        kind, step = b[i] & 15, b[i] >> 4
        i += 1
        if step:
            field += step
        else:
            z, i = _varint(b, i)
            field = (z >> 1) ^ -(z & 1)
        if field == FILE_GROUPS:
            count = b[i] >> 4
            i += 1
            if count == 15:
                count, i = _varint(b, i)
            for _ in range(count):
                group, end = read_struct(b, i)
                out.append((group, b[i:end]))
                i = end
        elif kind not in (TRUE, FALSE):
            _, i = _value(b, i, kind)
    return out


def carried_block(raw_group: bytes, data: bytes) -> Block:
    """The block of a row group's footer bytes and its chunks' data, which lie behind one another in ``data``."""
    group, _ = read_struct(raw_group)
    chunks, at = [], 0
    for c in group[GROUP_COLUMNS][1][1]:
        m = c[CHUNK_META][1]
        n = m[META_COMPRESSED][1]
        chunks.append(Chunk(m, data[at : at + n]))
        at += n
    if at != len(data):
        raise ValueError("the data of a block is not as long as its footer says")
    return Block(group[GROUP_ROWS][1], chunks)
