"""Parquet files joined block by block: encoded row groups are copied, only footers are rewritten.

A footer is a Thrift compact structure. It is read into plain values, the row groups' offsets
are moved to where the bytes now lie, and a new footer is written. Pages are never decoded.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any, BinaryIO

MAGIC = b"PAR1"
BOOL_TRUE, BOOL_FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT, UUID = range(1, 14)
# Field numbers of the format's footer structures.
SCHEMA, ROWS, GROUPS = 2, 3, 4
GROUP_COLUMNS, GROUP_ROWS, GROUP_OFFSET, GROUP_COMPRESSED, GROUP_ORDINAL = 1, 3, 5, 6, 7
CHUNK_OFFSET, CHUNK_META = 2, 3
CHUNK_INDEXES = (4, 5, 6, 7)
META_SIZE, META_DATA_PAGE, META_INDEX_PAGE, META_DICTIONARY = 7, 9, 10, 11
META_BLOOM = (14, 15)


class BlockError(ValueError):
    """A file that can't be joined, or a joined file that doesn't hold what it should."""


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def varint(self) -> int:
        data, at, shift, value = self.data, self.at, 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                self.at = at
                return value
            shift += 7

    def zigzag(self) -> int:
        n = self.varint()
        return (n >> 1) ^ -(n & 1)

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def value(self, kind: int) -> Any:
        if kind in (I16, I32, I64):
            return self.zigzag()
        if kind == BINARY:
            return self.take(self.varint())
        if kind == STRUCT:
            return self.struct()
        if kind in (LIST, SET):
            head = self.take(1)[0]
            size, of = head >> 4, head & 15
            size = self.varint() if size == 15 else size
            return of, [self.value(of) for _ in range(size)]
        if kind in (BOOL_TRUE, BOOL_FALSE, BYTE):  # as an element; a field's truth is its type
            return self.take(1)
        if kind == DOUBLE:
            return self.take(8)
        if kind == UUID:
            return self.take(16)
        if kind == MAP:
            size = self.varint()
            kinds = self.take(1)[0] if size else 0
            return kinds, [(self.value(kinds >> 4), self.value(kinds & 15)) for _ in range(size)]
        raise BlockError(f"unknown type {kind} in a footer")

    def struct(self) -> dict[int, tuple[int, Any]]:
        fields, last = {}, 0
        while head := self.take(1)[0]:
            last = last + (head >> 4) if head >> 4 else self.zigzag()
            kind = head & 15
            fields[last] = (kind, None if kind in (BOOL_TRUE, BOOL_FALSE) else self.value(kind))
        return fields


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _zigzag(n: int) -> bytes:
    return _varint((n << 1) ^ (n >> 63))


def _value(out: bytearray, kind: int, value: Any) -> None:
    if kind in (I16, I32, I64):
        out += _zigzag(value)
    elif kind == BINARY:
        out += _varint(len(value))
        out += value
    elif kind == STRUCT:
        _struct(out, value)
    elif kind in (LIST, SET):
        of, items = value
        out += bytes([len(items) << 4 | of]) if len(items) < 15 else bytes([0xF0 | of]) + _varint(len(items))
        for item in items:
            _value(out, of, item)
    elif kind == MAP:
        kinds, items = value
        out += _varint(len(items)) + (bytes([kinds]) if items else b"")
        for k, v in items:
            _value(out, kinds >> 4, k)
            _value(out, kinds & 15, v)
    else:
        out += value


def _struct(out: bytearray, fields: dict[int, tuple[int, Any]]) -> None:
    last = 0
    for number in sorted(fields):
        kind, value = fields[number]
        gap = number - last
        out += bytes([gap << 4 | kind]) if 0 < gap < 16 else bytes([kind]) + _zigzag(number)
        if kind not in (BOOL_TRUE, BOOL_FALSE):
            _value(out, kind, value)
        last = number
    out.append(0)


def _footer_bytes(source: BinaryIO) -> bytes:
    end = source.seek(0, 2)
    if end < 12:
        raise BlockError("too short for a Parquet file")
    source.seek(end - 8)
    tail = source.read(8)
    if tail[4:] != MAGIC:
        raise BlockError("not a plain Parquet file")
    (length,) = struct.unpack("<I", tail[:4])
    source.seek(end - 8 - length)
    return source.read(length)


def footer(source: BinaryIO) -> dict[int, tuple[int, Any]]:
    """The footer of an open Parquet file as {field number: (type, value)}."""
    return _Reader(_footer_bytes(source)).struct()


def schema_bytes(source: BinaryIO) -> bytes:
    """The schema's own bytes, as :func:`schema_key` gives them, without reading the rest of the footer."""
    reader = _Reader(_footer_bytes(source))
    last = 0
    while head := reader.take(1)[0]:
        last = last + (head >> 4) if head >> 4 else reader.zigzag()
        first = reader.at
        if head & 15 not in (BOOL_TRUE, BOOL_FALSE):
            reader.value(head & 15)
        if last == SCHEMA:
            return reader.data[first : reader.at]
    raise BlockError("a footer without schema")


def schema_key(foot: dict[int, tuple[int, Any]]) -> bytes:
    """The schema's own bytes: equal keys mean that blocks may share a file."""
    out = bytearray()
    _value(out, *foot[SCHEMA])
    return bytes(out)


def _start(meta: dict[int, tuple[int, Any]]) -> int:
    dictionary, data = meta.get(META_DICTIONARY, (0, 0))[1], meta[META_DATA_PAGE][1]
    return dictionary if 0 < dictionary < data else data


@dataclass
class Joined:
    files: int
    blocks: int
    rows: int
    bytes: int
    schema: bytes


def join_files(opens: Iterable[Callable[[], BinaryIO]], target: BinaryIO) -> Joined:
    """Write the row groups of all opened files, in order, into ``target``, and a new footer.

    The schemas must be equal, else a BlockError says so. Page indexes and Bloom filters lie
    outside the blocks and are left behind; their references are removed.
    """
    foot, key, groups, rows, files = None, b"", [], 0, 0
    target.write(MAGIC)
    at = len(MAGIC)
    for opened in opens:
        with opened() as source:
            own = footer(source)
            if foot is None:
                foot, key = own, schema_key(own)
            elif schema_key(own) != key:
                raise BlockError("schemas differ")
            files += 1
            for group in own.get(GROUPS, (LIST, (STRUCT, [])))[1][1]:
                first = None
                for chunk in group[GROUP_COLUMNS][1][1]:
                    meta = chunk[CHUNK_META][1]
                    start, size = _start(meta), meta[META_SIZE][1]
                    source.seek(start)
                    block = source.read(size)
                    if len(block) != size:
                        raise BlockError("a block ends before its length")
                    target.write(block)
                    for number in (META_DATA_PAGE, META_INDEX_PAGE, META_DICTIONARY):
                        if number in meta and meta[number][1] > 0:
                            meta[number] = (I64, meta[number][1] - start + at)
                    for number in META_BLOOM:
                        meta.pop(number, None)
                    for number in CHUNK_INDEXES:
                        chunk.pop(number, None)
                    chunk[CHUNK_OFFSET] = (I64, 0)
                    first = at if first is None else first
                    at += size
                if GROUP_OFFSET in group and first is not None:
                    group[GROUP_OFFSET] = (I64, first)
                if GROUP_ORDINAL in group:
                    if len(groups) < 2**15:
                        group[GROUP_ORDINAL] = (I16, len(groups))
                    else:
                        group.pop(GROUP_ORDINAL)
                groups.append(group)
                rows += group[GROUP_ROWS][1]
    if foot is None:
        raise BlockError("no file to join")
    foot[ROWS] = (I64, rows)
    foot[GROUPS] = (LIST, (STRUCT, groups))
    tail = bytearray()
    _struct(tail, foot)
    target.write(bytes(tail) + struct.pack("<I", len(tail)) + MAGIC)
    return Joined(files, len(groups), rows, at + len(tail) + 8, key)


def verify(source: BinaryIO, expected: Joined) -> None:
    """Read a joined file's footer back; a BlockError tells what differs from ``expected``."""
    foot = footer(source)
    groups = foot[GROUPS][1][1]
    found = (schema_key(foot), len(groups), foot[ROWS][1], sum(g[GROUP_ROWS][1] for g in groups))
    for what, a, b in zip(("schema", "block count", "row total", "rows of all blocks"), found, (expected.schema, expected.blocks, expected.rows, expected.rows)):
        if a != b:
            raise BlockError(f"{what} differs after joining")
