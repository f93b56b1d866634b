"""Joining Parquet files by copying their encoded column blocks; nothing is decoded but the footers.

The footer is a Thrift struct in compact encoding. It is read into a plain tree (fields the code doesn't know stay
as they are), the block offsets in it are moved, and it is written again.
"""

from __future__ import annotations

import struct
from typing import Any, BinaryIO

MAGIC = b"PAR1"
# Thrift compact protocol type codes (fixed by the format).
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)


class IncompatibleBlocks(ValueError):
    """The file's blocks can't stand beside those already copied."""


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def varint(self) -> int:
        value = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    def zigzag(self) -> int:
        n = self.varint()
        return (n >> 1) ^ -(n & 1)

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def value(self, kind: int, element: bool = False) -> Any:
        if kind in (TRUE, FALSE):
            return self.take(1) if element else b""
        if kind == BYTE:
            return self.take(1)
        if kind in (I16, I32, I64):
            return self.zigzag()
        if kind == DOUBLE:
            return self.take(8)
        if kind == BINARY:
            return self.take(self.varint())
        if kind in (LIST, SET):
            head = self.take(1)[0]
            size = self.varint() if head >> 4 == 15 else head >> 4
            return head & 15, [self.value(head & 15, True) for _ in range(size)]
        if kind == MAP:
            size = self.varint()
            kinds = self.take(1)[0] if size else 0
            return kinds, [(self.value(kinds >> 4, True), self.value(kinds & 15, True)) for _ in range(size)]
        if kind == STRUCT:
            fields: dict[int, tuple[int, Any]] = {}
            last = 0
            while head := self.take(1)[0]:
                last = last + (head >> 4) if head >> 4 else self.zigzag()
                fields[last] = (head & 15, self.value(head & 15))
            return fields
        raise ValueError(f"unknown Thrift type {kind}")


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _encode(kind: int, value: Any) -> bytes:
    if kind in (TRUE, FALSE, BYTE, DOUBLE):
        return value
    if kind in (I16, I32, I64):
        return _varint(value << 1 if value >= 0 else (-value << 1) - 1)
    if kind == BINARY:
        return _varint(len(value)) + value
    if kind in (LIST, SET):
        of, items = value
        head = bytes([len(items) << 4 | of]) if len(items) < 15 else bytes([0xF0 | of]) + _varint(len(items))
        return head + b"".join(_encode(of, x) for x in items)
    if kind == MAP:
        kinds, items = value
        return _varint(0) if not items else _varint(len(items)) + bytes([kinds]) + b"".join(_encode(kinds >> 4, a) + _encode(kinds & 15, b) for a, b in items)
    out, last = bytearray(), 0
    for fid in sorted(value):
        of, x = value[fid]
        out += bytes([(fid - last) << 4 | of]) if 0 < fid - last < 16 else bytes([of]) + _encode(I16, fid)
        out += _encode(of, x)
        last = fid
    return bytes(out) + b"\0"


def read_footer(f: BinaryIO, size: int) -> dict:
    """The footer of an open Parquet file of ``size`` bytes as a tree: field id to (type, value)."""
    if size < 12:
        raise ValueError("too short for a Parquet file")
    f.seek(size - 8)
    tail = f.read(8)
    if tail[4:] != MAGIC:
        raise ValueError("no Parquet file, or an encrypted footer")
    n = struct.unpack("<I", tail[:4])[0]
    f.seek(size - 8 - n)
    return _Reader(f.read(n)).value(STRUCT)


class BlockWriter:
    """Appends the row groups (blocks) of Parquet files to one output file.

    With ``group_bytes`` small blocks without dictionaries become one: the pages of each column are laid one behind the other, unchanged, until the
    new block has about that size; so much is held in memory. A dictionary belongs to its block, so blocks with one stay blocks of their own.
    Field ids are those of the format: file 2 schema, 3 rows, 4 row groups, 5 key-value pairs; row group 1 columns, 2 bytes, 3 rows, 4 sorting,
    5 offset, 6 size, 7 ordinal; column chunk 2 offset, 3 metadata, 4-7 page indexes; metadata 2 encodings, 4 codec, 5 values, 6-7 sizes, 9-11 page offsets (11 dictionary),
    12-13 and 16 statistics, 14-15 bloom filter.
    """

    def __init__(self, out: BinaryIO, group_bytes: int = 0) -> None:
        self.out, self.at, self.footer, self.groups, self.rows = out, 4, None, [], 0
        self.group_bytes, self.pending, self.held, self.pending_bytes = group_bytes, None, [], 0
        out.write(MAGIC)

    def append(self, f: BinaryIO, size: int, footer: dict | None = None) -> tuple[int, int]:
        """Copy all blocks of the open file ``f``; (blocks, rows) copied. Raises IncompatibleBlocks before anything is written. A ``footer`` read before is used up."""
        footer = read_footer(f, size) if footer is None else footer
        schema = schema_of(footer)
        if self.footer is None:
            self.footer, self.schema = {k: v for k, v in footer.items() if k not in (4, 8, 9)}, schema
        elif schema != self.schema:
            raise IncompatibleBlocks("another schema")
        elif 5 in self.footer and footer.get(5) != self.footer[5]:
            del self.footer[5]  # only pairs that hold for all blocks may stay
        groups = [g for g in footer[4][1][1] if g[3][1]]  # blocks without rows have nothing to copy
        for group in groups:
            for chunk in group[1][1][1]:
                if 1 in chunk or 8 in chunk or 9 in chunk or 3 not in chunk:
                    raise IncompatibleBlocks("its blocks are encrypted or lie in another file")
        rows = 0
        for group in groups:
            blocks = []
            for chunk in group[1][1][1]:
                meta = chunk[3][1]
                f.seek(_first(meta))
                block = f.read(meta[7][1])
                if len(block) != meta[7][1]:
                    raise ValueError("a block ends too early")
                blocks.append(block)
            if self.group_bytes and not has_dictionary(group):
                self._join(group, blocks)
            else:
                self._flush()
                self._write(group, [[b] for b in blocks])
            rows += group[3][1]
        self.rows += rows
        if footer[3][1] != rows:
            raise ValueError("the footer's row total differs from that of its blocks")
        return len(groups), rows

    def _join(self, group: dict, blocks: list[bytes]) -> None:
        """Lay the pages of ``group`` behind those that wait."""
        metas = [c[3][1] for c in group[1][1][1]]
        codecs = [m[4] for m in metas]
        if self.pending is not None and [c[3][1][4] for c in self.pending[1][1][1]] != codecs:
            self._flush()
        if self.pending is None:
            group.pop(4, None)  # sorted blocks in a row aren't one sorted block
            for m in metas:
                for k in (12, 13, 16):
                    m.pop(k, None)
                m[9] = (I64, m[9][1] - _first(m))
            self.pending, self.held = group, [[b] for b in blocks]
        else:
            for k in (2, 3, 6):
                if k in group and k in self.pending:
                    self.pending[k] = (I64, self.pending[k][1] + group[k][1])
            for chunk, m, held, block in zip(self.pending[1][1][1], metas, self.held, blocks, strict=True):
                total = chunk[3][1]
                for k in (5, 6, 7):
                    total[k] = (I64, total[k][1] + m[k][1])
                kind, known = total[2][1]
                total[2] = (LIST, (kind, known + [e for e in m[2][1][1] if e not in known]))
                held.append(block)
        self.pending_bytes += sum(map(len, blocks))
        if self.pending_bytes >= self.group_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.pending is not None:
            for chunk in self.pending[1][1][1]:
                chunk[3][1].pop(10, None)
            self._write(self.pending, self.held)
        self.pending, self.held, self.pending_bytes = None, [], 0

    def _write(self, group: dict, columns: list[list[bytes]]) -> None:
        start = self.at
        for chunk, blocks in zip(group[1][1][1], columns, strict=True):
            meta = chunk[3][1]
            first = 0 if len(blocks) > 1 or group is self.pending else _first(meta)
            for k in (9, 10, 11):
                if k in meta and (meta[k][1] > 0 or group is self.pending):
                    meta[k] = (I64, meta[k][1] - first + self.at)
            for k in (14, 15):
                meta.pop(k, None)
            for k in (4, 5, 6, 7):
                chunk.pop(k, None)
            chunk[2] = (I64, 0)
            for b in blocks:
                self.out.write(b)
                self.at += len(b)
        group[5] = (I64, start)
        group.pop(7, None)
        self.groups.append(group)

    def close(self) -> None:
        """Write the joined footer."""
        self._flush()
        self.footer[3], self.footer[4] = (I64, self.rows), (LIST, (STRUCT, self.groups))
        data = _encode(STRUCT, self.footer)
        self.out.write(data + struct.pack("<I", len(data)) + MAGIC)


def _first(meta: dict) -> int:
    """Where a column chunk begins: its dictionary, if it has one, else its first data page."""
    return min(meta[k][1] for k in (9, 11) if k in meta and meta[k][1] > 0)


def has_dictionary(group: dict) -> bool:
    return any(11 in c[3][1] and c[3][1][11][1] > 0 for c in group[1][1][1])


def schema_of(footer: dict) -> tuple[bytes, bytes]:
    """What the blocks of two files must agree in to stand in one file."""
    return _encode(*footer[2]), _encode(*footer[7]) if 7 in footer else b""
