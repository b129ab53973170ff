"""Compressed files decoded from the front inside tasks: gzip, and zip members that are stored or deflated.

Nothing is read at a file's end and no archive is held: bytes are read, inflated and split into lines as they come. What a file that is
cut off holds before the cut is given; so it is with a cap on the bytes that are wanted.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranges

#: Bytes that are read at a time.
STEP = 1 << 20
_LOCAL = struct.Struct("<4s5H3I2H")
_LINES = pa.schema([("file", pa.string()), ("member", pa.string()), ("line", pa.int64()), ("value", pa.string())])
_STATES = pa.schema([("file", pa.string()), ("member", pa.string()), ("bytes", pa.int64()), ("truncated", pa.bool_()), ("error", pa.string())])


class _Source:
    """A file's bytes from the front, with what has been read too far put back."""

    def __init__(self, raw):
        self.raw, self.held = raw, b""

    def some(self) -> bytes:
        out, self.held = self.held or self.raw.read(STEP), b""
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.held) < n and (more := self.raw.read(STEP)):
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        return out


def _inflated(source: _Source, bits: int) -> Iterator[bytes]:
    """A deflate stream's bytes; EOFError where the file ends before the stream."""
    stream = zlib.decompressobj(bits)
    while not stream.eof:
        data = source.some()
        if not data:
            raise EOFError
        yield stream.decompress(data)
    source.held = stream.unused_data + source.held


def _stored(source: _Source, size: int) -> Iterator[bytes]:
    while size:
        data = source.exactly(min(size, STEP))
        if not data:
            raise EOFError
        size -= len(data)
        yield data


def _plain(source: _Source) -> Iterator[bytes]:
    while data := source.some():
        yield data


def _gzip(source: _Source) -> Iterator[bytes]:
    """All streams of a gzip file, one after the other."""
    yield from _inflated(source, 31)
    while source.held or (data := source.raw.read(STEP)):
        source.held = source.held or data
        yield from _inflated(source, 31)


def members(raw, name: str) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(member, its bytes) of a file, in the file's order; a file that is no archive is its one member, without a name. Each member's
    bytes have to be taken before the next one. ValueError for members that are encrypted or packed in other ways."""
    source = _Source(raw)
    first = source.exactly(4)
    source.held = first + source.held
    if source.held[:2] == b"\x1f\x8b":
        yield "", _gzip(source)
    elif source.held[:4] != b"PK\x03\x04":
        yield "", _plain(source)
    else:
        while (head := source.exactly(_LOCAL.size))[:4] == b"PK\x03\x04":
            if len(head) < _LOCAL.size:
                return
            _, _, flags, method, _, _, _, packed, size, n, extra = _LOCAL.unpack(head)
            member = source.exactly(n).decode("utf-8" if flags & 0x800 else "cp437")
            more = source.exactly(extra)
            if packed == 0xFFFFFFFF and (at := more.find(b"\x01\x00")) >= 0 and len(more) >= at + 20:
                size, packed = struct.unpack_from("<QQ", more, at + 4)
            if flags & 1 or method not in (0, 8) or (method == 0 and flags & 8):
                raise ValueError(f"{name}!{member}: packed in a way that can't be decoded from the front")
            yield member, _inflated(source, -15) if method == 8 else _stored(source, packed)
            if flags & 8:  # sizes follow the data, behind a mark that may be left out; four bytes each or, in large archives, eight
                tail = source.exactly(24)
                place = next((i for i in (12, 16, 20, 24) if tail[i : i + 4] in (b"PK\x03\x04", b"PK\x01\x02")), None)
                if place is None and len(tail) == 24:
                    tail += source.exactly(4)
                    place = next((i for i in (16, 20, 24) if tail[i : i + 4] in (b"PK\x03\x04", b"PK\x01\x02")), len(tail))
                source.held = tail[place if place is not None else len(tail) :] + source.held


def _taken(raw, name: str, cap: int | None) -> Iterator[tuple[str, bytes, bool, str | None]]:
    """(member, bytes, whether they are the last ones, why they are cut off or can't be read) of a file's members."""
    try:
        for member, parts in members(raw, name):
            left = cap
            why = None
            try:
                for part in parts:
                    if left is not None and len(part) > left:
                        yield member, part[:left], False, None
                        why, left = "cap", 0
                        for _ in parts:  # the next member begins behind this one
                            pass
                        break
                    left = None if left is None else left - len(part)
                    yield member, part, False, None
            except (EOFError, zlib.error):
                why = "end"
            yield member, b"", True, why
            if why == "end":
                return
    except ValueError as e:
        yield "", b"", True, str(e)


def _line_rows(cap: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with ranges.opened(file) as raw:
                    rest, at, held = b"", 0, []
                    for member, data, last, _ in _taken(raw, file, cap):
                        *lines, rest = (rest + data).split(b"\n")
                        if last:
                            lines, rest = ([*lines, rest] if rest else lines), b""
                        held += [(file, member, at + i, x.rstrip(b"\r").decode("utf-8", "replace")) for i, x in enumerate(lines)]
                        at = 0 if last else at + len(lines)
                        while len(held) >= 4096 or (last and held):
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held[:4096], strict=True), _LINES, strict=True)], schema=_LINES)
                            held = held[4096:]

    return run


def read_lines(files: DataFrame, cap: int | None = None) -> DataFrame:
    """(file, member, line, value) of plain, gzip and zip files (file): lines from 0, one task a file, in bounded memory. cap: bytes of
    each member up to which it is read. The last line of a member that is cut off, by its end or by the cap, is given as far as it
    goes; states() tells which are."""
    return _dealt(files).mapInArrow(_line_rows(cap), "file string, member string, line long, value string")


def states(files: DataFrame, cap: int | None = None) -> DataFrame:
    """(file, member, bytes, truncated, error) of each member: the bytes that read_lines would give, whether it is cut off, and why a
    member can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with ranges.opened(file) as raw:
                    n = 0
                    for member, data, last, why in _taken(raw, file, cap):
                        n += len(data)
                        if last:
                            cut = why in ("end", "cap")
                            yield pa.RecordBatch.from_pylist([{"file": file, "member": member, "bytes": n, "truncated": cut, "error": None if cut else why}], _STATES)
                            n = 0

    return _dealt(files).mapInArrow(run, "file string, member string, bytes long, truncated boolean, error string")


def _dealt(files: DataFrame) -> DataFrame:
    return files.select("file").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.col("file"))
