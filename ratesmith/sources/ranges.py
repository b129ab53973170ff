"""Files read by byte ranges inside tasks, and JSON documents of any size read by many tasks.

A JSON document is cut into blocks. One pass over the bytes notes for each block, from each state that it may begin in (outside a
string, inside one, inside one behind a backslash), the state it ends in and by how many brackets it goes up or down. These are
composed block by block, file by file, so that in a second pass each task knows where its block begins, and takes the values that
begin there: the members of the document, and the elements of arrays that are members. A value that goes on behind the block is
read to its end. So a task holds a block and the values that begin in it, whatever the document's size.
"""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lake import working_table

#: Bytes of a document that one task looks at.
BLOCK = 8 << 20
#: Bytes that a task reads, of blocks that are smaller: a task each would take longer to begin than to read.
TASK = 32 << 20
FEW = 64
#: Bytes that are read at a time to find the end of a value that goes on behind its block.
MORE = 1 << 20
_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[*b"{["]] = _CLOSE[[*b"}]"]] = True
_SPACE = b" \t\r\n"
#: The name of a member, and the first byte of its value.
_HEAD = re.compile(rb'\s*("(?:[^"\\]|\\.)*")\s*:\s*(\S)', re.DOTALL)
#: Bytes up to which an array is told with the document's other members.
SMALL = 1 << 16
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2


def opened(path: str):
    """A file that a task reads by ranges. Any store that Arrow reads."""
    fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path.removeprefix("file:"))
    return fs.open_input_file(where)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of the files of a file's, folder's or pattern's path; hidden ones and those without bytes are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("file"), F.col("length").alias("size"))


def blocks(files: DataFrame, size: int = BLOCK) -> DataFrame:
    """(file, size, block, low, high) of each block of files (file, size)."""
    each = files.where("size > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / size).cast("long"))))
    return each.select("file", "size", "block", (F.col("block") * size).alias("low"), F.least(F.col("size"), (F.col("block") + 1) * size).alias("high"))


def _quotes(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Places of the quotes that begin or end a string, and whether the last byte escapes the next one. Backslashes count in runs, from
    a first byte that is escaped already or isn't."""
    back = data == 0x5C
    if state == ESCAPED and len(data):
        back[0] = False
    at = np.flatnonzero(back)
    run_starts = at[np.r_[True, np.diff(at) > 1]] if len(at) else at
    run_ends = at[np.r_[np.diff(at) > 1, True]] + 1 if len(at) else at
    odd = (run_ends - run_starts) % 2 == 1
    escaped = run_ends[odd]
    quote = data == 0x22
    quote[escaped[escaped < len(data)]] = False
    if state == ESCAPED and len(data):
        quote[0] = False
    return np.flatnonzero(quote), int(len(escaped) > 0 and escaped[-1] == len(data))


def _outside(data: np.ndarray, quotes: np.ndarray, state: int) -> np.ndarray:
    """Which bytes are outside strings."""
    flips = np.zeros(len(data) + 1, np.uint8)
    flips[quotes] = 1
    return np.cumsum(flips[:-1], dtype=np.uint8) & 1 == (state != OUTSIDE)  # parity outlives the overflow


def _summary(data: np.ndarray, state: int) -> tuple[int, int]:
    """The state in which a block ends that begins in `state`, and the brackets that it opens and doesn't close."""
    quotes, last = _quotes(data, state)
    out = _outside(data, quotes, state)
    inside = (len(quotes) + (state != OUTSIDE)) % 2
    return (ESCAPED if last else INSIDE) if inside else OUTSIDE, np.count_nonzero(_OPEN[data] & out) - np.count_nonzero(_CLOSE[data] & out)


def _all_summaries(data: np.ndarray) -> list[tuple[int, int]]:
    """_summary for each state, in one pass: what is inside strings in one state is outside in the other, and an escape matters only if
    the first byte is a backslash or a quote."""
    quotes, last = _quotes(data, OUTSIDE)
    out, opens, closes = _outside(data, quotes, OUTSIDE), _OPEN[data], _CLOSE[data]
    depth = np.count_nonzero(opens & out) - np.count_nonzero(closes & out)
    rest = np.count_nonzero(opens) - np.count_nonzero(closes) - depth
    within = ESCAPED if last else INSIDE
    ends = [(within, depth), (OUTSIDE, rest)] if len(quotes) % 2 else [(OUTSIDE, depth), (within, rest)]
    return [*ends, _summary(data, ESCAPED) if not len(data) or data[0] in (0x22, 0x5C) else ends[1]]


def _read(file, low: int, size: int) -> np.ndarray:
    file.seek(low)
    return np.frombuffer(file.read(size), np.uint8)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with opened(row["file"]) as file:
                data = _read(file, row["low"], row["high"] - row["low"])
            ends = _all_summaries(data)
            yield pa.RecordBatch.from_pylist([row | {"ends": [e for e, _ in ends], "depths": [d for _, d in ends]}], pa.schema([("file", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("ends", pa.list_(pa.int32())), ("depths", pa.list_(pa.int64()))]))


def _composed(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """State and depth at the beginning of each of a file's blocks: some bytes a block."""
    t = t.sort_by("block")
    state = depth = 0
    states, depths = [], []
    for ends, more in zip(t.column("ends").to_pylist(), t.column("depths").to_pylist(), strict=True):
        states.append(state)
        depths.append(depth)
        state, depth = ends[state], depth + more[state]
    return t.drop_columns(["ends", "depths"]).append_column("state", pa.array(states, pa.int32())).append_column("depth", pa.array(depths, pa.int64()))


class _Reader:
    """A block and as much behind it as the values need that begin in it."""

    def __init__(self, file, row: dict):
        self.file, self.row = file, row
        self.data, self.to = _read(file, row["low"], row["high"] - row["low"]), row["high"]
        self._mark(self.data, row["state"], row["depth"], 0)

    def _mark(self, data: np.ndarray, state: int, depth: int, base: int) -> None:
        """Note commas, colons and brackets outside strings, with the depth behind each."""
        quotes, last = _quotes(data, state)
        out = _outside(data, quotes, state)
        marks = np.flatnonzero(out & (_OPEN[data] | _CLOSE[data] | (data == 0x2C)))
        kind = data[marks]
        depths = depth + np.cumsum(_OPEN[kind].astype(np.int64) - _CLOSE[kind])
        self.state = (ESCAPED if last else INSIDE) if (len(quotes) + (state != OUTSIDE)) % 2 else OUTSIDE
        self.depth = int(depths[-1]) if len(depths) else depth
        new = (marks + base, kind, depths)
        self.marks, self.kind, self.depths = new if base == 0 else (np.concatenate(x) for x in zip((self.marks, self.kind, self.depths), new, strict=True))

    def more(self) -> bool:
        """Read on; False at the file's end."""
        data = _read(self.file, self.to, MORE)
        if not len(data):
            return False
        base = len(self.data)
        self.data, self.to = np.concatenate([self.data, data]), self.to + len(data)
        self._mark(data, self.state, self.depth, base)
        return True

    def values(self, level: int) -> Iterator[tuple[int, bytes, bool]]:
        """(place, text, whether it is whole) of the values of a depth that begin in the block: behind a bracket that opens to it or a
        comma there, up to the next comma there or the bracket that closes it."""
        block = self.row["high"] - self.row["low"]
        begins = lambda: self.marks[(_OPEN[self.kind] | (self.kind == 0x2C)) & (self.depths == level)]
        ends = lambda: self.marks[((self.kind == 0x2C) & (self.depths == level)) | (_CLOSE[self.kind] & (self.depths == level - 1))]
        starts, stops = begins(), ends()
        starts = starts[starts < block]
        while len(starts) and (not len(stops) or stops[-1] <= starts[-1]) and self.more():
            stops = ends()
        for at, i in zip(starts.tolist(), np.searchsorted(stops, starts, "right").tolist(), strict=True):
            whole = i < len(stops)
            yield at, self.data[at + 1 : stops[i] if whole else len(self.data)].tobytes().strip(_SPACE), whole

    def members(self) -> Iterator[tuple[int, tuple[str, bool, str | None, bool]]]:
        """(place, (name, whether it is an array, value, whether that is whole)) of the document's members that begin in the block."""
        block = self.row["high"] - self.row["low"]
        starts = self.marks[(_OPEN[self.kind] | (self.kind == 0x2C)) & (self.depths == 1)]
        for at in starts[starts < block].tolist():
            while (found := _HEAD.match(self.data[at + 1 : at + 1 + SMALL].tobytes())) is None and len(self.data) < at + 1 + SMALL and self.more():
                pass
            if found is None:
                continue
            array, begin = found[2] == b"[", at + 1 + found.start(2)
            end = self._end(1, at, begin + SMALL if array else None)
            value = None if array and end is None else self.data[begin : end or len(self.data)].tobytes().strip(_SPACE).decode("utf-8", "replace")
            yield at, (json.loads(found[1].decode("utf-8", "replace"), strict=False), array, value, end is not None)

    def _end(self, level: int, at: int, limit: int | None) -> int | None:
        """Where the value ends that begins behind `at`; None if not before the limit or the file's end."""
        while True:
            ends = self.marks[((self.kind == 0x2C) & (self.depths == level)) | (_CLOSE[self.kind] & (self.depths == level - 1))]
            i = int(np.searchsorted(ends, at, "right"))
            if i < len(ends):
                return int(ends[i]) if limit is None or ends[i] <= limit else None
            if (limit is not None and len(self.data) > limit) or not self.more():
                return None


_MEMBER = pa.schema([("file", pa.string()), ("place", pa.int64()), ("name", pa.string()), ("array", pa.bool_()), ("value", pa.string()), ("whole", pa.bool_())])
_ELEMENT = pa.schema([("file", pa.string()), ("name", pa.string()), ("place", pa.int64()), ("value", pa.string()), ("whole", pa.bool_()), ("about", pa.map_(pa.string(), pa.string()))])


def _rows(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of documents that begin in a block; a long array's value is left out."""
    for batch in batches:
        for row in batch.to_pylist():
            with opened(row["file"]) as file:
                held = [(row["file"], row["low"] + at, *member) for at, member in _Reader(file, row).members()]
            if held:
                yield _rows(held, _MEMBER)


def _elements(names: list[str] | None):
    """Elements of arrays that begin in a block, each with its document's other members (about)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held: list[tuple] = []
                members = sorted(row["members"], key=lambda m: m["place"])
                places = [m["place"] for m in members]
                with opened(row["file"]) as file:
                    for at, text, whole in _Reader(file, row).values(2):
                        of = members[bisect.bisect_right(places, row["low"] + at) - 1] if places and places[0] <= row["low"] + at else None
                        if text and of and of["array"] and (names is None or of["name"] in names):
                            held.append((row["file"], of["name"], row["low"] + at, text.decode("utf-8", "replace"), whole, row["about"]))
                        if len(held) == 1024:
                            yield _rows(held, _ELEMENT)
                            held = []
                if held:
                    yield _rows(held, _ELEMENT)

    return run


_CUT = "file string, size long, block long, low long, high long, ends array<int>, depths array<long>"


def _kept(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(working_table(df, name))


def _tasks(spread: DataFrame, size: int) -> int:
    """Into how many tasks blocks go: one each up to FEW or as many as shuffles have, then about TASK bytes in each."""
    n = spread.count()
    return max(1, min(n, max(FEW, int(spread.sparkSession.conf.get("spark.sql.shuffle.partitions")))), -(-n * size // max(size, TASK)))


def json_elements(files: DataFrame, names: list[str] | None = None, about: list[str] = (), block: int | None = None) -> DataFrame:
    """(file, name, place, value, whole, about) of JSON documents (file, size): one row for each element of the arrays that are members
    of a document and have one of the names; value is JSON, place a byte of the file, about maps some other members' names to their
    JSON, of arrays if they have up to SMALL bytes.

    A document that is cut off yields what it holds: the value at the cut has whole = false and is no JSON. Empty arrays, empty files
    and documents that aren't objects have no rows. Compressed files can't be read by ranges. The bytes are read three times."""
    spread = blocks(files, block or BLOCK)
    parts = _tasks(spread, block or BLOCK)
    known = spread.repartition(parts, "file", "block").mapInArrow(_summaries, _CUT).groupBy("file").applyInArrow(_composed, "file string, size long, block long, low long, high long, state int, depth long")
    known = _kept(known, "json_blocks")
    members = _kept(known.repartition(parts, "file", "block").mapInArrow(_members, "file string, place long, name string, array boolean, value string, whole boolean"), "json_members")
    told = F.collect_set(F.when(F.col("name").isin(*about) & F.col("whole") & F.col("value").isNotNull(), F.struct("name", "value")))
    of = members.groupBy("file").agg(F.collect_list(F.struct("place", "name", "array")).alias("members"), F.map_from_entries(told).alias("about"))  # a document has a handful of members
    return known.join(of, "file").repartition(parts, "file", "block").mapInArrow(_elements(names), "file string, name string, place long, value string, whole boolean, about map<string,string>")


def numbered(elements: DataFrame, name: str, block: int | None = None) -> DataFrame:
    """Elements with their number among those of their document, from 0: counted within blocks, and blocks summed up; so a document is
    as many tasks as it has blocks."""
    rows = elements.withColumn("_block", F.floor(F.col("place") / (block or BLOCK)))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("file", "_block").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("file", "_block").orderBy("place"))
    return rows.withColumn("_own", own).join(base.drop("_n"), ["file", "_block"]).withColumn(name, (F.col("_base") + F.col("_own") - 1).cast("int")).drop("_block", "_own", "_base")


def json_text(c: Column) -> Column:
    """A JSON scalar as a string: strings without their quotes."""
    return F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")[0]


def cut_off(files: DataFrame, block: int | None = None) -> DataFrame:
    """(file, truncated): whether a document's brackets aren't all closed at the file's end."""
    ends = blocks(files, block or BLOCK).mapInArrow(_summaries, _CUT).groupBy("file").applyInArrow(_ended, "file string, truncated boolean")
    return files.select("file").join(ends, "file", "left").select("file", F.coalesce("truncated", F.lit(True)).alias("truncated"))


def _ended(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    t = t.sort_by("block")
    state = depth = 0
    for ends, more in zip(t.column("ends").to_pylist(), t.column("depths").to_pylist(), strict=True):
        state, depth = ends[state], depth + more[state]
    return pa.table({"file": [key[0].as_py()], "truncated": [depth != 0 or state != OUTSIDE]})
