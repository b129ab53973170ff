"""Workbooks and text tables as rows of cells, made in tasks; whole tables out of cells by grouping and windows.

A cell is (file, member, depth, place, sheet, row, col, value): member is the table's path inside its archives, depth how many archives
it lies in, place and sheet a worksheet's place and name (0 and null for text), row and col count from 0, value is text. Blank cells
have no row.
"""

from __future__ import annotations

import csv
import io
import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges

SHEET = ["file", "member", "depth", "place", "sheet"]
_CELL = pa.schema([("file", pa.string()), ("member", pa.string()), ("depth", pa.int32()), ("place", pa.int32()), ("sheet", pa.string()), ("row", pa.int64()), ("col", pa.int32()), ("value", pa.string()), ("error", pa.string())])
_DDL = "file string, member string, depth int, place int, sheet string, row long, col int, value string, error string"
#: Rows of a sheet whose windows are one task's.
ROWS = 1 << 16
#: Characters of a text table that are looked at for tabs.
HEAD = 1 << 16

# Names of the Office Open XML format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_BOOK, _RELS, _STRINGS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"


def _each(stream, tag: str, above: str) -> Iterator[ET.Element]:
    """The elements of a kind as they are read; what lies behind is let go."""
    parent = None
    for event, e in ET.iterparse(stream, ("start", "end")):
        if event == "start" and e.tag == _MAIN + above:
            parent = e
        elif event == "end" and e.tag == _MAIN + tag and parent is not None:
            yield e
            parent.clear()


def _text(e: ET.Element) -> str:
    """A string's runs; phonetic hints aren't part of it."""
    return "".join(t.text or "" for part in e if part.tag in (_MAIN + "t", _MAIN + "r") for t in ([part] if part.tag == _MAIN + "t" else part.findall(_MAIN + "t")))


def _column(ref: str) -> int:
    n = 0
    for x in ref:
        if not x.isalpha():
            break
        n = n * 26 + ord(x.upper()) - 64
    return n - 1


def _value(c: ET.Element, strings: pa.Array) -> str | None:
    kind, v = c.get("t"), c.find(_MAIN + "v")
    if kind == "inlineStr":
        inside = c.find(_MAIN + "is")
        return None if inside is None else _text(inside)
    if v is None or v.text is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(v.text)].as_py()
    return {"1": "TRUE", "0": "FALSE"}.get(v.text, v.text) if kind == "b" else v.text


def _workbook(book: zipfile.ZipFile) -> Iterator[tuple[int, str, int, int, str]]:
    """(place, sheet, row, col, value) of a workbook's cells. Its distinct strings are held, as bytes; rows pass one by one."""
    inside = set(book.namelist())
    strings = pa.array([], pa.string())
    if _STRINGS in inside:
        with book.open(_STRINGS) as f:
            strings = pa.array((_text(e) for e in _each(f, "si", "sst")), pa.large_string())
    links = {r.get("Id"): r.get("Target", "") for r in ET.fromstring(book.read(_RELS))}
    for place, s in enumerate(ET.fromstring(book.read(_BOOK)).iter(_MAIN + "sheet")):
        target = links.get(s.get(_REL + "id"), "")
        part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
        if part not in inside:  # a chart's sheet
            continue
        with book.open(part) as f:
            row = -1
            for r in _each(f, "row", "sheetData"):
                row = int(r.get("r")) - 1 if r.get("r") else row + 1
                col = -1
                for c in r.iter(_MAIN + "c"):
                    col = _column(c.get("r")) if c.get("r") else col + 1
                    if value := _value(c, strings):
                        yield place, s.get("name"), row, col, value


def _table(raw, name: str) -> Iterator[tuple[int, None, int, int, str]]:
    """Cells of a text table. Tabs part them where one of its first lines has one (in files named .csv: the first), else commas;
    quotes may hold both and line ends."""
    csv.field_size_limit(1 << 30)
    text = io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline="")
    first = [text.readline()] if name.lower().endswith(".csv") else text.readlines(HEAD)
    rows = csv.reader((x.replace("\0", "") for part in (first, text) for x in part), delimiter="\t" if any("\t" in x for x in first) else ",")
    for row, cells in enumerate(rows):
        for col, value in enumerate(cells):
            if value:
                yield 0, None, row, col, value


def _walk(raw, file: str, name: str, depth: int) -> Iterator[tuple]:
    """(member, depth, place, sheet, row, col, value, error) of everything in a file. An archive inside an archive is held in memory."""
    try:
        packed = zipfile.is_zipfile(raw)
        raw.seek(0)
        if not packed:
            yield from ((name, depth, *cell, None) for cell in _table(raw, name or file))
            return
        with zipfile.ZipFile(raw) as z:
            if _BOOK in z.namelist():
                yield from ((name, depth, *cell, None) for cell in _workbook(z))
                return
            for inner in sorted(z.namelist()):
                path = f"{name}!{inner}" if name else inner
                if inner.lower().endswith((".zip", ".xlsx", ".xlsm")):
                    yield from _walk(io.BytesIO(z.read(inner)), file, path, depth + inner.lower().endswith(".zip"))
                elif inner.lower().endswith((".txt", ".csv", ".tsv", ".tab")):
                    with z.open(inner) as f:
                        yield from ((path, depth, *cell, None) for cell in _table(f, inner))
    except (zipfile.BadZipFile, ET.ParseError, KeyError, IndexError, ValueError, RuntimeError, NotImplementedError, csv.Error, EOFError) as e:
        yield name, depth, 0, None, None, None, None, f"{type(e).__name__}: {e}"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CELL, strict=True)], schema=_CELL)

    for batch in batches:
        for file in batch.column("file").to_pylist():
            with ranges.opened(file) as raw:
                held = []
                for cell in _walk(raw, file, "", 0):
                    held.append((file, *cell))
                    if len(held) == 8192:
                        yield made(held)
                        held = []
                if held:
                    yield made(held)


def read(files: DataFrame) -> DataFrame:
    """Cells of workbooks, text tables and archives of them (file), and a row with an error for each that can't be read to its end:
    what it holds before is given. A file is one task's; it is read as it goes, but for a workbook's distinct strings and for
    archives inside archives. Dates are the numbers that the file has, formulas what was last computed, cells in error are blank."""
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file").repartition(n, F.col("file")).mapInArrow(_cells, _DDL)


def cells(found: DataFrame) -> DataFrame:
    return found.where("error IS NULL").drop("error")


def problems(found: DataFrame) -> DataFrame:
    """(file, member, error) of what couldn't be read."""
    return found.where("error IS NOT NULL").select("file", "member", "error")


def own_name() -> Column:
    """A table's name in the archive that it lies in; a file's name if it is in none."""
    return F.when(F.col("member") == "", F.element_at(F.split("file", "/"), -1)).otherwise(F.element_at(F.split("member", "!"), -1))


def is_correction() -> Column:
    """Whether a table's own name says that it is a correction notice."""
    name = F.concat(F.lit(" "), F.lower(own_name()), F.lit(" "))
    return name.contains("-cn ") | name.contains(" cn ") | name.contains("correction")


def chosen(found: DataFrame, contains: str = "", suffix: str = "", prefer_correction: bool = True) -> DataFrame:
    """The cells of one table of each file: of those whose own name has a part and an end, one in the fewest archives; a correction
    notice before the publication that it corrects, or after it; then the first by name."""
    name, notice = F.lower(own_name()), is_correction()
    named = found.where(name.contains(contains.lower()) & name.endswith(suffix))
    best = named.groupBy("file").agg(F.min(F.struct("depth", (~notice if prefer_correction else notice).alias("later"), "member")).alias("_best"))
    return named.join(best, "file").where(F.col("member") == F.col("_best.member")).drop("_best")


def normalised(c: Column) -> Column:
    """A caption without line ends, hard spaces, the marks of footnotes before it, and case."""
    return F.lower(F.trim(F.regexp_replace(F.trim(F.regexp_replace(c, "[\\s ]+", " ")), r"^[\d,\s]+", "")))


def number(c: Column) -> Column:
    """A number that may have money, percent and thousands marks; null for anything else."""
    n = F.regexp_replace(c, "[$,%\\s ]", "").try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)


def headers(found: DataFrame, caption: str, least: int = 3) -> DataFrame:
    """(sheet's key, header): the first row of each sheet that has a caption and at least so many filled cells; a title has one."""
    by_row = found.groupBy(*SHEET, "row").agg(F.count_if(F.trim("value") != "").alias("_filled"), F.max(normalised(F.col("value")).contains(caption.lower())).alias("_has"))
    return by_row.where(F.col("_has") & (F.col("_filled") >= least)).groupBy(*SHEET).agg(F.min("row").alias("header"))


def _same_sheet() -> Column:
    met = F.lit(True)
    for k in SHEET:
        met = met & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return met


def _with_sheet(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of sheets with what is known of their sheet. Text tables have no sheet's name, so keys may be null."""
    extra = [c for c in right.columns if c not in SHEET]
    return left.alias("a").join(right.alias("b"), _same_sheet(), how).select("a.*", *(F.col(f"b.{c}") for c in extra))


def columns(found: DataFrame, caption: str, wanted: dict[str, list[str]]) -> DataFrame:
    """(sheet's key, header, at_<name>...): the first column whose caption in the header has all phrases of a name; null where none has."""
    heads = _with_sheet(found, headers(found, caption)).where("row = header").withColumn("_caption", normalised(F.col("value")))

    def first(phrases: list[str]) -> Column:
        met = F.lit(True)
        for p in phrases:
            met = met & F.col("_caption").contains(p.lower())
        return F.min(F.when(met, F.col("col")))

    return heads.groupBy(*SHEET, "header").agg(*(first(p).alias(f"at_{n}") for n, p in wanted.items()))


def table(found: DataFrame, caption: str, wanted: dict[str, list[str]]) -> DataFrame:
    """(sheet's key, row, a column for each name): rows below the header, trimmed, null where blank. Sheets without the header, or
    without one of the columns, give none; layout() tells which."""
    places = columns(found, caption, wanted).dropna(subset=[f"at_{n}" for n in wanted])
    body = _with_sheet(found, places).where(F.col("row") > F.col("header"))
    body = body.where(F.col("col").isin(*(F.col(f"at_{n}") for n in wanted)))
    return body.groupBy(*SHEET, "row").agg(*(F.max(F.when(F.col("col") == F.col(f"at_{n}"), F.nullif(F.trim("value"), F.lit("")))).alias(n) for n in wanted))


def layout(found: DataFrame, caption: str, wanted: dict[str, list[str]]) -> DataFrame:
    """(sheet's key, header, missing) of every sheet: its header's row, null if none has the caption, and the names it has no column for."""
    lacks = F.array_compact(F.array(*(F.when(F.col(f"at_{n}").isNull(), F.lit(n)) for n in wanted)))
    return _with_sheet(found.select(*SHEET).distinct(), columns(found, caption, wanted), "left").select(*SHEET, "header", lacks.alias("missing"))


def rows(found: DataFrame, names: list[str | None]) -> DataFrame:
    """(sheet's key, row, a column for each name): the first columns of all rows by their places; a name that is null leaves one out."""
    at = {n: i for i, n in enumerate(names) if n}
    part = found.where(F.col("col").isin(list(at.values())))
    return part.groupBy(*SHEET, "row").agg(*(F.max(F.when(F.col("col") == i, F.nullif(F.trim("value"), F.lit("")))).alias(n) for n, i in at.items()))


def carried_down(df: DataFrame, value: str, size: int = ROWS) -> DataFrame:
    """df with the last value that isn't null at or above each row of its sheet. Sheets of any length: blocks of rows are windows of
    their own, and begin with what the blocks above end with."""
    df = df.withColumn("_block", F.floor(F.col("row") / size))
    ends = df.groupBy(*SHEET, "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("row"))).alias("_end"))
    above = F.last("_end", ignorenulls=True).over(Window.partitionBy(*SHEET).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("_above", above).drop("_end")
    met = df.alias("a").join(ends.alias("b"), _same_sheet() & (F.col("a._block") == F.col("b._block"))).select("a.*", "b._above")
    here = F.last(value, ignorenulls=True).over(Window.partitionBy(*SHEET, "_block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn(value, F.coalesce(here, "_above")).drop("_block", "_above")


def numbered_tables(found: DataFrame, start: str, length: int) -> DataFrame:
    """Cells below captions that begin in one way, with the table's own: that many characters of the first such cell of a row."""
    caption = F.when(normalised(F.col("value")).startswith(start), F.substring(normalised(F.col("value")), 1, length))
    by_row = found.groupBy(*SHEET, "row").agg(F.min_by(caption, F.when(caption.isNotNull(), F.col("col"))).alias("caption"))
    titles = by_row.withColumn("_title", F.col("caption").isNotNull())
    below = carried_down(titles, "caption").where("caption IS NOT NULL AND NOT _title")
    return found.alias("a").join(below.alias("b"), _same_sheet() & (F.col("a.row") == F.col("b.row"))).select("a.*", "b.caption")


# writing


def _column_name(i: int) -> str:
    name = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        name = chr(65 + r) + name
    return name


def _escaped(x: str) -> str:
    return x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path.removeprefix("file:"))
        fs.create_dir(where, recursive=True)
        name = out = book = part = None
        n = 0

        def end() -> pa.RecordBatch:
            part.write(b"</sheetData></worksheet>")
            part.close()
            book.close()
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{path}/{name}.xlsx"], "rows": [n]}, pa.schema([("file", pa.string()), ("rows", pa.int64())]))

        for batch in batches:
            for book_name, sheet, cells in zip(*(batch.column(c).to_pylist() for c in ("book", "sheet", "cells")), strict=True):
                if book_name != name:
                    if name is not None:
                        yield end()
                    name, n = book_name, 0
                    out = fs.open_output_stream(f"{where}/{name}.xlsx")
                    book = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    main, rel = _MAIN[1:-1], _REL[1:-1]
                    book.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
                    book.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
                    book.writestr(_RELS, f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
                    book.writestr(_BOOK, f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{_escaped(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
                    part = book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
                    part.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
                n += 1
                each = "".join(f'<c r="{_column_name(i)}{n}" t="inlineStr"><is><t xml:space="preserve">{_escaped(x)}</t></is></c>' for i, x in enumerate(cells) if x is not None)
                part.write(f'<row r="{n}">{each}</row>'.encode())
        if name is not None:
            yield end()

    return run


def write_workbooks(df: DataFrame, path: str) -> DataFrame:
    """(file, rows) of the workbooks that are written below a path, one for each book of df (book, sheet, row, cells); a row's cells
    are an array of texts. A book is one task's, which writes row after row; a task that runs again writes the same file again."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, "book").sortWithinPartitions("book", "row").select("book", "sheet", "cells").mapInArrow(_write(path), "file string, rows long")
