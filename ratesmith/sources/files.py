"""Readers of published price files, as DataFrames of raw rows."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import containers, ranges
from .lake import working_table

_PAYER = "payer_name: string, plan_name: string, standard_charge_dollar: string, standard_charge_percentage: string, standard_charge_algorithm: string, methodology: string"
_CHARGE = f"setting: string, billing_class: string, gross_charge: string, discounted_cash: string, payers_information: array<struct<{_PAYER}>>"
_ITEM = f"description: string, code_information: array<struct<code: string, type: string>>, standard_charges: array<struct<{_CHARGE}>>"
JSON_SCHEMA = f"hospital_name string, last_updated_on string, version string, location_name array<string>, standard_charge_information array<struct<{_ITEM}>>"
RAW = ["source_url", "hospital", "location_name", "file_vintage", "codes", "code", "code_type", "description", "setting", "billing_class", "gross_charge", "discounted_cash", "payer_name", "plan_name", "rate_dollar", "rate_percentage", "rate_algorithm", "methodology"]


def _first_code(codes: Column) -> dict[str, Column]:
    return {"code": F.try_element_at(codes, F.lit(1))["code"], "code_type": F.try_element_at(codes, F.lit(1))["type"]}


def read_price_json(spark: SparkSession, path: str, block: int | None = None) -> DataFrame:
    """One raw row for each payer of each charge of each item. A file is one JSON document, which is read by many tasks, block by block;
    a document that is cut off yields the items before the cut (ranges.cut_off tells which are). A compressed file is one task, and
    yields nothing if it is cut off."""
    found = ranges.listed(spark, path)
    packed = F.col("file").rlike(r"(?i)\.gz$")
    doc = ranges.json_elements(found.where(~packed), ["standard_charge_information"], ["hospital_name", "location_name", "last_updated_on"], block).where("whole")
    told = lambda n: ranges.json_text(F.try_element_at("about", F.lit(n)))
    places = F.array_join(F.from_json(F.try_element_at("about", F.lit("location_name")), "array<string>"), "|")
    head = doc.select(F.col("file").alias("source_url"), told("hospital_name").alias("hospital"), places.alias("location_name"), told("last_updated_on").alias("file_vintage"), F.from_json("value", f"struct<{_ITEM}>").alias("i"))
    if zipped := [r["file"] for r in found.where(packed).select("file").collect()]:
        whole = spark.read.schema(JSON_SCHEMA).option("multiLine", True).json(zipped)
        head = head.unionByName(whole.select(F.col("_metadata.file_path").alias("source_url"), F.col("hospital_name").alias("hospital"), F.array_join("location_name", "|").alias("location_name"), F.col("last_updated_on").alias("file_vintage"), F.explode("standard_charge_information").alias("i")))
    charge = head.withColumn("c", F.explode("i.standard_charges")).withColumn("p", F.explode("c.payers_information"))
    out = charge.select(
        "source_url", "hospital", "location_name", "file_vintage", F.col("i.code_information").alias("codes"), F.col("i.description").alias("description"), "c.setting", "c.billing_class", "c.gross_charge", "c.discounted_cash",
        "p.payer_name", "p.plan_name", F.col("p.standard_charge_dollar").alias("rate_dollar"), F.col("p.standard_charge_percentage").alias("rate_percentage"), F.col("p.standard_charge_algorithm").alias("rate_algorithm"), "p.methodology",
    )
    return out.withColumns(_first_code(F.col("codes"))).select(*RAW)


#: Bytes in which a file's header is looked for, and rows of a zip archive's member.
HEAD_BYTES, HEAD_LINES = 1 << 18, 64
_HEADS = "file string, header array<string>, rows array<array<string>>, about map<string,string>, skipped string"


def _head(text: str) -> dict:
    """Of a file's first rows: the header, the rows up to it, and what the first two say about the file. A file without a header is
    skipped."""
    rows = [[c or None for c in r] for r in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")) if r]
    at = next((i for i, r in enumerate(rows) if any(c and (c.strip().lower() == "description" or c.strip().startswith("code|")) for c in r)), None)
    if at is None:
        return {"header": None, "rows": None, "about": None, "skipped": "no header"}
    header = [h.strip() if h else f"_blank{i}" for i, h in enumerate(rows[at])]
    header = [h if h not in header[:i] else f"_blank{i}" for i, h in enumerate(header)]  # of columns with one name the first counts
    about = {k.strip(): v for k, v in zip(rows[0], rows[1], strict=False) if k and v} if at >= 2 else {}
    return {"header": header, "rows": [(r + [None] * len(header))[: len(header)] for r in rows[: at + 1]], "about": about, "skipped": None}


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The head of each file, from its first bytes."""
    text = pa.string()
    schema = pa.schema([("file", text), ("header", pa.list_(text)), ("rows", pa.list_(pa.list_(text))), ("about", pa.map_(text, text)), ("skipped", text)])
    for batch in batches:
        for file in batch.column("file").to_pylist():
            with ranges.opened(file) as raw:
                data = raw.read(HEAD_BYTES)
            whole = data if len(data) < HEAD_BYTES else data[: data.rfind(b"\n") + 1]
            yield pa.RecordBatch.from_pylist([{"file": file, **_head(whole.decode("utf-8", "replace"))}], schema)


def price_heads(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, rows, about, skipped) of the CSV files of a path, all heads in one job: the columns, the rows up to and with the
    header, what the first rows say about the file. skipped: why a file isn't read (it has no header in its first HEAD_BYTES)."""
    found = ranges.listed(spark, path).where(~F.col("file").rlike(r"(?i)\.zip$")).select("file")
    return found.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file").mapInArrow(_first_rows, _HEADS)


def _csv(spark: SparkSession, path: str, multi_line: bool = False) -> list[DataFrame]:
    """The tables under the files' headers, one for each header that occurs, with _file and _about. Files without a header are left out;
    price_heads() names them.

    multi_line: cells may have line breaks; a file then is one task."""
    heads = spark.read.schema(_HEADS).parquet(working_table(price_heads(spark, path), "price_heads"))
    out = []
    for r in heads.where("skipped IS NULL").groupBy("header").agg(F.collect_list("file").alias("files")).collect():  # names only
        header = r["header"]
        rows = spark.read.schema(", ".join(f"`{h}` string" for h in header)).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line).csv(r["files"])
        at = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")
        rows = rows.select("*", at.alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_first"))
        about = heads.where(F.col("header") == F.array(*map(F.lit, header))).select(F.col("file").alias("_file"), F.col("rows").alias("_heads"), F.col("about").alias("_about"))
        # head rows stand in a file's first split; a row goes if it is one of them in every cell
        same = F.exists("_heads", lambda h: h.eqNullSafe(F.array(*(F.col(f"`{c}`") for c in header))))
        body = rows.join(about, "_file").where(~(F.col("_first") & same))
        out.append(body.drop("_first", "_heads", *(h for h in header if h.startswith("_blank"))))
    for file in [r["file"] for r in ranges.listed(spark, path).where(F.col("file").rlike(r"(?i)\.zip$")).select("file").collect()]:
        out += _zipped(spark, file)
    if not out:
        raise FileNotFoundError(f"no file with a header in {path}")
    return out


def read_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the members of zip files: file, member, line (from 0), value. A task has one archive, which is decoded from the front,
    line by line; one that is cut off gives what it holds."""
    return containers.read_lines(ranges.listed(spark, path)).where("member <> ''")


def _zipped(spark: SparkSession, file: str) -> list[DataFrame]:
    """The tables of an archive's members, one for each header; members without a header are left out."""
    rows, first, of = read_zip_lines(spark, file), {}, {}
    for r in rows.where(F.col("line") < HEAD_LINES).orderBy("member", "line").collect():  # some lines of each member
        first.setdefault(r["member"], []).append(r["value"])
    for member, lines in first.items():
        head = _head("\n".join(lines))
        if head["header"]:
            at = next(i for i in range(len(lines)) if _head("\n".join(lines[: i + 1]))["header"])
            of.setdefault(tuple(head["header"]), []).append((member, at, head["about"]))
    out = []
    for header, members in of.items():
        about = spark.createDataFrame(members, "member string, at long, _about map<string,string>")
        body = rows.join(about, "member").where((F.col("line") > F.col("at")) & (F.trim("value") != ""))
        body = body.select(F.from_csv("value", ", ".join(f"`{h}` string" for h in header), {"escape": '"'}).alias("r"), F.concat_ws("!", "file", "member").alias("_file"), "_about")
        out.append(body.select(*(F.col(f"r.`{h}`") for h in header if not h.startswith("_blank")), "_file", "_about"))
    return out


def _columns(df: DataFrame) -> tuple[DataFrame, Column]:
    numbers = sorted(c.split("|")[1] for c in df.columns if c.startswith("code|") and c.count("|") == 1)
    codes = F.filter(F.array(*(F.struct(F.col(f"`code|{n}`").alias("code"), F.col(f"`code|{n}|type`").alias("type")) for n in numbers)), lambda x: x["code"].isNotNull())
    told = lambda n: F.try_element_at("_about", F.lit(n))
    head = {"source_url": F.col("_file"), "hospital": told("hospital_name"), "location_name": told("location_name"), "file_vintage": told("last_updated_on")}
    return df.withColumns(head), codes


def _each(spark: SparkSession, path: str, multi_line: bool, make) -> DataFrame:
    return reduce(DataFrame.unionByName, map(make, _csv(spark, path, multi_line)))


def _maybe(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def read_price_tall(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One rate a row, codes in code|n and code|n|type. Of a folder each file has its own head; zip files are read member by member."""
    return _each(spark, path, multi_line, _tall)


def _tall(body: DataFrame) -> DataFrame:
    df, codes = _columns(body)
    v = lambda n: _maybe(df, f"standard_charge|{n}")
    out = df.select(
        "source_url", "hospital", "location_name", "file_vintage", codes.alias("codes"), _maybe(df, "description").alias("description"), _maybe(df, "setting").alias("setting"), _maybe(df, "billing_class").alias("billing_class"),
        v("gross").alias("gross_charge"), v("discounted_cash").alias("discounted_cash"), _maybe(df, "payer_name").alias("payer_name"), _maybe(df, "plan_name").alias("plan_name"),
        v("negotiated_dollar").alias("rate_dollar"), v("negotiated_percentage").alias("rate_percentage"), v("negotiated_algorithm").alias("rate_algorithm"), v("methodology").alias("methodology"),
    )
    return out.withColumns(_first_code(F.col("codes"))).select(*RAW)


def unpivot_wide(df: DataFrame, ids: list[str], prefix: str = "standard_charge") -> DataFrame:
    """prefix|payer|plan|measure columns as rows (ids, payer_name, plan_name, measure, value) of the values that aren't blank."""
    wide = [c for c in df.columns if c.startswith(f"{prefix}|") and c.count("|") == 3]
    long = df.unpivot(ids, [F.col(f"`{c}`") for c in wide], "_column", "value").where("trim(value) <> ''")
    part = lambda i: F.split_part("_column", F.lit("|"), F.lit(i))
    return long.select(*ids, part(2).alias("payer_name"), part(3).alias("plan_name"), part(4).alias("measure"), "value")


def read_price_wide(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row an item, a column for each payer, plan and measure; one raw row for each of those with a value."""
    return _each(spark, path, multi_line, _wide)


def _wide(body: DataFrame) -> DataFrame:
    df, codes = _columns(body)
    df = df.select("*", codes.alias("codes"), *(_maybe(df, c).alias(f"_{c}") for c in ("setting", "billing_class", "description")), _maybe(df, "standard_charge|gross").alias("gross_charge"), _maybe(df, "standard_charge|discounted_cash").alias("discounted_cash"))
    long = unpivot_wide(df, ["source_url", "hospital", "location_name", "file_vintage", "codes", "_setting", "_billing_class", "_description", "gross_charge", "discounted_cash"])
    of = lambda m: F.when(F.col("measure") == m, F.col("value"))
    out = long.where(F.col("measure").isin("negotiated_dollar", "negotiated_percentage", "negotiated_algorithm")).withColumns({
        "rate_dollar": of("negotiated_dollar"), "rate_percentage": of("negotiated_percentage"), "rate_algorithm": of("negotiated_algorithm"), "methodology": F.lit(None).cast("string"),
        "setting": F.col("_setting"), "billing_class": F.col("_billing_class"), "description": F.col("_description"),
    })
    return out.withColumns(_first_code(F.col("codes"))).select(*RAW)


def _blocks(text: str) -> list[dict[str, str]]:
    out: list[dict[str, str]] = [{}]
    for line in text.splitlines():
        key, colon, value = line.partition(":")
        key = key.strip().lower()
        if not colon or key in out[-1]:
            out.append({})
        if colon:
            out[-1][key] = value.strip()
    return [x for x in out if x]


def read_index_files(spark: SparkSession, path: str) -> DataFrame:
    """cms-hpt.txt: key: value blocks, a new one at a blank line or a repeated key. One row a block: source_url, block, fields (a map).

    A block ends where a key of its own comes again, which only a fold over the lines knows; the files are of a few lines each."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_url"), F.udf(_blocks, "array<map<string,string>>")("value").alias("blocks"))
    return whole.select("source_url", F.posexplode("blocks").alias("block", "fields"))


def contract_report(rows: DataFrame, file: str, label: str, required: list[str], least: dict[str, float], constant: list[str], dates: list[str]) -> DataFrame:
    """Violations by file and rule, from one aggregate: nulls in required columns, values under their least, columns that should
    be constant and aren't, dates that aren't ISO, a label that isn't the file's name. Rows: file, rule, violations."""
    stem = F.regexp_replace(F.regexp_replace(F.col(file), r"^.*/", ""), r"\.parquet$", "")
    counts = {f"null:{c}": F.count_if(F.col(c).isNull()) for c in required}
    counts |= {f"below:{c}": F.count_if(F.col(c) < v) for c, v in least.items()}
    counts |= {f"varies:{c}": F.greatest(F.countDistinct(c) - 1, F.lit(0)) for c in constant}
    counts |= {f"date:{c}": F.count_if(~F.coalesce(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))) for c in dates}
    counts |= {"label": F.count_if(~stem.eqNullSafe(F.col(label)))}
    wide = rows.groupBy(F.col(file).alias("file")).agg(*(c.alias(k) for k, c in counts.items()))
    return wide.unpivot("file", [F.col(f"`{k}`") for k in counts], "rule", "violations").where("violations > 0")
