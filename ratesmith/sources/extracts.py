"""Readers of insurers' in-network files, of facility lists and of summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranges
from .lake import exists, working_table

_PRICE = "negotiated_type: string, negotiated_rate: double, expiration_date: string, service_code: array<string>, billing_class: string, billing_code_modifier: array<string>"
_RATES = f"array<struct<provider_references: array<long>, negotiated_prices: array<struct<{_PRICE}>>>>"
_CODES = "array<struct<billing_code_type: string, billing_code: string>>"
_GROUPS = "array<struct<npi: array<string>, tin: struct<type: string, value: string>>>"
_GROUP = f"struct<provider_group_id: long, provider_groups: {_GROUPS}>"
_ITEM = f"struct<negotiation_arrangement: string, name: string, billing_code_type: string, billing_code: string, description: string, bundled_codes: {_CODES}, negotiated_rates: {_RATES}>"
IN_NETWORK = f"reporting_entity_name string, last_updated_on string, provider_references array<{_GROUP}>, in_network array<{_ITEM}>"


def read_in_network(spark: SparkSession, path: str, block: int | None = None) -> dict[str, DataFrame]:
    """items, groups and prices of in-network files, from one reading of each document by many tasks, block by block.

    items: source_file, item_idx, arrangement, code_type, code, description, bundled_rcs; groups: source_file, gid, npis, tins;
    prices: source_file, item_idx, refs, negotiated_type, rate, billing_class, service_codes, modifiers. A document that is cut off
    yields what it holds; a compressed one is one task, and yields nothing then."""
    found, packed = ranges.listed(spark, path), F.col("file").rlike(r"(?i)\.gz$")
    read = spark.read.parquet(working_table(ranges.json_elements(found.where(~packed), ["in_network", "provider_references"], block=block).where("whole").drop("about"), "in_network"))
    name = F.regexp_extract("file", r"([^/]+)$", 1).alias("source_file")
    item = ranges.numbered(read.where("name = 'in_network'"), "item_idx", block).select(name, "item_idx", F.from_json("value", _ITEM).alias("i"))
    group = read.where("name = 'provider_references'").select(name, F.from_json("value", _GROUP).alias("g"))
    if zipped := [r["file"] for r in found.where(packed).select("file").collect()]:
        doc = spark.read.schema(IN_NETWORK).option("multiLine", True).json(zipped).withColumn("source_file", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))
        item = item.unionByName(doc.select("source_file", F.posexplode("in_network").alias("item_idx", "i")))
        group = group.unionByName(doc.select("source_file", F.explode("provider_references").alias("g")))
    bundled = F.transform(F.filter("i.bundled_codes", lambda c: c["billing_code_type"] == "RC"), lambda c: c["billing_code"])
    items = item.select(
        "source_file", "item_idx", F.col("i.negotiation_arrangement").alias("arrangement"), F.col("i.billing_code_type").alias("code_type"), F.col("i.billing_code").alias("code"),
        F.coalesce("i.description", "i.name").alias("description"), bundled.alias("bundled_rcs"),
    )
    npis, tins = F.array_distinct(F.flatten(F.col("g.provider_groups.npi"))), F.array_distinct(F.col("g.provider_groups.tin.value"))
    groups = group.select("source_file", F.col("g.provider_group_id").alias("gid"), npis.alias("npis"), tins.alias("tins"))
    rate = item.select("source_file", "item_idx", F.explode("i.negotiated_rates").alias("r")).select("source_file", "item_idx", F.col("r.provider_references").alias("refs"), F.explode("r.negotiated_prices").alias("p"))
    prices = rate.select("source_file", "item_idx", "refs", "p.negotiated_type", F.col("p.negotiated_rate").alias("rate"), "p.billing_class", F.col("p.service_code").alias("service_codes"), F.col("p.billing_code_modifier").alias("modifiers"))
    return {"items": items, "groups": groups, "prices": prices}


def rescan(extract: dict[str, DataFrame], codes: DataFrame, gids: DataFrame, billing_class: str = "professional") -> DataFrame:
    """Prices of one billing class for some codes (code_type, code) and groups (source_file, gid), one row for each of those groups."""
    items = extract["items"].join(codes, ["code_type", "code"], "left_semi").select("source_file", "item_idx", "code_type", "code")
    prices = extract["prices"].where(F.col("billing_class") == billing_class).withColumn("gid", F.explode("refs")).drop("refs")
    return prices.join(gids, ["source_file", "gid"], "left_semi").join(items, ["source_file", "item_idx"])


def read_facilities(spark: SparkSession, path: str, acute_only: bool = True) -> DataFrame:
    """ccn, name, city, state, county, hospital_type of a facility list; rows without id or name go."""
    names = {"Facility ID": "ccn", "Facility Name": "name", "City/Town": "city", "State": "state", "County/Parish": "county", "Hospital Type": "hospital_type"}
    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(*(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(n) for c, n in names.items())).where("ccn <> '' AND name <> ''")
    return rows.where(F.lower("hospital_type").contains("acute")) if acute_only else rows


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of which all columns are text; path may be a pattern."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_summary(spark: SparkSession, folder: str, schemas: dict[str, str]) -> tuple[dict[str, DataFrame], list[str]]:
    """Summary tables by name, each with its schema; a table that isn't there is empty, and named in the list."""
    there = {name: exists(spark, f"{folder}/{name}.csv") or exists(spark, f"{folder}/{name}") for name in schemas}
    path = lambda name: f"{folder}/{name}.csv" if exists(spark, f"{folder}/{name}.csv") else f"{folder}/{name}"
    tables = {name: spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path(name)) if there[name] else spark.createDataFrame([], schema) for name, schema in schemas.items()}
    return tables, sorted(name for name, found in there.items() if not found)
