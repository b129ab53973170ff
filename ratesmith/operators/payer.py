"""The insurer side: which files and rows count, what their labels and codes mean, which systems they belong to."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.rules import tables as T
from ratesmith.sources.footers import footers
from ratesmith.sources.lake import working_table


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def payer_files(spark: SparkSession, path: str, required: list[str], duplicates: list[str] = (), vintage: str = "last_updated_on", vintages: dict[str, str] | None = None) -> DataFrame:
    """The Parquet files right under path: file, stem, carrier, network, bytes, vintage, missing (required columns it lacks) and
    skipped, the first reason to leave it out: in flight, duplicate, contract; null if it counts.

    A file's vintage is one that is given for its stem, else the least of its own. Footers are read by tasks; a file that is cut off or
    no Parquet lacks all columns. Rows are read in one scan of the files that have the column.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = [(str(s.getPath().toString()), s.getLen()) for s in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where) if s.isFile() and re.search(r"\.parquet(\.part)?$", s.getPath().getName())]
    there = spark.createDataFrame(listed, "file string, size long")
    held = spark.read.parquet(working_table(footers(there.where(F.col("file").endswith(".parquet"))).select("file", F.coalesce("columns", F.array().cast("array<string>")).alias("columns")), "footers"))
    lacks = F.array_sort(F.array_except(F.array(*map(F.lit, required)).cast("array<string>"), F.col("columns")))
    files = there.join(held, "file", "left").select("file", F.col("size").alias("bytes"), F.coalesce(lacks, F.array().cast("array<string>")).alias("missing"))
    files = files.withColumn("stem", F.regexp_extract("file", r"([^/]+?)\.parquet(\.part)?$", 1))
    carrier, network = X.split_label(F.col("stem"))
    dated = [r["file"] for r in held.where(F.array_contains("columns", vintage)).select("file").collect()]  # names only
    own = spark.createDataFrame([], "own_stem string, own string")
    if dated:
        stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.parquet$", 1)
        own = spark.read.parquet(*dated).groupBy(stem.alias("own_stem")).agg(F.min(F.col(vintage).cast("string")).alias("own"))
    given = spark.createDataFrame(list((vintages or {}).items()), "given_stem string, given string")
    out = files.join(own, F.col("stem") == F.col("own_stem"), "left").join(given, F.col("stem") == F.col("given_stem"), "left")
    skipped = F.when(F.col("file").endswith(".part"), "in flight").when(F.col("stem").isin(list(duplicates)), "duplicate").when(F.size("missing") > 0, "contract")
    return out.select("file", "stem", carrier.alias("carrier"), network.alias("network"), "bytes", F.coalesce("given", "own").alias("vintage"), "missing", skipped.alias("skipped"))


def open_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The rows of the files that count, with stem. There are few files: their names go through the driver."""
    names = [r["file"] for r in files.where("skipped IS NULL").select("file").collect()]
    return spark.read.parquet(*names).withColumn("stem", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.parquet$", 1))


def first_vintages(rows: DataFrame, payer: str, vintage: str) -> DataFrame:
    return rows.groupBy(payer).agg(F.min(vintage).alias(vintage))


def touches_system(c: Column, systems: list[str]) -> Column:
    """Whether a comma-joined list holds any of the names, as a part of it: a name inside another one counts too."""
    return reduce(lambda a, b: a | b, (c.contains(s) for s in systems))


def payer_filter(
    systems: list[str] = (), codes: list[str] = (), code_prefix: str = "", code_types: list[str] = (), untranslatable: bool = False,
    max_group_tins: int | None = None, min_rate: float = 0.0, exclusive: bool = True,
) -> Column:
    """Which payer rows are read. Code types that mean nothing elsewhere go unless untranslatable; a missing type stays."""
    c = F.col
    tests = [c("system_count") == 1] * exclusive + ([touches_system(c("systems"), list(systems))] if systems else []) + [c("billing_code").isin(list(codes))] * bool(codes)
    tests += [c("billing_code").startswith(code_prefix)] * bool(code_prefix) + [c("code_type").isin(list(code_types))] * bool(code_types)
    tests += [~F.coalesce(c("code_type").isin(T.UNTRANSLATABLE_TYPES), F.lit(False))] * (not untranslatable)
    tests += [] if max_group_tins is None else [c("group_tins") <= max_group_tins]
    return _all(tests + [c("negotiated_rate") >= min_rate] * (min_rate > 0))


def rate_filter(facilities: list = (), codes: list[str] = (), products: list[str] = (), code_types: list[str] = (), prefix: str = "") -> Column:
    """Which hospital rows are read: dollar rates over zero of the named facilities, codes, products, types and first characters."""
    c = F.col
    tests = [c("rate_kind") == "dollar", c("rate") > 0]
    tests += [c(name).isin(list(values)) for name, values in (("facility", facilities), ("code", codes), ("product_class", products), ("code_type", code_types)) if values]
    return _all(tests + [c("code").startswith(prefix)] * bool(prefix))


def only_in_partition(rows: DataFrame, outside: Column) -> bool:
    """Whether no row lies outside; stops at the first that does."""
    return rows.where(outside).limit(1).count() == 0


def code_scope(rows: DataFrame, codes: str, scope: DataFrame) -> DataFrame:
    """Rows of which any code is in scope for its family. codes: an array of (code, type); scope: family, code. A row comes once.

    Revenue codes are padded to four digits, others upper-cased. Rows get a place for the semi-join only, by their codes."""
    family = lambda t: X.code_family(t)
    key = lambda x: F.struct(family(x["type"]).alias("family"), F.when(family(x["type"]) == "revenue", X.padded_revenue(x["code"])).otherwise(X.code_key(x["code"])).alias("code"))
    asked = rows.select(codes).distinct().withColumn("_k", F.explode(F.transform(codes, key))).select(codes, "_k.family", "_k.code").where("family IS NOT NULL")
    met = asked.join(scope.select("family", "code"), ["family", "code"], "left_semi").select(codes).distinct()
    return rows.join(met, codes, "left_semi")


def fingerprint(scope: DataFrame) -> DataFrame:
    """16 hex digits that stand for a scope: its codes, and each family's, in order."""
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    each = scope.groupBy("family").agg(listed("code").alias("codes"))
    families = each.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("family", "codes"))), lambda x: F.concat_ws("=", x["family"], x["codes"])), ";").alias("families"))
    return scope.agg(listed("code").alias("codes")).join(families).select(F.substring(F.sha2(F.concat_ws("|", "codes", "families"), 256), 1, 16).alias("fingerprint"))


def systems_of(c: Column, exclusive: bool = True) -> Column:
    """Names of a comma-joined list; with exclusive, none if there are several."""
    names = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: X.stripped(x)), lambda x: x != "")
    return F.when(F.size(names) == 1, names).otherwise(F.array().cast("array<string>")) if exclusive else names


def by_system(rows: DataFrame, exclusive: bool = True) -> DataFrame:
    """One row for each system that a rate is attributed to; rates without one go."""
    return rows.withColumn("system", F.explode(systems_of(F.col("systems"), exclusive)))


def distinct_systems(rows: DataFrame) -> DataFrame:
    return by_system(rows, exclusive=False).groupBy("system").agg(F.count("*").alias("rows"))


def canonical_carrier(label: Column, aliases: dict[str, list[str]] = T.PAYER_ALIASES) -> Column:
    """The payer whose longest alias a label's letters begin with, of ties the first listed; else null."""
    letters = F.regexp_replace(F.lower(label), r"[^a-z]", "")
    ordered = sorted(((re.sub(r"[^a-z]", "", a.lower()), len(a), name) for name, each in aliases.items() for a in each), key=lambda x: -x[1])
    return F.coalesce(*(F.when(letters.startswith(a), name) for a, _, name in ordered))


def payer_rates(rows: DataFrame, exclusive: bool = True) -> DataFrame:
    """Payer rows in the terms of the hospital side: system, carrier, plan, setting, billing_class, rate_kind, product_class, rate."""
    carrier, network = X.split_label(F.col("label"))
    folded = X.folded(F.col("billing_class"))
    billing = F.coalesce(*(F.when(folded == a, b) for a, b in T.BILLING_CLASSES.items()))
    kind = F.when(X.folded(F.col("rate_type")) == "percentage", "percentage").otherwise("dollar")
    return by_system(rows, exclusive).withColumns({
        "carrier": F.coalesce(canonical_carrier(F.col("label")), carrier), "plan": network, "setting": X.place_setting(F.col("service_codes")), "billing_class": billing,
        "rate_kind": kind, "product_class": F.lit("commercial"), "rate": F.col("negotiated_rate"),
    })
