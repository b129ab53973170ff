"""From raw price rows to curated rates: rejects, product, vintage, hash; what is newest of a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.rules import tables as T

from .aggregate import first_rows

HASHED = ["source_url", "payer_name", "plan_name", "code", "code_type", "setting", "billing_class", "rate_dollar", "rate_percentage", "rate_algorithm"]


def reject_reason(product: Column) -> Column:
    """The first rule that a raw row of this product breaks, else null."""
    has = lambda c: X.folded(F.col(c)) != ""
    dollar, percent = X.to_decimal(F.col("rate_dollar")), X.to_decimal(F.col("rate_percentage"))
    checks = [
        ("missing_payer", ~has("payer_name")),
        ("non_payer_row", product == "non_payer"),
        ("missing_code", ~has("code")),
        ("missing_vintage", X.parse_date(F.col("file_vintage")).isNull()),
        ("no_rate_value", ~has("rate_dollar") & ~has("rate_percentage") & ~has("rate_algorithm")),
        ("non_numeric_rate", has("rate_dollar") & dollar.isNull()),
        ("negative_rate", has("rate_dollar") & (dollar < 0)),
        ("implausible_rate", has("rate_dollar") & (dollar > T.MAX_DOLLAR)),
        ("non_numeric_rate", has("rate_percentage") & percent.isNull()),
        ("percentage_out_of_range", has("rate_percentage") & ~percent.between(0, T.MAX_PERCENT)),
    ]
    return F.coalesce(*(F.when(F.coalesce(test, F.lit(False)), F.lit(reason)) for reason, test in checks))


def curate(raw: DataFrame) -> DataFrame:
    """All raw rows with reject (null: curated), keys, product class, rate kind and numbers, vintage partition and row hash.

    Split by `reject IS NULL`; both halves come from one scan if the caller writes them partitioned by that."""
    dollar, percent = X.to_decimal(F.col("rate_dollar")), X.to_decimal(F.col("rate_percentage"))
    # names are normalised once, and so is their product found: Spark leaves columns alone that are dear and used more than once
    named = raw.withColumns({"_payer": X.normalise_name(F.col("payer_name")), "_plan": X.normalise_name(F.col("plan_name"))})
    named = named.withColumn("_product", X.product_of(F.col("_payer"), F.col("_plan")))
    return named.withColumns({
        "reject": reject_reason(F.col("_product")), "row_hash": X.row_hash(*(F.col(c) for c in HASHED)), "payer_key": F.lower("_payer"),
        "plan_key": F.nullif(F.lower("_plan"), F.lit("")), "product_class": F.col("_product"),
        "methodology": X.classify_methodology(F.col("methodology")), "rate_kind": F.when(dollar.isNotNull(), "dollar").when(percent.isNotNull(), "percentage").otherwise("algorithm"),
        "rate_dollar": dollar.cast("double"), "rate_percentage": percent.cast("double"), "billing_class": X.blank_to_null(F.lower(F.col("billing_class"))), "vintage": X.partition_vintage(F.col("file_vintage")),
    }).drop("_payer", "_plan", "_product")


def reject_summary(curated: DataFrame) -> DataFrame:
    return curated.where("reject IS NOT NULL").groupBy("reject").agg(F.count("*").alias("rows"))


def newest_of_source(loads: DataFrame, source: str, batch: str) -> DataFrame:
    """Only the rows of each source's last batch."""
    last = loads.groupBy(source).agg(F.max(batch).alias("_last"))
    return loads.join(last, source).where(F.col(batch) == F.col("_last")).drop("_last")


def latest_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_rows(rows, keys, order).drop("rank")


def rule_matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (revenue, procedure: arrays of codes) by the services whose rule they meet: a row may meet several.

    rules: service, revenue, procedure, excluded, arrays too; an empty array asks for nothing. Each row is joined on one code of
    the rule's first clause that isn't empty, then the others are checked, so that no row meets a rule it shares nothing with."""
    anchor = lambda r, p: F.when(F.size(r) > 0, F.transform(r, lambda x: F.concat(F.lit("r"), x))).otherwise(F.transform(p, lambda x: F.concat(F.lit("p"), x)))
    s = rules.select("service", *(F.col(c).alias(f"_{c}") for c in ("revenue", "procedure", "excluded"))).withColumn("_anchors", F.array_distinct(anchor(F.col("_revenue"), F.col("_procedure")))).withColumn("_code", F.explode("_anchors"))
    both = F.array_distinct(F.concat(F.transform("revenue", lambda x: F.concat(F.lit("r"), x)), F.transform("procedure", lambda x: F.concat(F.lit("p"), x))))
    met = rows.withColumn("_all", both).withColumn("_code", F.explode("_all")).join(s, "_code")
    first = F.array_min(F.array_intersect("_all", "_anchors")) == F.col("_code")  # a row that shares several codes meets a rule once
    ok = lambda c: (F.size(f"_{c}") == 0) | F.arrays_overlap(c, f"_{c}")
    return met.where(ok("revenue") & ok("procedure") & ((F.size("_excluded") == 0) | ~F.arrays_overlap("procedure", "_excluded")) & first).select(*rows.columns, "service")
