"""Payment models as column arithmetic: inlier, transfer, outlier; scenarios, margins; percent of a benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N
from ratesmith.functions import text as X
from ratesmith.rules import tables as T


def payments(claims: DataFrame, basis: str = "mmc", teaching: bool = False) -> DataFrame:
    """Adds inlier, transfer, outlier, payment_type, total and surcharge.

    Needs discharge_rate, capital_per_discharge, capital_per_diem, addons_per_discharge, transfer_addons, alc_rate, dme_rate,
    ime_pct, isaf, charge_converter, hcra_surcharge, siw, alos, cost_threshold, days, alc_days, gross_charges, non_covered_charges
    and is_transfer. A transfer whose mean stay isn't positive is an error.
    """
    c, ffs = F.col, basis == "ffs"
    zero = F.lit(0.0)
    drg = c("discharge_rate") * c("siw") + (c("dme_rate") if ffs else zero) + c("capital_per_discharge") + (zero if ffs else c("addons_per_discharge"))
    addons = (c("_drg") * c("ime_pct") + (zero if ffs else c("dme_rate"))) if teaching else zero
    alos = F.when(c("alos") > 0, c("alos")).when(c("is_transfer"), F.raise_error(F.lit("a transfer needs a positive mean stay")).cast("double"))
    daily = c("discharge_rate") * c("siw") / alos * F.when(c("alos") <= 1, T.SHORT_STAY_FACTOR).otherwise(T.TRANSFER_FACTOR) + c("capital_per_diem")
    moved = daily * (c("days") - c("alc_days")) + (c("dme_rate") if ffs else zero) + (zero if ffs else c("transfer_addons"))
    costs = (c("gross_charges") - c("non_covered_charges")) * c("charge_converter")
    limit = c("cost_threshold") * c("isaf")
    out = claims.withColumn("_drg", drg).withColumn("_alc", c("alc_rate") * c("alc_days"))
    out = out.withColumns({"inlier": c("_drg") + addons + c("_alc"), "transfer": F.when(c("is_transfer"), F.least(moved, c("_drg")) + c("_alc")), "outlier": F.when(~c("is_transfer") & (costs > limit), costs - limit)})
    kind = F.when(c("is_transfer"), "transfer").when(c("outlier").isNotNull(), "high_cost_outlier").otherwise("inlier")
    out = out.withColumns({"payment_type": kind, "total": F.coalesce(c("transfer"), c("inlier") + F.coalesce(c("outlier"), zero))})
    return out.withColumn("surcharge", c("total") * F.when(c("hcra_surcharge") > 0, c("hcra_surcharge")).otherwise(T.SURCHARGE)).drop("_drg", "_alc")


def scenario(case_mix: DataFrame, volume: float = 1.0, acuity: float = 1.0, rate: float = 1.0) -> DataFrame:
    """Case mix under multipliers; whole cases, halves to even."""
    return case_mix.withColumns({"cases": N.half_even(F.col("cases") * volume), "siw": F.col("siw") * acuity, "discharge_rate": F.col("discharge_rate") * rate})


def shift_severity(case_mix: DataFrame, share: float, top: int = 4) -> DataFrame:
    """Move a share of each severity's cases up by one; the top stays."""
    stay = N.half_even(F.col("cases") * (1 - share))
    up = F.col("severity") < top
    kept = case_mix.withColumn("cases", F.when(up, stay).otherwise(F.col("cases")))
    moved = case_mix.where(up).withColumns({"cases": F.col("cases") - stay, "severity": F.col("severity") + 1})
    return kept.unionByName(moved).groupBy("drg", "severity").agg(F.sum("cases").alias("cases"))


def margins(lines: DataFrame, payment: str = "payment", cost: str = "cost", cases: str = "cases") -> DataFrame:
    p, k = F.col(payment), F.col(cost)
    return lines.withColumns({"margin": p - k, "margin_pct": N.ratio(p - k, p), "per_case": N.ratio(p - k, F.col(cases).cast("double")), "underwater": p < k})


def underwater_lines(lines: DataFrame, payment: str, cost: str, cases: str, ties: list[str]) -> DataFrame:
    """Lines that lose money, the worst first."""
    return margins(lines, payment, cost, cases).where("underwater").orderBy("margin", *ties)


def weighted_mean(value: Column, weight: Column) -> Column:
    return N.ratio(F.sum(value * weight), F.sum(weight))


def percent_of_benchmark(rates: DataFrame, benchmarks: DataFrame, wages: DataFrame, year: int, labor: float, other: float, last: str | None = None) -> DataFrame:
    """Each rate over its benchmark: a weighted one times the facility's base, its labor share adjusted by the wage index, or an
    outpatient amount adjusted likewise.

    rates: facility, schedule, code, rate, rate_kind. benchmarks: schedule, code, year, amount, weight; codes meet without leading
    zeros and whatever their case, and of rows with one code the one counts that is greatest in `last` (an order of loading), of
    equal ones the dearest. wages: facility, wage_index, base; one row a facility. labor and other are the shares of a weighted
    payment, published each year. Dimensions are small; they are left to Spark's own broadcast limit. failure is the first check
    that fails; amount and percent aren't rounded here."""
    found = F.struct("amount", "weight")
    b = benchmarks.where(F.col("year") == year).groupBy("schedule", X.unpadded(F.col("code")).alias("_code")).agg(F.max_by(found, F.struct(*([last] if last else []), "weight", "amount")).alias("_b"))
    out = rates.withColumn("_code", X.unpadded(F.col("code"))).join(b, ["schedule", "_code"], "left").join(wages.withColumn("_known", F.lit(True)), "facility", "left")
    out = out.withColumns({"amount": F.col("_b.amount"), "weight": F.col("_b.weight")})
    share = lambda a, b: F.lit(a) * F.col("wage_index") + F.lit(b)
    weighted = F.col("weight").isNotNull()
    priced = F.when(weighted, F.col("weight") * F.col("base") * share(labor, other)).when((F.col("schedule") == "opps") & F.col("wage_index").isNotNull(), F.col("amount") * share(T.OPPS_LABOR, 1 - T.OPPS_LABOR)).otherwise(F.col("amount"))
    failure = (
        F.when((F.col("rate_kind") != "dollar") | F.col("rate").isNull(), "not_dollar_denominated")
        .when(F.coalesce(F.trim("code"), F.lit("")) == "", "no_benchmark_for_code")
        .when(F.col("schedule").isNull(), "unsupported_code_type")
        .when(F.col("amount").isNull() & ~weighted, "no_benchmark_for_code")
        .when(weighted & F.col("_known").isNull(), "no_geography_for_hospital")
        .when(weighted & F.col("wage_index").isNull(), "no_wage_index_for_area")
        .when(priced <= 0, "zero_benchmark")
    )
    out = out.withColumns({"benchmark_amount": priced, "failure": failure}).drop("_code", "_b", "_known")
    return out.withColumn("percent_of_benchmark", F.when(F.col("failure").isNull(), F.col("rate") / F.col("benchmark_amount")))
