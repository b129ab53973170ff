"""Published tables as typed rows, out of the cells that sources/sheets.py reads: rates, weights, wages, fee tables, service rules.

A loader takes cells of many files at once, and each row says which file and member it is from. Where a loader finds its columns by
their captions, a sheet without them gives no rows; `sheets.layout` lists those, so that an empty table isn't taken for a whole one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import plans
from ratesmith.rules import tables as T
from ratesmith.sources import sheets

from .aggregate import first_rows
from .places import corrected

#: Columns that weights, standard amounts, wages and fees are found by.
WEIGHT_COLUMNS = {"code": ["ms-drg"], "description": ["ms-drg title"], "capped": ["weights", "cap applied"], "uncapped": ["weights", "before cap"]}
WAGE_COLUMNS = {"ccn": ["ccn"], "wage": ["wage index", "quartile and cap"], "geographic_cbsa": ["geographic cbsa"], "payment_cbsa": ["wage index payment cbsa"], "cmi": ["case-mix indexes"], "county": ["county name"]}
AREA_COLUMNS = {"cbsa": ["cbsa"], "wage": ["wage index"]}
OUTPATIENT_COLUMNS = {"code": ["hcpcs"], "rate": ["payment rate"], "status": ["status indicator"], "description": ["short descriptor"]}
PROFESSIONAL_COLUMNS = {"code": ["hcpcs"], "work": ["work rvu"], "practice": ["non-fac pe rvu"], "malpractice": ["mp rvu"], "status": ["status code"]}


def _digits(c: str) -> Column:
    return F.coalesce(F.col(c).rlike(r"^\d+$"), F.lit(False))


def _or_zero(c: str) -> Column:
    return F.coalesce(sheets.number(F.col(c)), F.lit(0.0))


def _one_sheet(cells: DataFrame, ending: str | None = None) -> DataFrame:
    """The first sheet of each workbook whose name ends in one way, else its first sheet."""
    fits = F.upper(F.coalesce("sheet", F.lit(""))).endswith(ending) if ending else F.lit(False)
    best = cells.groupBy("file", "member").agg(F.min(F.struct((~fits).alias("other"), "place"))["place"].alias("_place"))
    return cells.join(best, ["file", "member"]).where("place = _place").drop("_place")


def _origin(label: str) -> Column:
    return F.concat(F.lit(label), F.lit(" ("), sheets.own_name(), F.lit(")"))


def _benchmark(rows: DataFrame, schedule: str, code_type: str, year: int, label: str, amount: Column | None = None, weight: Column | None = None, description: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("double")
    text = F.lit(None).cast("string") if description is None else description
    return rows.select(F.lit(schedule).alias("schedule"), "code", F.lit(code_type).alias("code_type"), F.lit(year).alias("year"), (none if amount is None else amount).alias("amount"), (none if weight is None else weight).alias("weight"), text.alias("description"), _origin(label).alias("source"), "file", "member", "row")


def rate_schedules(cells: DataFrame, basis: str, effective_date: str = "") -> DataFrame:
    """Hospital rates by certificate: rows whose first cell is a number and whose second is a name. A blank cell, and one that is no
    number, is 0. On the managed basis add-ons are summed up, on the other the capital column holds them already."""
    names = T.RATE_COLUMNS[basis]
    wide = sheets.rows(_one_sheet(cells, T.ACUTE_SHEET), ["opcert", "hospital", *names]).where(_digits("opcert") & F.col("hospital").isNotNull())
    sum_of = lambda those: sum((_or_zero(n) for n in those if n in names), F.lit(0.0))
    kept = [n for n in names if n not in T.DIRECTED_ADDONS and n not in ("admission_rate", "hcra_surcharge")]
    return wide.select(
        "opcert", "hospital", *(_or_zero(n).alias(n) for n in kept), (sum_of(T.DIRECTED_ADDONS) if basis == "mmc" else F.lit(0.0)).alias("addons_per_discharge"), sum_of(T.SAFETY_NET_ADDONS).alias("transfer_addons"),
        F.greatest(_or_zero("hcra_surcharge"), F.lit(0.0)).alias("hcra_surcharge"), F.lit(effective_date).alias("effective_date"), F.lit(basis).alias("basis"), "file", "member", "row",
    )


def severity_weights(cells: DataFrame) -> DataFrame:
    """Weights by group and severity: apr_drg (three digits), severity (1 to 4), description, siw, alos, cost_threshold."""
    wide = sheets.rows(_one_sheet(cells), ["apr_drg", "severity", "description", "siw", "alos", "cost_threshold"]).where(_digits("apr_drg") & F.col("severity").isin("1", "2", "3", "4"))
    code = F.when(F.length("apr_drg") < 3, F.lpad("apr_drg", 3, "0")).otherwise(F.col("apr_drg"))
    return wide.select(code.alias("apr_drg"), F.col("severity").cast("int").alias("severity"), F.coalesce("description", F.lit("")).alias("description"), *(_or_zero(c).alias(c) for c in ("siw", "alos", "cost_threshold")), "file", "member", "row")


def service_rules(cells: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """(category, name, spec, revenue, procedure, excluded, bad) of a rate sheet's services: a name without codes is a heading, and
    holds for the services below it. The first row is the sheet's header. corrections: service, find, replace, confirmed."""
    wide = sheets.rows(_one_sheet(cells), ["name", "spec"]).where("row > 0 AND name IS NOT NULL")
    wide = sheets.carried_down(wide.withColumn("category", F.when(F.col("spec").isNull(), F.col("name"))), "category").where("spec IS NOT NULL")
    if corrections is not None:
        wide = corrected(wide, corrections, "name", "spec")
    rule = wide.withColumn("_r", plans.parse_rule(F.col("spec")))
    return rule.select(F.coalesce("category", F.lit("")).alias("category"), "name", "spec", "_r.revenue", "_r.procedure", "_r.excluded", "_r.bad", "file", "member", "row")


def inpatient_weights(cells: DataFrame, year: int, capped: bool = True, prefer_correction: bool = True) -> DataFrame:
    """Benchmark rows of relative weights; groups that nothing is paid by and weights that aren't positive go."""
    one = sheets.chosen(cells, "Table 5", ".txt", prefer_correction)
    weight = sheets.number(F.col("capped" if capped else "uncapped"))
    rows = sheets.table(one, "ms-drg", WEIGHT_COLUMNS).where(_digits("code") & ~F.col("code").isin(T.UNGROUPABLE) & (weight > 0))
    return _benchmark(rows, "ipps", "MS-DRG", year, f"IPPS Table 5 FY{year}", weight=weight, description=F.col("description"))


def standard_amounts(cells: DataFrame, year: int, prefer_correction: bool = True) -> DataFrame:
    """(file, year, regime, labor, other, amount, labor_share): the first pair of money amounts under the captions of tables 1A (wage
    index over 1: regime high) and 1B (low); later pairs are of hospitals that get less."""
    one = sheets.numbered_tables(sheets.chosen(cells, "1A", ".txt", prefer_correction), "table 1", 8)
    regime = F.when(F.col("caption") == "table 1a", "high").when(F.col("caption") == "table 1b", "low")
    numbers = one.select("file", "member", "row", "col", regime.alias("regime"), sheets.number(F.col("value")).alias("n")).where("regime IS NOT NULL AND n IS NOT NULL")
    by_row = numbers.groupBy("file", "member", "regime", "row").agg(F.slice(F.array_sort(F.collect_list(F.struct("col", "n"))), 1, 2).alias("p"))
    pairs = by_row.where("size(p) = 2 AND p[0].n > 1000 AND p[1].n > 100")
    first = pairs.groupBy("file", "member", "regime").agg(F.min_by("p", "row").alias("p"))
    labor, other = F.col("p")[0]["n"], F.col("p")[1]["n"]
    return first.select("file", "member", F.lit(year).alias("year"), "regime", labor.alias("labor"), other.alias("other"), (labor + other).alias("amount"), (labor / (labor + other)).alias("labor_share"))


def wage_index(cells: DataFrame, prefer_correction: bool = True) -> DataFrame:
    """Hospitals' wage index and areas: ccn, wage_index, geographic_cbsa, payment_cbsa, cbsa (that it is paid by), case_mix_index,
    county. A hospital that a file lists again counts as it is listed last."""
    rows = sheets.table(sheets.chosen(cells, "Tables 2", ".txt", prefer_correction), "ccn", WAGE_COLUMNS).where(_digits("ccn"))
    rows = first_rows(rows, ["file", "ccn"], [F.desc("row")])
    return rows.select("ccn", sheets.number(F.col("wage")).alias("wage_index"), "geographic_cbsa", "payment_cbsa", F.coalesce("payment_cbsa", "geographic_cbsa").alias("cbsa"), sheets.number(F.col("cmi")).alias("case_mix_index"), "county", "file", "member")


def area_wage_index(cells: DataFrame, prefer_correction: bool = True) -> DataFrame:
    """Areas' wage index: cbsa, wage_index. An area that stands in several states counts as it is listed first."""
    rows = sheets.table(sheets.chosen(cells, "Tables 3", ".txt", prefer_correction), "cbsa", AREA_COLUMNS).withColumn("wage_index", sheets.number(F.col("wage")))
    return first_rows(rows.where("cbsa IS NOT NULL AND wage_index IS NOT NULL"), ["file", "cbsa"], [F.col("row")]).select("cbsa", "wage_index", "file", "member")


def _either(cells: DataFrame) -> DataFrame:
    """A plain file's table; of an archive one that ends in .csv, else one that ends in .txt."""
    kind = F.when(F.col("member") == "", 0).when(F.lower("member").endswith(".csv"), 1).when(F.lower("member").endswith(".txt"), 2)
    best = cells.groupBy("file").agg(F.min(kind).alias("_kind"))
    return sheets.chosen(cells.join(best, "file").where(kind == F.col("_kind")).drop("_kind"))


def outpatient_rates(cells: DataFrame, year: int) -> DataFrame:
    """Benchmark rows of outpatient amounts; codes whose payment is part of another's have none, and go."""
    amount = sheets.number(F.col("rate"))
    rows = sheets.table(_either(cells), "hcpcs", OUTPATIENT_COLUMNS).withColumn("code", F.upper("code"))
    rows = rows.where(F.col("code").isNotNull() & (amount > 0) & ~F.upper(F.coalesce("status", F.lit(""))).isin(T.PACKAGED_STATUS))
    return _benchmark(rows, "opps", "HCPCS", year, f"OPPS Addendum B CY{year}", amount=amount, description=F.col("description"))


def professional_rates(cells: DataFrame, year: int, conversion_factor: float, locality: str | None = None) -> DataFrame:
    """Benchmark rows of professional amounts: all three relative values times the year's factor, to the cent."""
    if conversion_factor <= 0:
        raise ValueError(f"the conversion factor must be positive: {conversion_factor}")
    total = sheets.number(F.col("work")) + sheets.number(F.col("practice")) + sheets.number(F.col("malpractice"))
    rows = sheets.table(_either(cells), "hcpcs", PROFESSIONAL_COLUMNS).withColumn("code", F.upper("code"))
    rows = rows.where(F.col("code").isNotNull() & F.upper(F.coalesce("status", F.lit(""))).isin(T.PRICED_STATUS) & (total > 0))
    label = f"PFS RVU CY{year} at CF {conversion_factor}, {f'locality {locality}' if locality else 'national GPCIs'}"
    return _benchmark(rows, "pfs", "CPT", year, label, amount=F.round(total * conversion_factor, 2))
