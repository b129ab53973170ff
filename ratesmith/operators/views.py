"""Views of the published tables and of extracted price files: filters, cells, look-ups and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N
from ratesmith.functions import text as X

from .aggregate import first_rows

#: Ways of pricing whose amounts are dollars.
DOLLAR_TYPES = ["negotiated", "fee schedule", "derived"]


# filters that a table may not have

def apply_filters(df: DataFrame, **chosen) -> DataFrame:
    """Rows with the chosen values (None: any); a column that the table lacks isn't asked for."""
    tests = [F.col(c) == v for c, v in chosen.items() if v is not None and c in df.columns]
    return reduce(DataFrame.where, tests, df)


def inapplicable_filters(df: DataFrame, **chosen) -> list[str]:
    """Chosen filters that the table can't answer."""
    return sorted(c for c, v in chosen.items() if v is not None and c not in df.columns)


def unattributed_excluded(df: DataFrame, value: str, group: str = "system", **chosen) -> DataFrame:
    """Of each group, what a filter leaves out because the filtered column is blank."""
    active = [c for c, v in chosen.items() if v is not None and c != group and c in df.columns]
    blank = reduce(lambda a, b: a | b, (X.folded(F.col(c).cast("string")) == "" for c in active), F.lit(False))
    rows = apply_filters(df, **{group: chosen.get(group)})
    return rows.where(blank).groupBy(group).agg(F.sum(value).alias("excluded"))


def view_filter(
    systems: list = (), campuses: list = (), setting: str | None = None, code_types: list[str] = (), networks: list[str] = (), units: bool = False,
    dollars: bool = True, inpatient_only: bool = False,
) -> Column:
    """What a reader has narrowed a price table to. A setting also shows rows of both; units: not only acute campuses."""
    c = F.col
    tests = [c("negotiated_type").isin(DOLLAR_TYPES)] * dollars + [c("setting") == "inpatient"] * inpatient_only
    tests += [c(name).isin(list(v)) for name, v in (("network", networks), ("system", systems), ("campus", campuses), ("code_type", code_types)) if v]
    tests += [c("setting").isin(setting, "both")] * (setting in ("inpatient", "outpatient")) + [c("acute_campus")] * (not units)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def options(df: DataFrame, columns: list[str], **chosen) -> DataFrame:
    """(filter, value, rows): what each filter can be set to, given those before it that are chosen."""
    out, rows = None, df
    for c in columns:
        each = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("rows")).select(F.lit(c).alias("filter"), "value", "rows")
        out = each if out is None else out.unionByName(each)
        rows = apply_filters(rows, **{c: chosen.get(c)})
    return out


# extracted files: prices, groups, facilities, items

def facility_prices(prices: DataFrame, groups: DataFrame, facilities: DataFrame, items: DataFrame) -> DataFrame:
    """Prices by facility: references unnested and met with groups, these with facilities by npi; the item's columns beside.

    prices: source_file, item_idx, refs (array of group ids), rate, ...; groups: source_file, gid, npis; facilities: npi, ...;
    items: source_file, item_idx, .... Groups that no facility is in drop out before prices meet them."""
    known = groups.withColumn("npi", F.explode("npis")).join(facilities, "npi").drop("npis", "npi").distinct()
    met = prices.withColumn("gid", F.explode("refs")).drop("refs").join(known, ["source_file", "gid"])
    return met.join(items, ["source_file", "item_idx"], "left")


def group_prices(prices: DataFrame, groups: DataFrame) -> DataFrame:
    """Prices counted by group, then met with the group's columns: the join is one row for each group."""
    n = prices.select("source_file", F.explode("refs").alias("gid")).groupBy("source_file", "gid").agg(F.count("*").alias("prices"))
    return groups.join(n, ["source_file", "gid"])


def modal_type(rows: DataFrame, key: str, kind: str, kinds: list[str]) -> DataFrame:
    """Which of some types a key mostly uses, of ties the least."""
    n = rows.where(F.col(kind).isin(kinds)).groupBy(key, kind).agg(F.count("*").alias("_n"))
    return n.groupBy(key).agg(F.min_by(kind, F.struct(-F.col("_n"), F.col(kind))).alias(kind))


def cell_rows(rows: DataFrame, keys: list[str], label: str, lists: str) -> DataFrame:
    """Each cell's least and largest rate, distinct rates, its labels in order, and the values of its rows' lists, each once, in order."""
    joined = F.array_join(F.array_sort(F.collect_set(label)), "; ")
    flat = F.array_sort(F.array_distinct(F.flatten(F.collect_set(lists))))
    return rows.groupBy(*keys).agg(F.min("rate").alias("low"), F.max("rate").alias("high"), F.countDistinct("rate").alias("n_rates"), joined.alias("labels"), flat.alias("values"))


def discount_summary(tiers: DataFrame, key: str) -> DataFrame:
    """Of each campus: codes with both prices, the median of tier over standard, and how many are the same."""
    return tiers.groupBy(key).agg(F.count("*").alias("codes"), F.median("ratio").alias("median_ratio"), F.count_if(F.col("tier_rate") == F.col("standard_rate")).alias("identical"))


def file_dates(rows: DataFrame, key: str, date: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(date)), ", ").alias("dates"), F.countDistinct(date).alias("n_dates"))


def few_codes(rows: DataFrame, key: str, code: str, kinds: dict[str, Column]) -> DataFrame:
    """Distinct codes of each key, all and those under each condition: why a table has few rows."""
    return rows.groupBy(key).agg(F.countDistinct(code).alias("codes"), *(F.countDistinct(F.when(c, F.col(code))).alias(name) for name, c in kinds.items()))


def other_methods(rows: DataFrame, kind: Column, keys: list[str], most: int = 20_000) -> DataFrame:
    """Rates that aren't dollars of a stay, by cell; the first `most` cells in order, as many as a page can show."""
    return rows.where(kind).groupBy(*keys).agg(F.min("rate").alias("low"), F.max("rate").alias("high"), F.countDistinct("rate").alias("rates")).orderBy(*(F.asc_nulls_last(k) for k in keys)).limit(most)


def top_codes(rows: DataFrame, value: Column, code: list[str], n: int = 25) -> DataFrame:
    """The n codes with the largest total, ranked; ties by code."""
    total = rows.groupBy(*code).agg(value.alias("volume")).orderBy(F.desc("volume"), *code).limit(n)
    return total.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("volume"), *code)))  # n rows


def top_table(cells: DataFrame, top: DataFrame, modal: DataFrame, kind: str) -> DataFrame:
    """Cells of the top codes, of systems that mostly use the table's code type: rank and volume beside."""
    own = modal.where(F.col("code_type") == kind).select("system")
    return cells.where(F.col("code_type") == kind).join(own, "system", "left_semi").join(top.select("code", "rank", "volume"), "code")


# look-ups

def code_lookup(rates: DataFrame, code: str, **chosen) -> DataFrame:
    """All facilities' and carriers' rates of one code with the insurer's signed gap; order: the widest first, those without last."""
    rows = apply_filters(rates.where(F.col("code") == code.strip().upper()), **chosen)
    gap = F.when((F.col("hospital_rate") > 0) & F.col("payer_median").isNotNull(), F.col("payer_median") / F.col("hospital_rate") - 1)
    why = F.when(F.col("compared") > 0, F.col("explanation_before_offsets")).otherwise(F.col("refusal"))
    order = Window.orderBy(F.col("gap").isNull(), F.desc(F.abs("gap")), "facility", "carrier")  # one code's rows
    return rows.withColumns({"gap": gap, "why": why}).withColumn("order", F.row_number().over(order))


def lookup_summary(rows: DataFrame) -> DataFrame:
    a, b = "hospital_rate", "payer_median"
    return rows.agg(
        F.countDistinct("facility").alias("facilities"), F.countDistinct("carrier").alias("carriers"), F.count_if(F.col("compared") > 0).alias("compared"), F.min(a).alias("hospital_low"),
        F.max(a).alias("hospital_high"), F.min(b).alias("payer_low"), F.max(b).alias("payer_high"), F.median(a).alias("hospital_median"),
    )


def suggest(codes: DataFrame, text: str, n: int = 12) -> DataFrame:
    """The first n codes that begin with the text, or whose description holds it; in order of code."""
    want = text.strip()
    if len(want) < 2:
        return codes.limit(0)
    return codes.where(F.col("code").startswith(want.upper()) | F.lower("description").contains(want.lower())).orderBy("code", "description").limit(n)


def headline(coverage: DataFrame) -> DataFrame:
    return coverage.agg(F.count("*").alias("systems"), F.sum("candidates").alias("hospital_rates"), F.sum("pairs_formed").alias("compared"), F.sum("unexplained_and_material").alias("unexplained"))


def shares(rows: DataFrame, name: str, value: str, within: list[str] = ()) -> DataFrame:
    """Totals by name, largest first, and each one's share (of what `within` has)."""
    total = rows.groupBy(*within, name).agg(F.sum(value).alias("rates"))
    return total.withColumn("share", F.col("rates") / F.sum("rates").over(Window.partitionBy(*within)))


def widest(rows: DataFrame, by: str, ties: list[str], n: int = 25) -> DataFrame:
    return rows.orderBy(F.desc_nulls_last(F.abs(by)), *ties).limit(n)


def best_backed(rows: DataFrame, keys: list[str], backing: str, ties: list[str]) -> DataFrame:
    """Of each key the row that most rates stand behind."""
    return first_rows(rows, keys, [F.desc(backing), *ties]).drop("rank")


def by_insurer(rows: DataFrame, wanted: DataFrame, carrier: str = "carrier", rate: str = "rate") -> DataFrame:
    """Every wanted carrier with its rate, dearest first, those without one last."""
    order = Window.orderBy(F.desc_nulls_last(rate), carrier)  # one row for each wanted carrier
    return wanted.join(rows, carrier, "left").withColumn("order", F.row_number().over(order))


def widest_ratios(rows: DataFrame, a: str, b: str, ties: list[str], n: int = 20) -> DataFrame:
    """The n rows whose ratio is farthest from one, either way; rows without a ratio last."""
    r = F.when((F.col(a) > 0) & (F.col(b) > 0), F.col(a) / F.col(b))
    return rows.withColumn("ratio", r).orderBy(F.desc_nulls_last(F.abs(F.log("ratio"))), *ties).limit(n)


def labelled(rows: DataFrame, label: str, system: str) -> DataFrame:
    """Distinct (label, system) with a label that tells them apart: the system is added where several systems have the same one."""
    n = F.count("*").over(Window.partitionBy(label))
    return rows.select(label, system).distinct().withColumn("shown", F.when(n > 1, F.concat(F.col(label), F.lit(" ("), F.col(system).cast("string"), F.lit(")"))).otherwise(F.col(label)))


def residual_records(rows: DataFrame, columns: list[str], notes: str) -> DataFrame:
    """Residual rows as flat text: null is blank, notes joined by |."""
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns), F.array_join(F.coalesce(F.col(notes), F.array()), " | ").alias(notes))


def money(c: Column) -> Column:
    """$1,234.50, a minus sign before it; null is blank."""
    return F.coalesce(F.concat(F.when(c < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(c), 2)), F.lit(""))


def percent(c: Column, places: int = 1) -> Column:
    return F.coalesce(F.concat(F.format_number(c * 100, places), F.lit("%")), F.lit(""))


def cell_text(low: Column, high: Column, n: Column) -> Column:
    """One amount, or a range with the number of distinct rates."""
    return F.when(low.isNull(), "").when(n <= 1, money(low)).otherwise(F.concat(money(low), F.lit(" to "), money(high), F.lit(" ("), n.cast("string"), F.lit(")")))


def percent_of(rate: Column, base: Column) -> Column:
    return F.when(base > 0, N.ratio(rate, base))
