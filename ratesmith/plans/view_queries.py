"""Queries of the views, over the published tables and over order lines that stand for extracted prices."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratesmith.operators import gold, market, payment, views

from . import analogue as A
from .register import register, with_

_EX = A.explained_sql()
_COVERAGE = """cov AS (SELECT system, count(*) AS candidates, count(*) FILTER (WHERE outcome = 'compared') AS pairs_formed, count(*) FILTER (WHERE outcome = 'compared' AND is_material AND explanation = 'unexplained') AS unexplained_and_material FROM ex GROUP BY system)"""
_REFUSED = "ref AS (SELECT outcome AS reason, system, facility, CASE WHEN facility % 4 = 0 THEN '' ELSE carrier END AS carrier, count(*) AS candidates FROM ex WHERE outcome <> 'compared' GROUP BY ALL)"


def _refused(spark, sf_dir):
    rows = A.explained(spark, sf_dir).withColumn("carrier", F.when(F.col("facility") % 4 == 0, "").otherwise(F.col("carrier")))
    return gold.refusals(rows)


@register(with_("SELECT count(*) AS systems, CAST(sum(candidates) AS BIGINT) AS hospital_rates, CAST(sum(pairs_formed) AS BIGINT) AS compared, CAST(sum(unexplained_and_material) AS BIGINT) AS unexplained FROM cov", f"{_EX}, {_COVERAGE}"))
def headline(spark, sf_dir):
    return views.headline(gold.coverage(A.explained(spark, sf_dir)))


@register(with_("SELECT explanation, count(*) AS rates, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM ex WHERE outcome = 'compared' AND facility = 3 AND carrier = 'MACHINERY' GROUP BY explanation", _EX), "share")
def pair_detail(spark, sf_dir):
    rows = views.apply_filters(gold.outcomes(A.explained(spark, sf_dir)), facility=3, carrier="MACHINERY", shard="none")
    return views.shares(rows, "explanation", "pairs")


@register(with_("SELECT system, reason, CAST(sum(candidates) AS BIGINT) AS rates, sum(candidates) / CAST(sum(sum(candidates)) OVER (PARTITION BY system) AS DOUBLE) AS share FROM ref GROUP BY system, reason", f"{_EX}, {_REFUSED}"), "share")
def refusal_summary(spark, sf_dir):
    return views.shares(_refused(spark, sf_dir), "reason", "candidates", ["system"])


@register(with_("SELECT system, CAST(sum(candidates) AS BIGINT) AS excluded FROM ref WHERE carrier = '' GROUP BY system", f"{_EX}, {_REFUSED}"))
def unattributed_excluded(spark, sf_dir):
    return views.unattributed_excluded(_refused(spark, sf_dir), "candidates", carrier="MACHINERY", plan="none")


@register(with_("SELECT explanation, count(*) AS rates, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM ex WHERE outcome = 'compared' GROUP BY explanation", _EX), "share")
def outcomes_chart(spark, sf_dir):
    return views.shares(gold.outcomes(A.explained(spark, sf_dir)), "explanation", "pairs")


_GAPS = "gaps AS (SELECT facility, carrier, median(CASE WHEN outcome = 'compared' THEN ratio - 1 END) AS gap FROM ex GROUP BY facility, carrier)"


@register(with_("SELECT facility, carrier, gap FROM gaps ORDER BY abs(gap) DESC NULLS LAST, facility, carrier LIMIT 25", f"{_EX}, {_GAPS}"), "gap")
def widest(spark, sf_dir):
    rows = gold.pairs(A.explained(spark, sf_dir)).select("facility", "carrier", F.col("median_signed_gap").alias("gap"))
    return views.widest(rows, "gap", ["facility", "carrier"])


_LOOK = """look AS (SELECT facility, carrier, code, median(rate) AS hospital_rate, count(*) FILTER (WHERE outcome = 'compared') AS compared, median(payer_median) AS payer_median FROM ex
  WHERE code = 'Brand#18-25' AND (system, carrier) IN (SELECT DISTINCT system, carrier FROM rgt) GROUP BY facility, carrier, code), gapped AS (SELECT *, payer_median / hospital_rate - 1 AS gap FROM look)"""


def _look(spark, sf_dir):
    rows = A.explained(spark, sf_dir).withColumn("code", F.upper("code"))
    return views.code_lookup(gold.rates(rows, A.right(spark, sf_dir)), " brand#18-25 ")


@register(with_('SELECT facility, carrier, hospital_rate, compared, payer_median, gap, CAST(row_number() OVER (ORDER BY gap IS NULL, abs(gap) DESC, facility, carrier) AS INT) AS "order" FROM gapped', f"{_EX}, {_LOOK}"), "hospital_rate payer_median gap")
def code_lookup(spark, sf_dir):
    return _look(spark, sf_dir).select("facility", "carrier", "hospital_rate", "compared", "payer_median", "gap", "order")


@register(with_("SELECT count(DISTINCT facility) AS facilities, count(DISTINCT carrier) AS carriers, count(*) FILTER (WHERE compared > 0) AS compared, min(hospital_rate) AS hospital_low, max(hospital_rate) AS hospital_high, min(payer_median) AS payer_low, max(payer_median) AS payer_high, median(hospital_rate) AS hospital_median FROM gapped", f"{_EX}, {_LOOK}"), "hospital_low hospital_high payer_low payer_high hospital_median")
def lookup_summary(spark, sf_dir):
    return views.lookup_summary(_look(spark, sf_dir))


@register("SELECT code, description FROM (SELECT DISTINCT upper(p_brand) AS code, p_name AS description FROM part) WHERE starts_with(code, 'RIN') OR contains(lower(description), 'rin') ORDER BY code, description LIMIT 12")
def suggest(spark, sf_dir):
    codes = A.table(spark, sf_dir, "part").select(F.upper("p_brand").alias("code"), F.col("p_name").alias("description")).distinct()
    return views.suggest(codes, " rin ")


@register(with_("SELECT 'system' AS filter, CAST(system AS VARCHAR) AS value, count(*) AS rows FROM lft GROUP BY system UNION ALL SELECT 'facility', CAST(facility AS VARCHAR), count(*) FROM lft WHERE system = 2 GROUP BY facility UNION ALL SELECT 'carrier', carrier, count(*) FROM lft WHERE system = 2 AND facility = 7 GROUP BY carrier"))
def filter_options(spark, sf_dir):
    return views.options(A.left(spark, sf_dir), ["system", "facility", "carrier"], system=2, facility=7)


@register("SELECT label, system, CASE WHEN count(*) OVER (PARTITION BY label) > 1 THEN label || ' (' || system || ')' ELSE label END AS shown FROM (SELECT DISTINCT substr(s_name, 1, 18) AS label, s_nationkey AS system FROM supplier)")
def clashing_labels(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier").select(F.substring("s_name", 1, 18).alias("label"), F.col("s_nationkey").alias("system"))
    return views.labelled(rows, "label", "system")


_BACKED = "backed AS (SELECT facility, code, carrier, count(*) AS n, median(rate) AS rate FROM rates WHERE side = 0 GROUP BY ALL)"


@register(with_("SELECT facility, code, carrier, n, rate FROM (SELECT *, row_number() OVER (PARTITION BY facility, code ORDER BY n DESC, carrier) AS i FROM backed) WHERE i = 1", f"{A.base_sql()}, {_BACKED}"), "rate")
def best_backed(spark, sf_dir):
    rows = A.rates(spark, sf_dir).where("side = 0").groupBy("facility", "code", "carrier").agg(F.count("*").alias("n"), F.median("rate").alias("rate"))
    return views.best_backed(rows, ["facility", "code"], "n", ["carrier"])


@register(with_("""SELECT w.carrier, b.rate, CAST(row_number() OVER (ORDER BY b.rate DESC NULLS LAST, w.carrier) AS INT) AS "order" FROM (SELECT DISTINCT c_mktsegment AS carrier FROM customer UNION SELECT 'NOBODY') w
  LEFT JOIN (SELECT carrier, median(rate) AS rate FROM backed WHERE facility = 5 GROUP BY carrier) b USING (carrier)""", f"{A.base_sql()}, {_BACKED}"), "rate")
def by_insurer(spark, sf_dir):
    wanted = A.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("carrier")).distinct().unionByName(spark.createDataFrame([("NOBODY",)], "carrier string"))
    cells = A.rates(spark, sf_dir).where("side = 0 AND facility = 5").groupBy("code", "carrier").agg(F.median("rate").alias("rate")).groupBy("carrier").agg(F.median("rate").alias("rate"))
    return views.by_insurer(cells, wanted)


@register("SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity / 1000 AS ratio FROM lineitem ORDER BY abs(ln(l_extendedprice / l_quantity / 1000)) DESC NULLS LAST, l_orderkey, l_linenumber, l_extendedprice LIMIT 20", "ratio")
def widest_ratios(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").withColumns({"a": F.col("l_extendedprice") / F.col("l_quantity"), "b": F.lit(1000.0)})
    return views.widest_ratios(t, "a", "b", ["l_orderkey", "l_linenumber", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "ratio")


# extracted price files

_FILES = """prices AS (SELECT l_linestatus AS source_file, l_partkey AS item_idx, [l_suppkey, (l_suppkey + 1) % 50] AS refs, l_extendedprice AS rate FROM lineitem), groups AS (
  SELECT f.source_file, s_suppkey AS gid, [s_nationkey, (s_nationkey + 3) % 25] AS npis FROM supplier, (VALUES ('O'), ('F')) AS f(source_file)), facilities AS (SELECT n_nationkey AS npi, n_regionkey AS system FROM nation WHERE n_nationkey % 4 > 0), items AS (
  SELECT f.source_file, p_partkey AS item_idx, p_brand AS code FROM part, (VALUES ('O'), ('F')) AS f(source_file) WHERE p_partkey % 5 > 0)"""


def _files(spark, sf_dir):
    t = lambda name: A.table(spark, sf_dir, name)
    named = F.explode(F.array(F.lit("O"), F.lit("F"))).alias("source_file")
    prices = t("lineitem").select(F.col("l_linestatus").alias("source_file"), F.col("l_partkey").alias("item_idx"), F.array("l_suppkey", (F.col("l_suppkey") + 1) % 50).alias("refs"), F.col("l_extendedprice").alias("rate"))
    groups = t("supplier").select(named, F.col("s_suppkey").alias("gid"), F.array("s_nationkey", (F.col("s_nationkey") + 3) % 25).alias("npis"))
    facilities = t("nation").where("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("npi"), F.col("n_regionkey").alias("system"))
    items = t("part").where("p_partkey % 5 > 0").select(named, F.col("p_partkey").alias("item_idx"), F.col("p_brand").alias("code"))
    return prices, groups, facilities, items


@register(with_("""SELECT system, code, count(*) AS n, min(rate) AS low, max(rate) AS high FROM (SELECT source_file, item_idx, rate, unnest(refs) AS gid FROM prices) p
  JOIN (SELECT DISTINCT source_file, gid, system FROM (SELECT source_file, gid, unnest(npis) AS npi FROM groups) JOIN facilities USING (npi)) g USING (source_file, gid) LEFT JOIN items USING (source_file, item_idx) GROUP BY system, code""", _FILES), "low high")
def facility_prices(spark, sf_dir):
    return views.facility_prices(*_files(spark, sf_dir)).groupBy("system", "code").agg(F.count("*").alias("n"), F.min("rate").alias("low"), F.max("rate").alias("high"))


@register(with_("SELECT g.source_file, g.gid, p.prices FROM groups g JOIN (SELECT source_file, gid, count(*) AS prices FROM (SELECT source_file, unnest(refs) AS gid FROM prices) GROUP BY ALL) p ON p.source_file = g.source_file AND p.gid = g.gid", _FILES))
def group_prices(spark, sf_dir):
    prices, groups, _, _ = _files(spark, sf_dir)
    return views.group_prices(prices, groups).select("source_file", "gid", "prices")


_VIEW = {
    "system": "s_nationkey % 5", "campus": "s_nationkey", "code": "p_brand", "code_type": "CASE WHEN p_size % 3 = 0 OR s_nationkey % 5 = 1 THEN 'APR-DRG' WHEN p_size % 3 = 1 THEN 'MS-DRG' ELSE 'RC' END",
    "network": "CASE WHEN l_linenumber % 2 = 0 THEN 'tier' ELSE 'standard' END", "setting": "CASE WHEN l_linestatus = 'F' THEN 'inpatient' WHEN l_linenumber = 3 THEN 'both' ELSE 'outpatient' END",
    "negotiated_type": "CASE l_returnflag WHEN 'A' THEN 'negotiated' WHEN 'R' THEN 'fee schedule' ELSE 'per diem' END", "acute_campus": "s_nationkey % 6 > 0", "rate": "l_extendedprice / l_quantity", "vintage": "substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 4)",
    "rc": "l_linenumber", "units": "l_quantity",
}
_VIEW_SQL = f"v AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _VIEW.items())} FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"


def _view(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").join(A.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(A.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(*(F.expr(e).alias(c) for c, e in _VIEW.items()))


@register(with_("SELECT campus, code, count(*) AS n FROM v WHERE negotiated_type IN ('negotiated', 'fee schedule', 'derived') AND network IN ('tier', 'standard') AND system IN (1, 2) AND setting IN ('inpatient', 'both') AND code_type IN ('MS-DRG', 'APR-DRG') AND acute_campus GROUP BY ALL", _VIEW_SQL))
def view_filtered(spark, sf_dir):
    kept = _view(spark, sf_dir).where(views.view_filter([1, 2], setting="inpatient", code_types=["MS-DRG", "APR-DRG"], networks=["tier", "standard"]))
    return kept.groupBy("campus", "code").agg(F.count("*").alias("n"))


_MODAL = "modal AS (SELECT system, code_type FROM (SELECT system, code_type, row_number() OVER (PARTITION BY system ORDER BY count(*) DESC, code_type) AS i FROM v WHERE code_type IN ('APR-DRG', 'MS-DRG') GROUP BY system, code_type) WHERE i = 1)"


@register(with_("SELECT * FROM modal", f"{_VIEW_SQL}, {_MODAL}"))
def modal_code_type(spark, sf_dir):
    return views.modal_type(_view(spark, sf_dir), "system", "code_type", ["APR-DRG", "MS-DRG"])


@register(with_("SELECT campus, code, min(rate) AS low, max(rate) AS high, count(DISTINCT rate) AS n_rates, string_agg(DISTINCT setting, '; ' ORDER BY setting) AS labels, array_to_string(list_sort(list_distinct(list(rc) || list(rc + 10))), ',') AS rcs FROM v GROUP BY campus, code", _VIEW_SQL), "low high")
def cell_lists(spark, sf_dir):
    rows = _view(spark, sf_dir).withColumn("rcs", F.array("rc", F.col("rc") + 10))
    return views.cell_rows(rows, ["campus", "code"], "setting", "rcs").withColumn("rcs", F.array_join(F.transform("values", lambda x: x.cast("string")), ",")).drop("values")


@register(with_("""SELECT facility, count(*) AS codes, median(tier_rate / standard_rate) AS median_ratio, count(*) FILTER (WHERE tier_rate = standard_rate) AS identical FROM (SELECT facility, code, min(rate) FILTER (WHERE plan = 'HMO') AS tier_rate, min(rate) FILTER (WHERE plan = 'ChoicePPO') AS standard_rate FROM lft
  GROUP BY facility, code HAVING count(DISTINCT rate) FILTER (WHERE plan = 'HMO') = 1 AND count(DISTINCT rate) FILTER (WHERE plan = 'ChoicePPO') = 1) GROUP BY facility"""), "median_ratio")
def discount_summary(spark, sf_dir):
    return views.discount_summary(market.tier_ratios(A.left(spark, sf_dir), ["facility", "code"], "plan", "HMO", "ChoicePPO"), "facility")


@register(with_("SELECT system, string_agg(DISTINCT vintage, ', ' ORDER BY vintage) AS dates, count(DISTINCT vintage) AS n_dates FROM v GROUP BY system", _VIEW_SQL))
def file_dates(spark, sf_dir):
    return views.file_dates(_view(spark, sf_dir), "system", "vintage")


@register(with_("SELECT campus, count(DISTINCT code) AS codes, count(DISTINCT code) FILTER (WHERE setting = 'inpatient') AS inpatient, count(DISTINCT code) FILTER (WHERE negotiated_type = 'per diem') AS per_diem FROM v GROUP BY campus", _VIEW_SQL))
def few_codes(spark, sf_dir):
    return views.few_codes(_view(spark, sf_dir), "campus", "code", {"inpatient": F.col("setting") == "inpatient", "per_diem": F.col("negotiated_type") == "per diem"})


@register(with_("SELECT code_type, code, system, campus, network, min(rate) AS low, max(rate) AS high, count(DISTINCT rate) AS rates FROM v WHERE acute_campus AND negotiated_type = 'per diem' GROUP BY ALL ORDER BY code_type, code, system, campus, network LIMIT 20000", _VIEW_SQL), "low high")
def other_methods(spark, sf_dir):
    rows = _view(spark, sf_dir).where(views.view_filter(dollars=False))
    return views.other_methods(rows, F.col("negotiated_type") == "per diem", ["code_type", "code", "system", "campus", "network"])


_TOP = "top AS (SELECT code, volume, CAST(row_number() OVER (ORDER BY volume DESC, code) AS INT) AS rank FROM (SELECT code, CAST(sum(units) AS BIGINT) AS volume FROM v GROUP BY code) QUALIFY rank <= 25)"


@register(with_("""SELECT 'inpatient' AS "table", * FROM top UNION ALL SELECT 'all', code, volume, CAST(row_number() OVER (ORDER BY volume DESC, code) AS INT) FROM (SELECT code, CAST(count(*) AS BIGINT) AS volume FROM v GROUP BY code) QUALIFY row_number() OVER (ORDER BY volume DESC, code) <= 25""", f"{_VIEW_SQL}, {_TOP}"))
def volume_sources(spark, sf_dir):
    rows = _view(spark, sf_dir)
    tables = {"inpatient": F.sum("units").cast("long"), "all": F.count("*")}
    out = [views.top_codes(rows, value, ["code"]).withColumn("table", F.lit(name)) for name, value in tables.items()]
    return out[0].unionByName(out[1])


@register(with_("""SELECT system, campus, c.code, code_type, low, high, rank, volume FROM (SELECT system, campus, code, code_type, min(rate) AS low, max(rate) AS high FROM v GROUP BY ALL) c JOIN top t ON t.code = c.code
  WHERE code_type = 'APR-DRG' AND system IN (SELECT system FROM modal WHERE code_type = 'APR-DRG')""", f"{_VIEW_SQL}, {_MODAL}, {_TOP}"), "low high")
def top_table(spark, sf_dir):
    rows = _view(spark, sf_dir)
    cells = rows.groupBy("system", "campus", "code", "code_type").agg(F.min("rate").alias("low"), F.max("rate").alias("high"))
    return views.top_table(cells, views.top_codes(rows, F.sum("units").cast("long"), ["code"]), views.modal_type(rows, "system", "code_type", ["APR-DRG", "MS-DRG"]), "APR-DRG")


@register(with_("SELECT code, campus, CASE WHEN n <= 1 THEN '$' || format('{:,.2f}', low) ELSE '$' || format('{:,.2f}', low) || ' to ' || '$' || format('{:,.2f}', high) || ' (' || n || ')' END AS shown, format('{:.0f}%', floor(100 * low / high)) AS low_of_high FROM (SELECT code, campus, min(rate) AS low, max(rate) AS high, count(DISTINCT rate) AS n FROM (SELECT code, campus, floor(rate) + 0.25 AS rate FROM v) GROUP BY ALL)", _VIEW_SQL))
def cell_texts(spark, sf_dir):
    cells = _view(spark, sf_dir).withColumn("rate", F.floor("rate") + 0.25).groupBy("code", "campus").agg(F.min("rate").alias("low"), F.max("rate").alias("high"), F.countDistinct("rate").alias("n"))
    share = F.floor(100 * views.percent_of(F.col("low").cast("double"), F.col("high").cast("double"))) / 100
    return cells.select("code", "campus", views.cell_text(F.col("low"), F.col("high"), F.col("n")).alias("shown"), views.percent(share, 0).alias("low_of_high"))


@register(with_("SELECT facility, carrier, code, coalesce(plan, '') AS plan, CASE WHEN plan IS NULL THEN '' ELSE plan || ' | ' || payer_label END AS notes FROM res", _EX))
def residual_records(spark, sf_dir):
    rows = gold.residual(A.explained(spark, sf_dir)).withColumns({"facility": F.col("facility").cast("string"), "notes": F.when(F.col("plan").isNotNull(), F.array("plan", "payer_label"))})
    return views.residual_records(rows, ["facility", "carrier", "code", "plan"], "notes").withColumn("facility", F.col("facility").cast("int"))


@register("SELECT l_orderkey, l_linenumber, l_extendedprice - 900 * l_quantity AS margin FROM lineitem WHERE l_extendedprice < 900 * l_quantity", "margin")
def underwater_lines(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").withColumn("_cost", 900 * F.col("l_quantity"))
    return payment.underwater_lines(t, "l_extendedprice", "_cost", "l_quantity", ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "margin")


@register("""SELECT n_name AS hospital, count(*) AS suppliers, sum(CAST(s_acctbal AS DECIMAL(18, 2))) AS total, CAST(row_number() OVER (ORDER BY sum(CAST(s_acctbal AS DECIMAL(18, 2))) DESC, n_name) AS INT) AS "order" FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def across_hospitals(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier").join(A.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    total = rows.groupBy(F.col("n_name").alias("hospital")).agg(F.count("*").alias("suppliers"), F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("total"))
    return total.withColumn("order", F.row_number().over(Window.orderBy(F.desc("total"), "hospital")))
