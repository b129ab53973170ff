"""Queries of rules, levers, places, evaluations and runs, over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratesmith.functions import plans
from ratesmith.functions import text as X
from ratesmith.operators import evals, gold, levers, loaders, places, triage
from ratesmith.rules import tables as T
from ratesmith.sources import files, lake, ranges, sheets

from . import analogue as A
from .mart import run_mart
from .register import register, with_

_EX = A.explained_sql()


# levers

_NAMES = "CASE carrier WHEN 'AUTOMOBILE' THEN 'Aetna' WHEN 'BUILDING' THEN 'UnitedHealthcare' WHEN 'FURNITURE' THEN 'Healthfirst' WHEN 'HOUSEHOLD' THEN 'local' ELSE '' END"
_LEVERS = f"""ref AS (SELECT system, outcome AS reason, {_NAMES} AS carrier, count(*) AS candidates FROM ex WHERE outcome <> 'compared' GROUP BY ALL), corpus AS (
  SELECT DISTINCT {_NAMES} AS carrier FROM ex WHERE outcome = 'compared' AND carrier IN ('AUTOMOBILE', 'BUILDING')), cov AS (SELECT system, count(*) AS candidates, count(*) FILTER (WHERE outcome = 'compared') AS pairs_formed FROM ex GROUP BY system), lv AS (
  SELECT *, CASE reason WHEN 'no payer-side counterpart' THEN CASE WHEN carrier = '' THEN 'unattributed' WHEN carrier IN (SELECT carrier FROM corpus) THEN 'modifier/setting normalization' WHEN carrier IN ('Aetna', 'UnitedHealthcare', 'Healthfirst') THEN 'none' ELSE 'payer/plan name matching' END
    WHEN 'different_billing_class' THEN 'none (ADR 0005)' WHEN 'billing_class_unstated' THEN 'billing class' WHEN 'incompatible_methodology' THEN 'methodology normalization' WHEN 'mixed_rate_kind' THEN 'methodology normalization'
    WHEN 'not_dollar_denominated' THEN 'methodology normalization' WHEN 'vintage_too_far_apart' THEN 'vintage tolerance' ELSE 'none' END AS lever,
  CASE reason WHEN 'no payer-side counterpart' THEN CASE WHEN carrier = '' THEN 'none' WHEN carrier IN (SELECT carrier FROM corpus) THEN 'low' WHEN carrier IN ('Aetna', 'UnitedHealthcare', 'Healthfirst') THEN 'none' ELSE 'medium' END
    WHEN 'billing_class_unstated' THEN 'medium' WHEN 'incompatible_methodology' THEN 'low' WHEN 'mixed_rate_kind' THEN 'medium' WHEN 'not_dollar_denominated' THEN 'medium' WHEN 'vintage_too_far_apart' THEN 'high' ELSE 'none' END AS feasibility FROM ref
), lw AS (SELECT *, CAST(CASE feasibility WHEN 'high' THEN 0.8 WHEN 'medium' THEN 0.5 WHEN 'low' THEN 0.2 ELSE 0 END AS DOUBLE) AS weight FROM lv), br AS (
  SELECT reason, lever, feasibility, CAST(sum(candidates) AS BIGINT) AS candidates, sum(candidates) / CAST((SELECT sum(candidates) FROM cov) AS DOUBLE) AS lift, sum(candidates) / CAST((SELECT sum(candidates) FROM cov) AS DOUBLE) * max(weight) AS weighted_lift FROM lw GROUP BY ALL)"""


def _levers(spark, sf_dir):
    name = F.when(F.col("carrier") == "AUTOMOBILE", "Aetna").when(F.col("carrier") == "BUILDING", "UnitedHealthcare").when(F.col("carrier") == "FURNITURE", "Healthfirst").when(F.col("carrier") == "HOUSEHOLD", "local").otherwise("")
    rows = A.explained(spark, sf_dir)
    corpus = gold.outcomes(rows.where("carrier IN ('AUTOMOBILE', 'BUILDING')").withColumn("carrier", name))
    refused = gold.refusals(rows.withColumn("carrier", name))
    return levers.with_levers(refused, corpus), gold.coverage(rows), refused, rows


@register(with_("SELECT * FROM br", f"{_EX}, {_LEVERS}"), "lift weighted_lift")
def lever_reasons(spark, sf_dir):
    found, coverage, _, _ = _levers(spark, sf_dir)
    return levers.by_reason(found, coverage)


@register(with_("SELECT lever, sum(lift) AS lift, sum(weighted_lift) AS weighted_lift, string_agg(DISTINCT reason, ', ' ORDER BY reason) AS reasons FROM br GROUP BY lever UNION ALL SELECT x, 0.0, 0.0, '' FROM (VALUES ('plan matching'), ('vintage tolerance'), ('modifier/setting normalization')) AS n(x) WHERE x NOT IN (SELECT lever FROM br)", f"{_EX}, {_LEVERS}"), "lift weighted_lift")
def lever_ranks(spark, sf_dir):
    found, coverage, _, _ = _levers(spark, sf_dir)
    return levers.by_lever(levers.by_reason(found, coverage))


@register(with_("""SELECT c.system, c.candidates, pairs_formed / CAST(c.candidates AS DOUBLE) AS share_now, (pairs_formed + coalesce(won, 0)) / c.candidates AS expected, coalesce(other, 0) / CAST(c.candidates AS DOUBLE) AS billing_class_share, pairs_formed / CAST(c.candidates - coalesce(other, 0) AS DOUBLE) AS billing_class_keyed
  FROM cov c LEFT JOIN (SELECT system, sum(candidates * weight) AS won, sum(candidates) FILTER (WHERE reason = 'different_billing_class') AS other FROM lw GROUP BY system) USING (system)""", f"{_EX}, {_LEVERS}"), "share_now expected billing_class_share billing_class_keyed")
def lever_systems(spark, sf_dir):
    found, coverage, _, _ = _levers(spark, sf_dir)
    return levers.per_system(found, coverage)


@register(with_("SELECT system, CASE WHEN carrier = '' THEN '(not attributed)' ELSE carrier END AS carrier, candidates, candidates / CAST(sum(candidates) OVER () AS DOUBLE) AS share_of_reason FROM ref WHERE reason = 'no payer-side counterpart' ORDER BY candidates DESC, system, 2 LIMIT 8", f"{_EX}, {_LEVERS}"), "share_of_reason")
def lever_cells(spark, sf_dir):
    return levers.by_system_and_carrier(_levers(spark, sf_dir)[2], T.NO_COUNTERPART)


@register(with_("SELECT c.*, r.refused, c.candidates = c.pairs_formed + r.refused AS holds FROM cov c JOIN (SELECT system, CAST(sum(candidates) AS BIGINT) AS refused FROM ref GROUP BY system) r USING (system)", f"{_EX}, {_LEVERS}"))
def arithmetic_holds(spark, sf_dir):
    _, coverage, refused, _ = _levers(spark, sf_dir)
    return levers.arithmetic_holds(coverage, refused)


@register(with_("SELECT count(*) FILTER (WHERE explanation = 'plan_unresolved') / CAST(count(*) AS DOUBLE) AS share FROM ex WHERE outcome = 'compared'", _EX), "share")
def plan_unresolved_share(spark, sf_dir):
    return levers.plan_unresolved_share(gold.outcomes(A.explained(spark, sf_dir)))


# rules over changes, files and proposals

_SNAP = """a AS (SELECT p_partkey AS stem, p_size AS rows, p_size * 3 AS bytes, 'x' AS state, p_type AS columns FROM part WHERE p_partkey % 7 <> 0), b AS (
  SELECT p_partkey AS stem, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS rows, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE p_size * 3 END AS bytes, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'x' END AS state, p_type AS columns FROM part WHERE p_partkey % 9 <> 0)"""
_JUDGED = """j AS (SELECT coalesce(a.stem, b.stem) AS stem, CASE WHEN b.stem IS NULL THEN 'file_removed' WHEN a.stem IS NULL THEN 'file_added' WHEN a.state IS DISTINCT FROM b.state THEN 'state_changed' WHEN a.rows <> b.rows THEN 'rows_changed' WHEN a.bytes <> b.bytes THEN 'rewritten' END AS kind FROM a FULL JOIN b ON a.stem = b.stem)"""


def _judged(spark, sf_dir):
    part = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("stem"), F.col("p_size").alias("rows"), (F.col("p_size") * 3).alias("bytes"), F.lit("x").alias("state"), F.col("p_type").alias("columns"))
    id_ = F.col("stem")
    after = part.where(id_ % 9 != 0).withColumns({"bytes": F.when(id_ % 4 == 0, 1).otherwise(F.col("bytes")), "rows": F.when(id_ % 5 == 0, F.col("rows") + 1).otherwise(F.col("rows")), "state": F.when(id_ % 11 != 0, F.col("state"))})
    return levers.judged(levers.changed_fields(part.where(id_ % 7 != 0), after, "stem", ["rows", "bytes", "state", "columns"]))


@register(with_("SELECT stem, kind, CASE WHEN kind = 'rewritten' THEN 'cosmetic' ELSE 'material' END AS materiality FROM j WHERE kind IS NOT NULL", f"{_SNAP}, {_JUDGED}"))
def judged_changes(spark, sf_dir):
    return _judged(spark, sf_dir).select("stem", "kind", "materiality")


@register(with_("SELECT kind, CASE WHEN kind = 'rewritten' THEN 'cosmetic' ELSE 'material' END AS materiality, count(*) AS changes FROM j WHERE kind IS NOT NULL GROUP BY ALL", f"{_SNAP}, {_JUDGED}"))
def watch_summary(spark, sf_dir):
    return levers.watch_summary(_judged(spark, sf_dir))


_DIAG = "p_size % 4 AS rows_kept, p_size % 6 AS rows_rejected, p_size % 5 AS rates_yielded, p_size % 7 = 0 AS truncated, CASE p_partkey % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'csv-tall' WHEN 2 THEN 'pdf' END AS layout, p_size % 11 > 0 AS structure_found"


@register(f"""SELECT p_partkey, verdict, verdict NOT IN ('conforms', 'no_negotiated_rates') AS actionable FROM (SELECT p_partkey, CASE WHEN rows_kept > 0 THEN 'conforms' WHEN truncated THEN 'truncated' WHEN coalesce(layout, '') NOT IN ('json', 'csv-tall', 'csv-wide') OR NOT structure_found THEN 'structure_not_found'
  WHEN rates_yielded = 0 THEN 'no_negotiated_rates' WHEN rows_rejected > 0 THEN 'all_rows_rejected' ELSE 'unknown' END AS verdict FROM (SELECT p_partkey, {_DIAG} FROM part))""")
def diagnosed_files(spark, sf_dir):
    return levers.diagnosed(A.table(spark, sf_dir, "part").selectExpr("p_partkey", *(x.strip() for x in _DIAG.split(", ") if " AS " in x))).select("p_partkey", "verdict", "actionable")


_CAUSES = ["units_or_methodology", "vintage_artifact", "plan_mismatch", "data_error", "insufficient_evidence", "nonsense"]
_PROPOSED = """pr AS (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 6 WHEN 0 THEN 'units_or_methodology' WHEN 1 THEN 'vintage_artifact' WHEN 2 THEN 'plan_mismatch' WHEN 3 THEN 'data_error' WHEN 4 THEN 'insufficient_evidence' ELSE 'nonsense' END AS cause,
  l_quantity / 45 AS confidence, l_linenumber % 3 AS cited, CASE WHEN l_linenumber % 4 > 0 THEN CAST(l_quantity AS INT) END AS gap, CASE WHEN l_linenumber % 5 > 0 THEN l_quantity / 10 END AS ratio, CASE WHEN l_returnflag = 'A' THEN ' ' WHEN l_returnflag = 'R' THEN 'PPO' END AS hospital_plan FROM lineitem WHERE l_orderkey % 10 > 0)"""


@register(with_("""SELECT cause, refused, count(*) AS n FROM (SELECT cause, CASE WHEN l_orderkey % 4 = 0 THEN 'no such finding' WHEN cause = 'nonsense' THEN 'unknown cause' WHEN confidence > 1 THEN 'confidence out of range' WHEN cited = 2 THEN 'cites unknown fields' WHEN cited = 0 AND cause <> 'insufficient_evidence' THEN 'no evidence'
  WHEN cause = 'vintage_artifact' AND gap IS NULL THEN 'vintage gap unknown' WHEN cause = 'vintage_artifact' AND gap < 30 THEN 'vintage gap too small' WHEN cause = 'units_or_methodology' AND ratio IS NULL THEN 'ratio unknown' WHEN cause = 'units_or_methodology' AND greatest(ratio, 1 / ratio) < 3 THEN 'ratio too small'
  WHEN cause = 'plan_mismatch' AND trim(coalesce(hospital_plan, '')) = '' THEN 'no plan named' END AS refused FROM pr) GROUP BY ALL""", _PROPOSED))
def validated_proposals(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").where("l_orderkey % 10 > 0").withColumn("id", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate"))
    line = F.col("l_linenumber")
    evidence = F.when(line % 3 == 0, F.array().cast("array<string>")).when(line % 3 == 1, F.array(F.lit("ratio"))).otherwise(F.array(F.lit("ratio"), F.lit("guess")))
    cause = F.element_at(F.array(*map(F.lit, _CAUSES)), (F.col("l_orderkey") % 6 + 1).cast("int"))
    once = t.dropDuplicates(["id"])
    proposals = t.select("id", cause.alias("cause"), (F.col("l_quantity") / 45).alias("confidence"), evidence.alias("evidence"))
    plan = F.when(F.col("l_returnflag") == "A", " ").when(F.col("l_returnflag") == "R", "PPO")
    findings = once.where("l_orderkey % 4 <> 0").select("id", F.when(line % 4 > 0, F.col("l_quantity").cast("int")).alias("vintage_gap_days"), F.when(line % 5 > 0, F.col("l_quantity") / 10).alias("ratio"), plan.alias("hospital_plan"), F.lit(None).cast("string").alias("payer_plan"))
    return levers.validated(proposals, findings, "id", ["ratio", "vintage_gap_days"]).groupBy("cause", "refused").agg(F.count("*").alias("n"))


# plans and codes

_PLANS = "VALUES ('Cigna Open Access Plus - Msq'), ('Aetna Open Access Managed Choice'), ('GHI Access Network'), ('HIP Medicaid'), ('Local Plus / Open Access Plus'), ('PPO'), ('HMO/POS'), (''), ('ChoicePlus')"
_NETS = "VALUES ('OAP'), ('OpenAccessManagedChoice'), ('GHIHOS000001'), ('LocalPlus'), ('ChoicePlus'), ('PPO')"
_FUZZY = """VALUES ('Cigna Open Access Plus - Msq', 'OAP', 'match', 1.0, 'rules'), ('Aetna Open Access Managed Choice', 'OpenAccessManagedChoice', 'match', 1.0, 'rules'), ('GHI Access Network', 'GHIHOS000001', 'unknown', 0.6, 'family'), ('HIP Medicaid', 'GHIHOS000001', 'unknown', 0.0, 'none'),
('Local Plus / Open Access Plus', 'OAP', 'aggregate', 0.0, 'rules'), ('PPO', 'PPO', 'match', 1.0, 'rules'), ('HMO/POS', 'PPO', 'aggregate', 0.0, 'rules'), ('', 'PPO', 'unknown', 0.0, 'none'), ('Choice Plus', 'ChoicePlus', 'match', 0.9, 'exact'), ('Elect Choice and Choice Plus', 'ChoicePlus', 'aggregate', 0.9, 'exact')"""


@register(f"SELECT p.p_partkey, t.plan, t.network, t.verdict, CAST(t.confidence AS DOUBLE) AS confidence, t.tier FROM part p JOIN ({_FUZZY}) AS t(plan, network, verdict, confidence, tier) ON p.p_size % 10 = (length(t.plan) + length(t.network)) % 10", "confidence")
def fuzzy_plans(spark, sf_dir):
    pairs = [x.split("', '")[:2] for x in _FUZZY.replace("VALUES ", "").replace("\n", " ").replace("), (", "|").strip("()").split("|")]
    table = spark.createDataFrame([(a.strip("'( "), b.strip("' ")) for a, b in pairs], "plan string, network string").withColumn("k", (F.length("plan") + F.length("network")) % 10)
    rows = A.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 10).alias("k")).join(table, "k")
    return rows.withColumn("v", plans.fuzzy_verdict(F.col("plan"), F.col("network"))).select("p_partkey", "plan", "network", "v.verdict", "v.confidence", "v.tier")


@register(with_("""SELECT carrier, plan, CASE max(rank) WHEN 3 THEN 'match' WHEN 2 THEN 'aggregate' WHEN 1 THEN 'no_match' ELSE 'unknown' END AS best FROM (SELECT l.carrier, l.plan, CASE WHEN coalesce(l.plan, '') NOT IN ('HMO', 'ChoicePPO', 'EPO/POS') OR coalesce(r.plan, '') NOT IN ('HMO', 'ChoicePPO', 'EPO/POS') THEN 0 WHEN l.plan = 'EPO/POS' THEN 2 WHEN l.plan = r.plan THEN 3 ELSE 1 END AS rank
  FROM (SELECT DISTINCT carrier, plan FROM lft) l JOIN (SELECT DISTINCT carrier, plan FROM rgt) r ON l.carrier = r.carrier) GROUP BY carrier, plan"""))
def plans_over_networks(spark, sf_dir):
    left, right = (df.select("carrier", F.col("plan").alias(name)).distinct() for df, name in ((A.left(spark, sf_dir), "plan"), (A.right(spark, sf_dir), "network")))
    order = ["unknown", "no_match", "aggregate", "match"]
    rank = F.array_position(F.array(*map(F.lit, order)), X.plan_verdict(F.col("plan"), F.col("network")))
    best = left.join(right, "carrier").groupBy("carrier", "plan").agg(F.max(rank).alias("_r"))
    return best.select("carrier", "plan", F.element_at(F.array(*map(F.lit, order)), F.col("_r").cast("int")).alias("best"))


@register("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'APR-DRG 1394' WHEN 1 THEN 'HCPCS G0101' WHEN 2 THEN 'CPT 99213,HCPCS 99213' WHEN 3 THEN 'APR-DRG 0450,RC 0450,CPT 00450' ELSE 'MS-DRG 064,APR-DRG 0641,APR-DRG 0642,APR-DRG 0643,APR-DRG 0644,RC 0064,CPT 00064' END AS candidates FROM part""")
def pasted_codes(spark, sf_dir):
    token = F.element_at(F.array(*map(F.lit, ["139 4", "g0101", "99213", "0450", "64"])), F.col("p_size") % 5 + 1)
    shown = F.array_join(F.transform(plans.code_candidates(token), lambda x: F.concat_ws(" ", x["code_type"], x["code"])), ",")
    return A.table(spark, sf_dir, "part").select("p_partkey", shown.alias("candidates"))


_CELL = "CASE p_size % 4 WHEN 0 THEN '360-362, 490 with 27130-27132 excluding 27131' WHEN 1 THEN 'Rev 110; G0101-G0103' WHEN 2 THEN '6320-63621' ELSE '0450 and 99281' END"


@register(f"""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '0360,0361,0362,0490' WHEN 1 THEN '0110' WHEN 2 THEN '' ELSE '0450,99281' END AS revenue, CASE p_size % 4 WHEN 0 THEN '27130,27131,27132' WHEN 1 THEN 'G0101,G0102,G0103' ELSE '' END AS "procedure",
  CASE p_size % 4 WHEN 0 THEN '27131' ELSE '' END AS excluded, CASE p_size % 4 WHEN 2 THEN '6320-63621' ELSE '' END AS bad FROM (SELECT p_partkey, p_size, {_CELL} AS cell FROM part)""")
def service_rules_parsed(spark, sf_dir):
    rows = plans.with_rules(A.table(spark, sf_dir, "part").select("p_partkey", F.expr(_CELL).alias("cell")), "cell", "r")
    return rows.select("p_partkey", *(F.array_join(f"r.{c}", ",").alias(c) for c in ("revenue", "procedure", "excluded", "bad")))


def _cells(found):
    """Cells of files, decoded once: loaders look for headers first and for rows then."""
    return sheets.cells(found.sparkSession.read.parquet(lake.working_table(sheets.read(found), "cells")))


@register(f"""SELECT p_brand AS category, 'part ' || p_partkey AS name, CASE p_size % 4 WHEN 0 THEN '0360,0361,0362,0490' WHEN 1 THEN '0110' WHEN 2 THEN '' ELSE '0450,99281' END AS revenue, CASE p_size % 4 WHEN 0 THEN '27130,27131,27132' WHEN 1 THEN 'G0101,G0102,G0103' ELSE '' END AS "procedure",
  CASE p_size % 4 WHEN 0 THEN '27131' ELSE '' END AS excluded, CASE p_size % 4 WHEN 2 THEN '6320-63621' ELSE '' END AS bad FROM part""")
def service_workbooks(spark, sf_dir):
    """Parts as services of workbooks, each under its brand, written in tasks and read back as rules."""
    part = A.table(spark, sf_dir, "part").withColumn("book", F.concat_ws("-", F.lit("services"), F.regexp_extract("p_brand", r"(\d)", 1), F.floor(F.col("p_partkey") / 100_000)))
    row = lambda first, brand, under: F.struct(F.lit(first).alias("first"), brand.alias("brand"), under.alias("under"))
    none = F.lit(None).cast("string")
    tops = part.select("book", row(0, F.lit(""), F.lit(0).cast("long")).alias("row"), F.array(F.lit("Service"), F.lit("Codes")).alias("cells")).distinct()
    heads = part.select("book", row(1, F.col("p_brand"), F.lit(-1).cast("long")).alias("row"), F.array(F.col("p_brand"), none).alias("cells")).distinct()
    lines = part.select("book", row(1, F.col("p_brand"), F.col("p_partkey").cast("long")).alias("row"), F.array(F.concat_ws(" ", F.lit("part"), "p_partkey"), F.expr(_CELL)).alias("cells"))
    books = tops.unionByName(heads).unionByName(lines).withColumn("sheet", F.lit("Rates & codes"))
    written = lake.working_table(sheets.write_workbooks(books, lake.working_path(spark, "workbooks")), "workbook_files")
    rules = loaders.service_rules(_cells(spark.read.parquet(written)))
    return rules.select("category", "name", *(F.array_join(c, ",").alias(c) for c in ("revenue", "procedure", "excluded", "bad")))


@register("""SELECT 'P' || p_partkey AS code, round(p_retailprice, 2) AS amount, p_name AS description, 'HCPCS' AS code_type, 2025 AS year FROM part WHERE p_size % 5 <> 0 AND p_retailprice > 0""", "amount")
def fee_tables(spark, sf_dir):
    """Parts as outpatient fee tables, one text file each maker: titles, a header found by its caption, amounts with marks; packaged ones go."""
    part = A.table(spark, sf_dir, "part")
    maker = F.regexp_extract("p_brand", r"(\d)", 1)
    cells = [F.concat(F.lit(" p"), "p_partkey"), F.concat(F.lit('"'), F.replace("p_name", F.lit('"'), F.lit('""')), F.lit('"')), F.when(F.col("p_size") % 5 == 0, "N").otherwise("t"), F.concat(F.lit("$"), F.format_number("p_retailprice", 2))]
    lines = part.select(maker.alias("maker"), F.lit(1).alias("place"), F.concat_ws("\t", *cells).alias("value"))
    top = F.lit("Addendum B. HCPCS codes and amounts\t\t\t\n\n\tHCPCS\tamounts\n1,2 HCPCS\u00a0Code\tShort Descriptor\tStatus  Indicator\t3 Payment Rate")
    lines = lines.unionByName(part.select(maker.alias("maker"), F.lit(0).alias("place"), top.alias("value")).distinct())
    path = lake.working_path(spark, "fee_tables")
    lines.repartition("maker").sortWithinPartitions("maker", "place").select("maker", "value").write.partitionBy("maker").text(path)
    return loaders.outpatient_rates(_cells(ranges.listed(spark, path)), 2025).select("code", "amount", "description", "code_type", "year")


@register("""SELECT CAST(7000000 + s_suppkey AS VARCHAR) AS opcert, s_name AS hospital, round(s_acctbal, 2) AS discharge_rate, round(s_suppkey / 100.0, 2) AS isaf, CAST(s_nationkey AS DOUBLE) AS alc_rate, CAST(2.5 + s_nationkey AS DOUBLE) AS addons_per_discharge, CAST(2 AS DOUBLE) AS transfer_addons, CAST(CASE WHEN s_acctbal > 0 THEN 0.07 ELSE 0 END AS DOUBLE) AS hcra_surcharge
FROM supplier""", "discharge_rate isaf")
def rate_workbooks(spark, sf_dir):
    """Suppliers as hospitals of rate publications, a workbook each nation: bands above, notes below, money with marks, blank cells."""
    s = A.table(spark, sf_dir, "supplier").withColumn("book", F.concat_ws("-", F.lit("rates"), "s_nationkey", F.floor(F.col("s_suppkey") / 500_000)))
    none = F.lit(None).cast("string")
    text = lambda c: c.cast("string")
    values = {"discharge_rate": F.concat(F.lit("$"), F.format_number("s_acctbal", 2)), "isaf": text(F.format_number(F.col("s_suppkey") / 100, 2)), "ambulance_addon": F.lit("0.5"), "minimum_wage_addon": text(F.col("s_nationkey")), "acr_addon": F.lit("2"), "alc_rate": text(F.col("s_nationkey")), "hcra_surcharge": F.when(F.col("s_acctbal") > 0, "0.07")}
    lines = s.select("book", (F.col("s_suppkey") + 1).cast("long").alias("row"), F.array((F.col("s_suppkey") + 7_000_000).cast("string"), "s_name", *(values.get(n, none) for n in T.RATE_COLUMNS["mmc"])).alias("cells"))
    ends = [s.select("book", F.lit(place).cast("long").alias("row"), F.array(*map(F.lit, cells)).alias("cells")).distinct() for place, cells in ((-1, ["Rates", "2025"]), (0, ["Certificate", "Hospital"]), (1 << 60, ["Note 1", "of the rates"]))]
    for end in ends:
        lines = lines.unionByName(end)
    written = lake.working_table(sheets.write_workbooks(lines.withColumn("sheet", F.lit("2025_Acute")), lake.working_path(spark, "workbooks")), "workbook_files")
    rates = loaders.rate_schedules(_cells(spark.read.parquet(written)), "mmc")
    return rates.select("opcert", "hospital", "discharge_rate", "isaf", "alc_rate", "addons_per_discharge", "transfer_addons", "hcra_surcharge")


# places

_FACILITY = "CASE s_suppkey % 8 WHEN 0 THEN 'Danbury Hospital' WHEN 1 THEN 'Mercy Hospital of Buffalo' WHEN 2 THEN 'MERCY HOSPITAL' WHEN 3 THEN 'Ellis' WHEN 4 THEN 'Strong Memorial' WHEN 5 THEN 'Strong Memorial Hospital Annex' WHEN 6 THEN 'Nowhere Clinic' END"
_SYSTEM = "CASE s_suppkey % 3 WHEN 0 THEN 'Ellis Medicine' WHEN 1 THEN 'NYU Langone Health' ELSE 'Other' END"
_KNOWN = [("Mercy Hospital of Buffalo", "ERIE", 1), ("Strong Memorial Hospital", "MONROE", 2), ("Ellis", "SCHENECTADY", 3), ("Hamlet", "HAMILTON", 4)]
_REGION = f"""f AS (SELECT s_suppkey, {_FACILITY} AS facility, {_SYSTEM} AS system FROM supplier), rg AS (SELECT *, CASE s_suppkey % 8 WHEN 0 THEN 'Connecticut' WHEN 1 THEN 'Western New York' WHEN 2 THEN 'Western New York' WHEN 3 THEN 'Capital Region' WHEN 4 THEN 'Finger Lakes' WHEN 5 THEN 'Finger Lakes'
  ELSE CASE system WHEN 'Ellis Medicine' THEN 'Capital Region' WHEN 'NYU Langone Health' THEN 'New York City metro' ELSE 'Unknown' END END AS region FROM f)"""


def _regions(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_FACILITY).alias("facility"), F.expr(_SYSTEM).alias("system"))
    return places.regions(rows, spark.createDataFrame(_KNOWN, "name string, county string, ord int"))


@register(with_("SELECT s_suppkey, facility, region FROM rg", _REGION))
def facility_regions(spark, sf_dir):
    return _regions(spark, sf_dir).select("s_suppkey", "facility", "region")


@register(with_("SELECT region, string_agg(DISTINCT system, ',' ORDER BY system) AS systems FROM rg WHERE region <> 'Unknown' GROUP BY region HAVING count(DISTINCT system) >= 2", _REGION))
def peer_groups(spark, sf_dir):
    return places.peer_groups(_regions(spark, sf_dir)).withColumn("systems", F.array_join("systems", ","))


_SITES = {
    "hospital": "CASE WHEN l_linenumber % 2 = 0 THEN 'Mount Sinai Health System' ELSE 'Northwell' END", "location_name": "CASE l_suppkey % 4 WHEN 0 THEN 'Danbury Hospital' WHEN 1 THEN ' Main ' WHEN 2 THEN 'Annex' END",
    "plan_name": "CASE l_returnflag WHEN 'A' THEN 'Cigna Hmo/Oap- Snch' WHEN 'R' THEN 'Aetna Whole Health-Tmsh' ELSE 'Plain - Xyz' END",
    "source_url": "CASE WHEN l_suppkey % 4 = 0 AND l_linestatus = 'F' THEN 's3://b/16-0762843_Kenmore-Mercy-of-the-Hospital_StandardCharges.csv?x=1' WHEN l_suppkey % 4 = 0 THEN 's3://b/danbury_standardcharges.zip' ELSE 's3://b/one_standardcharges.json' END",
}
_RESOLVED = f"""site AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _SITES.items())} FROM lineitem), rs AS (SELECT *, CASE WHEN hospital LIKE 'Mount%' AND plan_name LIKE '%Snch' THEN 'Mount Sinai South Nassau' WHEN hospital LIKE 'Mount%' AND plan_name LIKE '%Tmsh' THEN 'The Mount Sinai Hospital'
  WHEN source_url LIKE '%Kenmore%' THEN 'Kenmore Mercy of the Hospital' WHEN source_url LIKE '%danbury%' THEN 'Danbury' ELSE trim(coalesce(location_name, hospital)) END AS facility FROM site)"""


def _resolved(spark, sf_dir):
    return places.resolve_facilities(A.table(spark, sf_dir, "lineitem").select(*(F.expr(e).alias(c) for c, e in _SITES.items())))


@register(with_("SELECT hospital, facility, count(*) AS rows FROM rs GROUP BY ALL", _RESOLVED))
def resolved_facilities(spark, sf_dir):
    return _resolved(spark, sf_dir).groupBy("hospital", "facility").agg(F.count("*").alias("rows"))


@register(with_("SELECT DISTINCT facility FROM rs WHERE facility <> ''", _RESOLVED))
def distinct_locations(spark, sf_dir):
    return places.distinct_locations(_resolved(spark, sf_dir))


@register(with_("SELECT location_name, count(DISTINCT source_url) AS sources FROM site WHERE location_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_url) > 1", _RESOLVED))
def ambiguous_locations(spark, sf_dir):
    return places.ambiguous_locations(_resolved(spark, sf_dir))


@register(with_("SELECT source_url, count(DISTINCT facility) AS facilities, count(DISTINCT facility) > 1 AS multi FROM rs GROUP BY 1", _RESOLVED))
def multi_facility(spark, sf_dir):
    return places.multi_facility(_resolved(spark, sf_dir))


@register("SELECT n_name AS name, CASE n_nationkey % 3 WHEN 0 THEN 'confirmed' WHEN 2 THEN CAST(n_nationkey AS VARCHAR) END AS id, CASE n_nationkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE 'accepted' END AS routed_to FROM nation")
def crosswalk_decisions(spark, sf_dir):
    nation = A.table(spark, sf_dir, "nation")
    known = nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("id"))
    decided = nation.where("n_nationkey % 3 < 2").select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 == 0, "confirmed").alias("id"))
    return places.resolve_crosswalk(nation.select(F.col("n_name").alias("name")), known, decided).select("name", "id", "routed_to")


_SITE_NAMES = "CASE n_nationkey % 5 WHEN 0 THEN 'The Mercy Hospital of Buffalo' WHEN 1 THEN 'Mercy' WHEN 2 THEN 'St Lukes Roosevelt North' WHEN 3 THEN 'Lenox|Hill' ELSE 'Zzz' END"
_SITE_KNOWN = [("1", "Mercy Hospital Of Buffalo"), ("2", "Mercy Kenmore"), ("3", "St Lukes Roosevelt"), ("4", "Lenox Hill"), ("5", "Lenox Hill Annex West")]


@register(f"""SELECT name, CASE name WHEN 'The Mercy Hospital of Buffalo' THEN '1' WHEN 'Mercy' THEN '1' WHEN 'St Lukes Roosevelt North' THEN '3' WHEN 'Lenox|Hill' THEN '4' END AS id, CASE name WHEN 'The Mercy Hospital of Buffalo' THEN 'exact name' WHEN 'Mercy' THEN 'under-specified'
  WHEN 'St Lukes Roosevelt North' THEN 'token-overlap' WHEN 'Lenox|Hill' THEN 'exact name' ELSE 'no token overlap' END AS method, name NOT IN ('Mercy', 'Zzz') AS sure FROM (SELECT DISTINCT {_SITE_NAMES} AS name FROM nation)""")
def matched_locations(spark, sf_dir):
    known = spark.createDataFrame(_SITE_KNOWN, "id string, name string")
    return places.match_locations(A.table(spark, sf_dir, "nation").select(F.expr(_SITE_NAMES).alias("name")), known).select("name", "id", "method", "sure")


@register("""SELECT s_suppkey AS ccn, coalesce(p, g) AS cbsa, coalesce(own, area) AS wage_index FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS p, s_nationkey % 10 AS g, CASE WHEN s_suppkey % 7 = 0 THEN s_suppkey / 100.0 END AS own FROM supplier) LEFT JOIN (
  SELECT n_nationkey, CAST(0.9 AS DOUBLE) + n_nationkey AS area FROM nation WHERE n_nationkey % 4 > 0) ON n_nationkey = coalesce(p, g)""", "wage_index")
def geography(spark, sf_dir):
    s = A.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ccn"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey")).alias("payment_cbsa"), (F.col("s_nationkey") % 10).alias("geographic_cbsa"))
    by_id = A.table(spark, sf_dir, "supplier").where("s_suppkey % 7 = 0").select(F.lit("ccn").alias("kind"), F.col("s_suppkey").cast("long").alias("key"), (F.col("s_suppkey") / F.lit(100.0)).alias("wage_index"))
    by_area = A.table(spark, sf_dir, "nation").where("n_nationkey % 4 > 0").select(F.lit("cbsa").alias("kind"), F.col("n_nationkey").cast("long").alias("key"), (F.lit(0.9) + F.col("n_nationkey")).alias("wage_index"))
    return places.geography(s, by_id.unionByName(by_area)).select("ccn", "cbsa", "wage_index")


@register("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'NYU' WHEN s_suppkey % 3 = 1 THEN 'Sinai' END AS system FROM supplier")
def systems_by_name(spark, sf_dir):
    name = F.when(F.col("s_suppkey") % 5 == 0, "NYU Dental School").when(F.col("s_suppkey") % 3 == 0, "nyu langone hospitals").when(F.col("s_suppkey") % 3 == 1, "THE MOUNT SINAI HOSPITAL").otherwise("Ellis")
    return A.table(spark, sf_dir, "supplier").select("s_suppkey", places.system_of(name, [("NYU", r"\bnyu\b"), ("Sinai", r"mount\s+sinai")], "dental").alias("system"))


@register("""SELECT 'last' AS which, p_brand AS key, p_partkey AS id FROM (SELECT p_brand, max(p_partkey) AS p_partkey FROM part GROUP BY 1) UNION ALL SELECT 'first', p_brand, p_partkey FROM (SELECT p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1)""")
def table_lookups(spark, sf_dir):
    part = A.table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), F.col("p_partkey").alias("id"))
    return places.lookup_last(part, ["key"], "id").select(F.lit("last").alias("which"), "key", "id").unionByName(places.lookup_first(part, ["key"], "id").select(F.lit("first").alias("which"), "key", "id"))


@register("SELECT p_partkey, CASE p_brand WHEN 'Brand#3' THEN replace(p_name, 'ring', 'RING') ELSE p_name END AS text FROM part")
def corrected_texts(spark, sf_dir):
    part = A.table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("service"), F.col("p_name").alias("text"))
    c = spark.createDataFrame([("Brand#3", "ring", "RING", True), ("Brand#4", "ring", "x", False)], "service string, find string, replace string, confirmed boolean")
    return places.corrected(part, c).select("p_partkey", "text")


@register("SELECT p_brand AS payer, p_type AS plan, count(*) AS lines FROM part GROUP BY ALL")
def candidate_pairs(spark, sf_dir):
    pairs = A.table(spark, sf_dir, "part").groupBy(F.concat_ws(" || ", "p_brand", "p_type").alias("pair")).agg(F.count("*").alias("lines"))
    return places.candidates_from_pairs(pairs)


# evaluations, profiles, runs

_LABELLED = """lb AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 'data_error' ELSE 'plan_mismatch' END) AS expected FROM labels GROUP BY doc_id), qu AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'data_error' WHEN 1 THEN 'plan_mismatch' WHEN 2 THEN 'insufficient_evidence' END AS got FROM documents WHERE doc_id % 5 > 0), sc AS (
  SELECT count(*) AS labels, count(q.doc_id) AS scored, count(*) FILTER (WHERE q.doc_id IS NULL) AS unmatched, count(*) FILTER (WHERE got = expected) AS correct, count(*) FILTER (WHERE got <> expected AND got <> 'insufficient_evidence') AS wrong, count(*) FILTER (WHERE q.doc_id IS NOT NULL AND coalesce(got, 'insufficient_evidence') = 'insufficient_evidence') AS abstained
  FROM lb LEFT JOIN (SELECT DISTINCT * FROM qu) q ON q.doc_id = lb.doc_id)"""


@register(with_("SELECT *, correct / CAST(correct + wrong AS DOUBLE) AS precision, (correct + wrong) / CAST(scored AS DOUBLE) AS coverage, correct / CAST(correct + wrong AS DOUBLE) >= CAST(0.9 AS DOUBLE) AS passed, CASE WHEN correct / CAST(correct + wrong AS DOUBLE) >= CAST(0.9 AS DOUBLE) THEN 'passed' ELSE 'precision too low' END AS why FROM sc", _LABELLED), "precision coverage")
def triage_gate(spark, sf_dir):
    expected = F.max(F.when(F.col("quality") == 0, "data_error").otherwise("plan_mismatch"))
    labels = evals.load_labels(A.table(spark, sf_dir, "labels").groupBy("doc_id").agg(expected.alias("expected")), ["doc_id"], {"expected": T.CAUSES})
    id_ = F.col("doc_id")
    got = F.when(id_ % 4 == 0, "data_error").when(id_ % 4 == 1, "plan_mismatch").when(id_ % 4 == 2, "insufficient_evidence")
    queue = A.table(spark, sf_dir, "documents").where("doc_id % 5 > 0").select("doc_id", got.alias("got")).distinct()
    return evals.gate(evals.triage_scores(labels, queue, ["doc_id"], "expected", "got"))


@register("SELECT count(*) AS labels, count(*) FILTER (WHERE toxic = 0) AS reviewed, count(*) FILTER (WHERE toxic = 0) / CAST(count(*) AS DOUBLE) AS share FROM labels", "share")
def reviewed_share(spark, sf_dir):
    return evals.reviewed_share(A.table(spark, sf_dir, "labels").withColumn("reviewed", F.col("toxic") == 0), "reviewed")


@register("""WITH s AS (SELECT *, p_size < 3 AS sure FROM part), t AS (SELECT count(*) FILTER (WHERE sure) AS sure, count(*) FILTER (WHERE NOT sure) AS rest FROM s), c AS (SELECT p_type, count(*) AS n FROM s WHERE NOT sure GROUP BY 1), p AS (SELECT *, least(greatest(150 - sure, 0), rest) AS places FROM c, t), g AS (
  SELECT *, places * n // rest AS get, row_number() OVER (ORDER BY places * n % rest DESC, p_type) AS i FROM p)
SELECT p_type, n, get + CASE WHEN i <= places - (SELECT sum(get) FROM g) THEN 1 ELSE 0 END AS taken FROM g""")
def stratified_sample(spark, sf_dir):
    part = A.table(spark, sf_dir, "part")
    sure = F.col("p_size") < 3
    taken = levers.stratified(part, ["p_type"], sure, 150, ["p_partkey"]).where(~sure).groupBy("p_type").agg(F.count("*").alias("taken"))
    return part.where(~sure).groupBy("p_type").agg(F.count("*").alias("n")).join(taken, "p_type", "left").fillna(0, ["taken"])


_PRICED = "CASE WHEN l_linenumber = 1 AND l_quantity < 5 THEN '' ELSE 'Acme' END AS payer_name, CASE WHEN l_linenumber = 3 THEN 'Medicare Advantage' WHEN l_linenumber = 1 THEN NULL ELSE 'PPO' END AS plan_name, CASE WHEN l_tax > 0.05 THEN ' Per Diem' END AS methodology, CASE WHEN l_returnflag = 'A' THEN '5' END AS rate_dollar, CASE WHEN l_returnflag = 'R' THEN '5' END AS rate_percentage, CASE WHEN l_linestatus = 'F' THEN 'x' END AS rate_algorithm"


@register(f"""WITH r AS (SELECT *, CASE WHEN plan_name = 'Medicare Advantage' THEN 'medicare_advantage' WHEN plan_name = 'PPO' THEN 'commercial' ELSE 'no_plan_detail' END AS product, CASE WHEN rate_dollar IS NOT NULL THEN 'dollar' WHEN rate_algorithm IS NOT NULL THEN 'algorithm' WHEN rate_percentage IS NOT NULL THEN 'percentage' ELSE 'none' END AS kind
  FROM (SELECT {_PRICED} FROM lineitem) WHERE payer_name <> '' OR plan_name IS NOT NULL)
SELECT 'pairs' AS counter, payer_name || ' || ' || coalesce(plan_name, '') AS value, count(*) AS lines FROM r GROUP BY ALL UNION ALL SELECT 'methodology', CASE WHEN methodology IS NULL THEN '(blank)' ELSE 'per diem' END, count(*) FROM r GROUP BY ALL
UNION ALL SELECT 'value_kind', kind, count(*) FROM r GROUP BY ALL UNION ALL SELECT 'product_class', product, count(*) FROM r GROUP BY ALL UNION ALL SELECT 'joint', product || '|' || kind, count(*) FROM r GROUP BY ALL""")
def price_profile(spark, sf_dir):
    return evals.profile(A.table(spark, sf_dir, "lineitem").selectExpr(*(f"{x} AS {n}" for x, n in (y.rsplit(" AS ", 1) for y in _PRICED.split(", CASE ") if y) for x in [x if x.startswith("CASE") else f"CASE {x}"])))


@register("""SELECT n_name AS hospital, l_linestatus AS payer_name, count(*) AS rates, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total, count(DISTINCT l_partkey) AS codes
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""", "total")
def json_price_documents(spark, sf_dir):
    """Order lines as one price document for each nation, written line by line, and read back by blocks of a megabyte."""
    t = lambda name: A.table(spark, sf_dir, name)
    payer = F.struct(F.col("l_linestatus").alias("payer_name"), F.lit('P "1", [a]').alias("plan_name"), F.col("l_extendedprice").cast("string").alias("standard_charge_dollar"))
    charge = F.struct(F.lit("inpatient").alias("setting"), F.array(payer).alias("payers_information"))
    item = F.to_json(F.struct(F.concat_ws("-", F.lit("item"), "l_orderkey", "l_linenumber").alias("description"), F.array(F.struct(F.col("l_partkey").cast("string").alias("code"), F.lit("CPT").alias("type"))).alias("code_information"), F.array(charge).alias("standard_charges")))
    lines = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("nation"), F.lit(1).alias("place"), F.concat(F.lit(","), item).alias("value"))
    ends = [(0, F.concat(F.lit('{"hospital_name":"'), F.col("n_name"), F.lit('","location_name":["x","y"],"last_updated_on":"2026-01-01","standard_charge_information":[null'))), (2, F.lit("]}"))]
    for place, value in ends:
        lines = lines.unionByName(t("nation").select(F.col("n_nationkey").alias("nation"), F.lit(place).alias("place"), value.alias("value")))
    path = lake.working_path(spark, "price_documents")
    lines.repartition("nation").sortWithinPartitions("nation", "place").select("nation", "value").write.partitionBy("nation").text(path)
    rows = files.read_price_json(spark, path, block=1 << 20)
    return rows.groupBy("hospital", "payer_name").agg(F.count("*").alias("rates"), F.sum(F.col("rate_dollar").cast("decimal(18,2)")).cast("double").alias("total"), F.countDistinct("code").alias("codes"))


@register(with_("SELECT code, median(relative_difference) AS median_relative_difference, count(*) AS pairs FROM ex WHERE outcome = 'compared' GROUP BY code", _EX), "median_relative_difference")
def spread_by_code(spark, sf_dir):
    return evals.spread_by_code(A.explained(spark, sf_dir).where("outcome = 'compared'"))


@register(with_("SELECT CAST(sum(n) AS BIGINT) AS findings, CAST(sum(codes) AS BIGINT) AS groups, max(n) AS largest, max(n) / CAST(sum(n) AS DOUBLE) AS concentration FROM (SELECT carrier, count(*) AS n, count(DISTINCT code) AS codes FROM res GROUP BY carrier)", _EX), "concentration")
def queue_summary(spark, sf_dir):
    return evals.queue_summary(gold.residual(A.explained(spark, sf_dir)))


@register(with_("""SELECT code, carrier, CASE WHEN n < 2 THEN 'single' WHEN (up = 0 OR down = 0) AND spread <= CAST(0.1 AS DOUBLE) THEN 'consistent_offset' WHEN up = 0 OR down = 0 THEN 'one_direction' ELSE 'mixed' END AS class FROM (
  SELECT code, carrier, count(*) AS n, count(*) FILTER (WHERE ratio > 1) AS up, count(*) FILTER (WHERE ratio < 1) AS down, (max(ratio) - min(ratio)) / median(ratio) AS spread FROM res GROUP BY code, carrier)""", _EX))
def classed_groups(spark, sf_dir):
    return evals.classed_groups(triage.service_groups(gold.residual(A.explained(spark, sf_dir)))).select("code", "carrier", "class")


@register("SELECT p_brand AS drg, p_size % 4 AS severity, CAST(sum(p_size) AS BIGINT) AS cases, sum(p_size) / CAST((SELECT sum(p_size) FROM part WHERE p_partkey % 3 = 1 AND p_size % 9 > 0) AS DOUBLE) AS share FROM part WHERE p_partkey % 3 = 1 AND p_size % 9 > 0 AND p_type IN ('ECONOMY', 'STANDARD') GROUP BY ALL", "share")
def case_mix(spark, sf_dir):
    raw = A.table(spark, sf_dir, "part").select(F.concat(F.lit("F"), F.col("p_partkey") % 3).alias("facility"), F.col("p_brand").alias("drg"), (F.col("p_size") % 4).cast("string").alias("severity"), F.when(F.col("p_size") % 9 > 0, F.col("p_size").cast("string")).otherwise("n/a").alias("cases"), F.col("p_type").alias("payer"))
    return evals.case_mix(evals.usable_volumes(raw), "F1", ["ECONOMY", "STANDARD"])


_RUNS = "e AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'start' WHEN 'error' THEN 'end' ELSE 'other' END AS kind, ts, CAST(floor(value) % 3 AS INT) AS value, event_type AS slice FROM events)"


def _events(spark, sf_dir):
    kind = F.when(F.col("event_type") == "click", "start").when(F.col("event_type") == "error", "end").otherwise("other")
    return A.table(spark, sf_dir, "events").select("user_id", kind.alias("kind"), "ts", (F.floor("value") % 3).cast("int").alias("value"), F.col("event_type").alias("slice"))


@register(with_("""SELECT user_id, started, ended, exit_code, last_seen, peak, events, CASE WHEN ended IS NULL THEN 'killed or running' WHEN exit_code = 0 THEN 'succeeded' ELSE 'failed' END AS outcome FROM (SELECT user_id, min(ts) FILTER (WHERE kind = 'start') AS started, max(ts) FILTER (WHERE kind = 'end') AS ended,
  arg_max(value, ts) FILTER (WHERE kind = 'end') AS exit_code, max(ts) AS last_seen, max(value) AS peak, count(*) AS events FROM e GROUP BY user_id) WHERE started IS NOT NULL""", _RUNS))
def job_runs(spark, sf_dir):
    return evals.runs(_events(spark, sf_dir), ["user_id"], "kind", "ts")


@register(with_("SELECT user_id, events, worst_slice, worst_value FROM (SELECT user_id, count(*) AS events, max(value) AS worst_value FROM e GROUP BY user_id) JOIN (SELECT user_id, slice AS worst_slice FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, slice) AS i FROM e) WHERE i = 1) USING (user_id)", _RUNS))
def worst_slices(spark, sf_dir):
    return evals.worst_slice(_events(spark, sf_dir), ["user_id"], "slice", "value")


@register("SELECT event_type, count(*) AS runs, median(value) AS median_s, max(value) AS max_s, count(*) FILTER (WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50) AS failures FROM events GROUP BY event_type", "median_s max_s")
def stage_durations(spark, sf_dir):
    k = F.from_json("props", "k long")["k"]
    return evals.durations(A.table(spark, sf_dir, "events"), "event_type", "value", k > 50)


@register("SELECT n_regionkey, CAST(sum(s_suppkey) AS BIGINT) AS rows, CAST(sum(s_nationkey) AS BIGINT) AS excluded, max(s_name) AS newest, min(s_name) AS oldest, min(s_acctbal) AS coverage, string_agg(DISTINCT n_name, ' | ' ORDER BY n_name) AS sources FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1", "coverage")
def provenance_merged(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier").join(A.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_regionkey", F.col("s_suppkey").alias("rows"), F.col("s_nationkey").alias("excluded"), F.col("s_name").alias("date"), F.col("s_acctbal").alias("coverage"), F.array("n_name").alias("sources"))
    return evals.merged_provenance(rows, ["n_regionkey"])


@register("SELECT 'root' || (l_suppkey % 3) AS root, max(CASE WHEN l_suppkey % 3 < 2 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END) AS ingest_date, count(*) AS files, count(DISTINCT l_returnflag) AS groups FROM lineitem GROUP BY 1")
def latest_ingest(spark, sf_dir):
    root = F.concat(F.lit("root"), F.col("l_suppkey") % 3)
    dated = F.when(F.col("l_suppkey") % 3 < 2, F.concat(F.lit("/ingest_date="), F.date_format("l_shipdate", "yyyy-MM-dd"))).otherwise("/undated")
    return evals.latest_ingest(A.table(spark, sf_dir, "lineitem").select(F.concat(root, dated, F.lit("/carrier="), F.col("l_returnflag"), F.lit("/f.parquet")).alias("path")))


@register("SELECT count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes, CAST(floor(sum(n_chars) * 7 / 3) AS BIGINT) AS projected, greatest(CAST(floor(sum(n_chars) * 7 / 3) AS BIGINT) - 1000000, 0) AS over FROM documents")
def footprint(spark, sf_dir):
    return evals.footprint(A.table(spark, sf_dir, "documents"), "n_chars", 3, 7, 1_000_000)


@register("SELECT s_suppkey, substr(sha256(s_name || '|' || CAST(s_nationkey AS VARCHAR)), 1, 12) AS source_key FROM supplier")
def source_keys(spark, sf_dir):
    return A.table(spark, sf_dir, "supplier").select("s_suppkey", evals.short_hash(F.col("s_name"), F.col("s_nationkey"), digits=12).alias("source_key"))


@register(with_("""SELECT 'coverage' AS "table", CAST(system AS VARCHAR) AS hospital_slug, count(*) AS rows FROM (SELECT DISTINCT system FROM ex) GROUP BY system UNION ALL SELECT 'outcomes', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT system, facility, carrier, code_type, explanation FROM ex WHERE outcome = 'compared') GROUP BY system
  UNION ALL SELECT 'refusals', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT outcome, system, facility, carrier, code_type FROM ex WHERE outcome <> 'compared') GROUP BY system UNION ALL SELECT 'magnitude', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT system, carrier, code_type FROM res) GROUP BY system
  UNION ALL SELECT 'pairs', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT system, facility, carrier FROM ex) GROUP BY system UNION ALL SELECT 'rates', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT system, facility, carrier, code, code_type FROM ex WHERE (system, carrier) IN (SELECT DISTINCT system, carrier FROM rgt)) GROUP BY system
  UNION ALL SELECT 'measures', CAST(system AS VARCHAR), 4 + count(*) FROM (SELECT DISTINCT system, outcome = 'compared' AS done, CASE WHEN outcome = 'compared' THEN explanation ELSE outcome END AS name FROM ex) GROUP BY system
  UNION ALL SELECT 'offsets', CAST(system AS VARCHAR), count(*) FROM (SELECT DISTINCT system, facility, carrier, plan, payer_label FROM ex WHERE contract_offset IS NOT NULL) GROUP BY system
  UNION ALL SELECT 'exemplars', CAST(system AS VARCHAR), count(*) FROM (SELECT system, row_number() OVER (PARTITION BY system, carrier ORDER BY relative_difference DESC, code, code_type, facility, plan NULLS FIRST, setting, billing_class NULLS FIRST, vintage, rate, payer_median) AS i FROM res) WHERE i <= 25 GROUP BY system
  UNION ALL SELECT 'residual', CAST(system AS VARCHAR), count(*) FROM (SELECT system, row_number() OVER (PARTITION BY system, facility, carrier ORDER BY abs(difference) DESC, code) AS i FROM res) WHERE i <= 100 GROUP BY system""", _EX))
def mart_run(spark, sf_dir):
    """All published tables, written and counted: the whole work of a mart run."""
    return run_mart(spark, A.left(spark, sf_dir), A.right(spark, sf_dir), lake.working_path(spark, "mart"))
