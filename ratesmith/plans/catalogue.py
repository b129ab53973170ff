"""The comparison's queries, and all others: importing this module fills the catalogue."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.operators import aggregate, compare, conform, gold, market, payment, resolve, triage
from ratesmith.sources import files, lake

from . import analogue as A
from . import payer_queries, rule_queries, view_queries
from .register import ORACLES, QUERIES, register, with_

__all__ = ["ORACLES", "QUERIES", "payer_queries", "rule_queries", "view_queries"]

_EX = A.explained_sql()


# medians

@register(with_("SELECT facility, code, carrier, median(rate) AS rate, count(rate) AS n FROM rates WHERE side = 0 GROUP BY facility, code, carrier"), "rate")
def rate_median_by_key(spark, sf_dir):
    return aggregate.median_by_key(A.rates(spark, sf_dir).where("side = 0"), ["facility", "code", "carrier"])


@register(with_("SELECT system, code, carrier, setting, median(rate) AS rate, count(rate) AS n FROM (SELECT DISTINCT system, code, carrier, setting, rate FROM rates WHERE side = 1) GROUP BY ALL"), "rate")
def payer_distinct_then_median(spark, sf_dir):
    keys = ["system", "code", "carrier", "setting"]
    return aggregate.distinct_then_median(A.rates(spark, sf_dir).where("side = 1"), [*keys, "rate"], keys)


@register(with_("SELECT facility, rate AS upper_median FROM (SELECT facility, rate, row_number() OVER (PARTITION BY facility ORDER BY rate) AS i, count(*) OVER (PARTITION BY facility) AS n FROM lft) WHERE i = n // 2 + 1"), "upper_median")
def upper_median_row(spark, sf_dir):
    return aggregate.median_row(A.left(spark, sf_dir), ["facility"], [F.col("rate")], upper=True).select("facility", F.col("rate").alias("upper_median"))


@register(with_("SELECT facility, rate AS lower_median FROM (SELECT facility, rate, row_number() OVER (PARTITION BY facility ORDER BY rate) AS i, count(*) OVER (PARTITION BY facility) AS n FROM lft) WHERE i = (n + 1) // 2"), "lower_median")
def lower_median_row(spark, sf_dir):
    return aggregate.median_row(A.left(spark, sf_dir), ["facility"], [F.col("rate")], upper=False).select("facility", F.col("rate").alias("lower_median"))


@register(with_("SELECT carrier, code FROM (SELECT carrier, code, row_number() OVER (PARTITION BY carrier ORDER BY count(*) DESC, code) AS i FROM rates GROUP BY carrier, code) WHERE i = 1"))
def most_frequent_code(spark, sf_dir):
    return aggregate.most_frequent(A.rates(spark, sf_dir), ["carrier"], "code")


# comparisons

@register(with_("SELECT system, facility, carrier, coalesce(CASE WHEN l_class <> r_class THEN 'different_billing_class' WHEN product_class = 'medicare_advantage' THEN 'tic_exempt_product' WHEN l_class IS NULL OR r_class IS NULL THEN 'billing_class_unstated' ELSE reason END, 'comparable') AS verdict, count(*) AS pairs FROM p GROUP BY ALL", f"{A.base_sql()}, {A.pairs_sql()}"))
def verdict_pairs(spark, sf_dir):
    return compare.pair_verdicts(A.left(spark, sf_dir), A.right(spark, sf_dir), ["system", "facility", "carrier"])


_ROW = "system, facility, code, carrier, plan, setting, billing_class, product_class, methodology, vintage, rate"


@register(with_(f"SELECT {_ROW}, outcome, n, payer_min, payer_median, payer_max, payer_plan, payer_vintage FROM ex", _EX), "rate payer_min payer_median payer_max")
def distribution_join(spark, sf_dir):
    return compare.distribution_join(A.left(spark, sf_dir), A.right(spark, sf_dir)).select(*_ROW.split(", "), "outcome", "n", "payer_min", "payer_median", "payer_max", "payer_plan", "payer_vintage")


@register(with_("SELECT system, outcome, count(*) AS hospital_rates, count(*) / CAST(sum(count(*)) OVER (PARTITION BY system) AS DOUBLE) AS share FROM ex GROUP BY system, outcome", _EX), "share")
def outcome_funnel(spark, sf_dir):
    n = A.explained(spark, sf_dir).groupBy("system", "outcome").agg(F.count("*").alias("hospital_rates"))
    return n.withColumn("share", F.col("hospital_rates") / F.sum("hospital_rates").over(Window.partitionBy("system")))


@register(with_(f"SELECT {_ROW}, ratio, relative_difference, is_material, is_implausible, inside, payer_label, explanation FROM ex WHERE outcome = 'compared'", _EX), "rate ratio relative_difference")
def explain_outcomes(spark, sf_dir):
    return A.explained(spark, sf_dir).where("outcome = 'compared'").select(*_ROW.split(", "), "ratio", "relative_difference", "is_material", "is_implausible", "inside", "payer_label", "explanation")


_PLANTED = """, planted AS (
  SELECT facility, carrier, plan, code, rate, 'unexplained' AS explanation, (CAST(1.1 AS DOUBLE) + CAST(0.1 AS DOUBLE) * (facility % 3)) * CASE WHEN code LIKE '%7' THEN 2 ELSE 1 END AS ratio FROM lft
), centre AS (
  SELECT *, count(*) OVER w AS m, median(ratio) OVER w AS c FROM planted WINDOW w AS (PARTITION BY facility, carrier, plan)
), offsets AS (
  SELECT facility, carrier, plan, count(*) FILTER (WHERE abs(ratio - c) / c <= 0.03) AS rows, count(DISTINCT code) FILTER (WHERE abs(ratio - c) / c <= 0.03) AS codes, median(ratio) FILTER (WHERE abs(ratio - c) / c <= 0.03) AS "offset"
  FROM centre GROUP BY facility, carrier, plan HAVING max(m) >= 20 AND codes >= 20 AND rows / max(m) >= 0.8
)"""


def _planted(spark, sf_dir):
    factor = F.when(F.col("code").endswith("7"), 2).otherwise(1)
    return A.left(spark, sf_dir).select("facility", "carrier", "plan", "code", "rate", F.lit("unexplained").alias("explanation"), ((F.lit(1.1) + F.lit(0.1) * (F.col("facility") % 3)) * factor).alias("ratio"))


@register(with_('SELECT facility, carrier, plan, rows, codes, "offset" FROM offsets', A.base_sql() + _PLANTED), '"offset"')
def systematic_offsets(spark, sf_dir):
    return compare.systematic_offsets(_planted(spark, sf_dir), ["facility", "carrier", "plan"])


@register(with_("SELECT p.facility, p.carrier, CASE WHEN abs(p.ratio - o.\"offset\") / o.\"offset\" <= 0.03 THEN 'systematic_offset' ELSE p.explanation END AS explanation, count(*) AS rows FROM planted p LEFT JOIN offsets o ON p.facility = o.facility AND p.carrier = o.carrier AND p.plan IS NOT DISTINCT FROM o.plan GROUP BY ALL", A.base_sql() + _PLANTED))
def offset_reclassified(spark, sf_dir):
    rows, keys = _planted(spark, sf_dir), ["facility", "carrier", "plan"]
    return compare.reclassify(rows, compare.systematic_offsets(rows, keys), keys).groupBy("facility", "carrier", "explanation").agg(F.count("*").alias("rows"))


_RANGE = """, fac AS (SELECT code, carrier, facility, median(rate) AS rate FROM lft GROUP BY ALL), h AS (
  SELECT code, carrier, count(*) AS facilities, min(rate) AS low, median(rate) AS hospital_median, max(rate) AS high FROM fac GROUP BY ALL HAVING count(*) >= 2
), pay AS (SELECT code, carrier, median(rate) AS payer_rate, count(*) AS payer_rows FROM rgt GROUP BY ALL), g AS (
  SELECT *, high / low AS width, CASE WHEN payer_rate < low THEN low / payer_rate WHEN payer_rate > high THEN payer_rate / high ELSE 1.0 END AS gap, payer_rate / hospital_median AS vs_median FROM h JOIN pay USING (code, carrier)
), rng AS (SELECT *, CASE WHEN gap >= 10 THEN 'implausible' WHEN payer_rate < low THEN 'below' WHEN payer_rate > high THEN 'above' ELSE 'inside' END AS verdict FROM g)"""


@register(with_("SELECT * FROM rng", A.base_sql() + _RANGE), "low hospital_median high payer_rate width gap vs_median")
def system_range(spark, sf_dir):
    return compare.system_range(A.left(spark, sf_dir), A.right(spark, sf_dir), ["code", "carrier"])


@register(with_("SELECT carrier, verdict, count(*) AS comparisons, median(gap) AS median_gap, median(width) AS median_width FROM rng GROUP BY carrier, verdict", A.base_sql() + _RANGE), "median_gap median_width")
def range_summary(spark, sf_dir):
    r = compare.system_range(A.left(spark, sf_dir), A.right(spark, sf_dir), ["code", "carrier"])
    return r.groupBy("carrier", "verdict").agg(F.count("*").alias("comparisons"), F.median("gap").alias("median_gap"), F.median("width").alias("median_width"))


@register(with_("""SELECT code, carrier, count(*) AS facilities, min(rate) AS low, arg_min(facility, (rate, facility)) AS low_facility, max(rate) AS high, arg_min(facility, (-rate, facility)) AS high_facility,
  max(rate) / min(rate) AS ratio, (max(rate) - min(rate)) / min(rate) AS relative_difference FROM (
  SELECT code, carrier, facility, rate FROM (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY code, carrier, facility) AS c FROM lft WINDOW w AS (PARTITION BY code, carrier, facility ORDER BY rate)) WHERE i = c // 2 + 1
) GROUP BY code, carrier HAVING count(*) >= 2"""), "low high ratio relative_difference")
def cross_facility_extremes(spark, sf_dir):
    return compare.across_facilities(A.left(spark, sf_dir), ["code", "carrier"])


# published tables

@register(with_("""SELECT system, count(*) AS candidates, count(*) FILTER (WHERE outcome = 'compared') AS pairs_formed, count(*) FILTER (WHERE outcome = 'compared') / count(*) AS comparable_share,
  count(*) FILTER (WHERE outcome <> 'different_billing_class') AS like_class_candidates, count(*) FILTER (WHERE outcome = 'compared') / count(*) FILTER (WHERE outcome <> 'different_billing_class') AS like_class_share,
  count(*) FILTER (WHERE outcome = 'compared' AND is_material) AS material, count(*) FILTER (WHERE outcome = 'compared' AND is_material AND explanation = 'unexplained') AS unexplained_and_material,
  count(DISTINCT facility) AS facilities, count(DISTINCT carrier) FILTER (WHERE outcome = 'compared') AS carriers FROM ex GROUP BY system""", _EX), "comparable_share like_class_share")
def gold_coverage(spark, sf_dir):
    return gold.coverage(A.explained(spark, sf_dir))


@register(with_("SELECT system, facility, carrier, code_type, explanation, count(*) AS pairs, count(*) FILTER (WHERE is_material) AS material_pairs FROM ex WHERE outcome = 'compared' GROUP BY ALL", _EX))
def gold_outcomes(spark, sf_dir):
    return gold.outcomes(A.explained(spark, sf_dir))


@register(with_("SELECT outcome AS reason, system, facility, carrier, code_type, count(*) AS candidates FROM ex WHERE outcome <> 'compared' GROUP BY ALL", _EX))
def refusals_by_reason(spark, sf_dir):
    return gold.refusals(A.explained(spark, sf_dir))


@register(with_("""SELECT a.*, b.p90_relative_difference FROM (SELECT system, carrier, code_type, count(*) AS residual_pairs, median(relative_difference) AS median_relative_difference, median(abs(difference)) AS median_abs_difference_usd,
  count(*) FILTER (WHERE is_implausible) AS implausible_pairs FROM res GROUP BY ALL) a JOIN (SELECT system, carrier, code_type, relative_difference AS p90_relative_difference FROM (
  SELECT *, row_number() OVER (PARTITION BY system, carrier, code_type ORDER BY relative_difference) AS i, count(*) OVER (PARTITION BY system, carrier, code_type) AS c FROM res)
  WHERE i = greatest(1, least(c, CASE WHEN c * 9 % 10 = 5 THEN (c * 9 // 10) + (c * 9 // 10) % 2 ELSE (c * 9 + 5) // 10 END))) b USING (system, carrier, code_type)""", _EX), "median_relative_difference median_abs_difference_usd p90_relative_difference")
def gold_magnitude(spark, sf_dir):
    return gold.magnitude(A.explained(spark, sf_dir))


@register(with_("""SELECT system, facility, carrier, count(*) AS hospital_rates, count(*) FILTER (WHERE outcome = 'compared') AS compared, count(*) FILTER (WHERE outcome = 'compared' AND is_material) AS material,
  count(*) FILTER (WHERE outcome = 'compared' AND is_material AND explanation = 'unexplained') AS unexplained_material, median(CASE WHEN outcome = 'compared' THEN ratio - 1 END) AS median_signed_gap,
  CAST(coalesce(sum(CAST(CASE WHEN outcome = 'compared' AND is_material AND explanation = 'unexplained' THEN abs(payer_median - rate) END AS DECIMAL(28, 9))), 0) AS DOUBLE) AS summed_abs_gap_usd,
  CASE WHEN compared > 0 THEN count(*) FILTER (WHERE outcome = 'compared' AND inside) / compared END AS inside_range_share,
  CASE WHEN count(*) FILTER (WHERE outcome <> 'different_billing_class') > 0 THEN compared / count(*) FILTER (WHERE outcome <> 'different_billing_class') END AS like_class_share
  FROM ex GROUP BY system, facility, carrier""", _EX), "median_signed_gap summed_abs_gap_usd inside_range_share like_class_share")
def gold_pairs(spark, sf_dir):
    return gold.pairs(A.explained(spark, sf_dir))


@register(with_("""SELECT system, facility, carrier, code, code_type, count(*) AS hospital_rates, median(rate) AS hospital_rate, count(*) FILTER (WHERE outcome = 'compared') AS compared, min(payer_min) AS payer_min, median(payer_median) AS payer_median,
  max(payer_max) AS payer_max, max(n) AS payer_count, CASE WHEN count(*) FILTER (WHERE outcome = 'compared') > 0 THEN count(*) FILTER (WHERE outcome = 'compared' AND inside) / count(*) FILTER (WHERE outcome = 'compared') END AS inside_share,
  coalesce(max(me.kind), '') AS explanation_before_offsets, CASE WHEN count(*) FILTER (WHERE outcome = 'compared') > 0 THEN '' ELSE coalesce(max(mr.kind), '') END AS refusal
  FROM ex LEFT JOIN modes me ON me.done AND me.k = (ex.system, ex.facility, ex.carrier, ex.code, ex.code_type) LEFT JOIN modes mr ON NOT mr.done AND mr.k = (ex.system, ex.facility, ex.carrier, ex.code, ex.code_type) GROUP BY ALL""", _EX + """, modes AS (
  SELECT k, done, kind FROM (SELECT (system, facility, carrier, code, code_type) AS k, outcome = 'compared' AS done, CASE WHEN outcome = 'compared' THEN explanation_before ELSE outcome END AS kind,
  row_number() OVER (PARTITION BY system, facility, carrier, code, code_type, outcome = 'compared' ORDER BY count(*) DESC, CASE WHEN outcome = 'compared' THEN explanation_before ELSE outcome END) AS i FROM ex GROUP BY system, facility, carrier, code, code_type, done, kind) WHERE i = 1)"""), "hospital_rate payer_min payer_median payer_max inside_share")
def gold_rates(spark, sf_dir):
    return gold.rates(A.explained(spark, sf_dir), A.right(spark, sf_dir))


@register(with_('SELECT system, facility, carrier, plan, payer_label, max(contract_offset) AS "offset", count(*) AS pairs, count(*) FILTER (WHERE explanation = \'systematic_offset\') AS reclassified FROM ex WHERE contract_offset IS NOT NULL GROUP BY ALL', _EX), '"offset"')
def gold_offsets(spark, sf_dir):
    return gold.offsets(A.explained(spark, sf_dir))


@register("SELECT p_brand, p_name, rows FROM (SELECT p_brand, p_name, count(*) AS rows, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_name) AS i FROM part GROUP BY p_brand, p_name) WHERE i = 1")
def gold_codes(spark, sf_dir):
    return gold.codes(A.table(spark, sf_dir, "part"), ["p_brand"], "p_name")


@register(with_("""SELECT system, CASE WHEN outcome = 'compared' THEN 'explanation' ELSE 'refusal' END AS measure, CASE WHEN outcome = 'compared' THEN explanation ELSE outcome END AS name, count(*) AS value FROM ex GROUP BY ALL
  UNION ALL SELECT system, 'coverage', 'candidates', count(*) FROM ex GROUP BY ALL UNION ALL SELECT system, 'coverage', 'pairs_formed', count(*) FILTER (WHERE outcome = 'compared') FROM ex GROUP BY ALL
  UNION ALL SELECT system, 'coverage', 'material', count(*) FILTER (WHERE outcome = 'compared' AND is_material) FROM ex GROUP BY ALL
  UNION ALL SELECT system, 'coverage', 'unexplained_and_material', count(*) FILTER (WHERE outcome = 'compared' AND is_material AND explanation = 'unexplained') FROM ex GROUP BY ALL""", _EX))
def gold_measures(spark, sf_dir):
    return gold.measures(A.explained(spark, sf_dir))


_TIES = "code, code_type, facility, plan NULLS FIRST, setting, billing_class NULLS FIRST, vintage, rate, payer_median"


@register(with_(f"SELECT system, carrier, code, facility, plan, setting, vintage, rate, relative_difference, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY system, carrier ORDER BY relative_difference DESC, {_TIES}) AS INT) AS rank FROM res) WHERE rank <= 25", _EX), "rate relative_difference")
def exemplars_top25(spark, sf_dir):
    return gold.exemplars(A.explained(spark, sf_dir)).select("system", "carrier", "code", "facility", "plan", "setting", "vintage", "rate", "relative_difference", "rank")


@register(with_(f"SELECT system, facility, carrier, code, plan, setting, vintage, rate, difference, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY system, facility, carrier ORDER BY abs(difference) DESC, {_TIES}) AS INT) AS rank FROM res) WHERE rank <= 100", _EX), "rate difference")
def residual_top100(spark, sf_dir):
    return gold.residual_top(A.explained(spark, sf_dir)).select("system", "facility", "carrier", "code", "plan", "setting", "vintage", "rate", "difference", "rank")


@register(with_("SELECT outcome AS reason, count(*) AS candidates, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share_of_refused, count(*) / (SELECT count(*) FROM ex) AS lift FROM ex WHERE outcome <> 'compared' GROUP BY outcome", _EX), "share_of_refused lift")
def lever_weights(spark, sf_dir):
    return gold.lever_weights(A.explained(spark, sf_dir))


# triage

_QUEUE = """, nr AS (SELECT a.*, (SELECT count(*) FROM res b WHERE b.carrier = a.carrier AND b.code_type = a.code_type AND abs(b.ratio - a.ratio) / a.ratio <= CAST(0.03 AS DOUBLE)) AS near, count(*) OVER (PARTITION BY carrier, code_type) AS size FROM res a),
tq AS (SELECT *, days AS gap_days, CASE WHEN is_implausible THEN 'implausible' WHEN days >= 180 THEN 'vintage_artifact' WHEN size >= 5 AND near >= 5 THEN 'systematic_offset' WHEN (coalesce(plan, '') <> '') <> (payer_label <> '') THEN 'granularity_mismatch'
  WHEN relative_difference > 0 AND relative_difference < CAST(0.08 AS DOUBLE) THEN 'marginal' ELSE 'unexplained' END AS rule FROM nr),
pq AS (SELECT *, CAST(list_position(['implausible', 'vintage_artifact', 'systematic_offset', 'granularity_mismatch', 'marginal', 'unexplained'], rule) AS INT) AS priority FROM tq)"""


def _queue(spark, sf_dir):
    return triage.queue(gold.residual(A.explained(spark, sf_dir)), ["carrier", "code_type"])


@register(with_("SELECT carrier, facility, code, plan, setting, vintage, rate, ratio, gap_days, near, rule, priority FROM pq", _EX + _QUEUE), "rate ratio")
def triage_queue(spark, sf_dir):
    return _queue(spark, sf_dir).select("carrier", "facility", "code", "plan", "setting", "vintage", "rate", "ratio", "gap_days", "near", "rule", "priority")


@register(with_("SELECT system, rule, priority, count(*) AS findings, count(*) / CAST(sum(count(*)) OVER (PARTITION BY system) AS DOUBLE) AS share FROM pq GROUP BY system, rule, priority", _EX + _QUEUE), "share")
def triage_summary(spark, sf_dir):
    return triage.summary(_queue(spark, sf_dir), ["system"])


@register(with_("""SELECT *, greatest(median_ratio, 1 / median_ratio) * (CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * least(findings, 5) / 5) AS magnitude FROM (SELECT code, carrier, count(*) AS findings, median(ratio) AS median_ratio, count(*) FILTER (WHERE ratio > 1) AS up,
  count(*) FILTER (WHERE ratio < 1) AS down, (max(ratio) - min(ratio)) / median(ratio) AS spread, count(DISTINCT facility) AS facilities FROM res GROUP BY code, carrier)""", _EX), "median_ratio spread magnitude")
def service_groups(spark, sf_dir):
    return triage.service_groups(gold.residual(A.explained(spark, sf_dir)))


@register(with_("""SELECT a.*, b.p90_days FROM (SELECT carrier, median(days) AS median_days, min(days) AS min_days, max(days) AS max_days, count(*) FILTER (WHERE days IS NULL) AS unknown, count(*) FILTER (WHERE days > 180) AS beyond FROM cx GROUP BY carrier) a
  JOIN (SELECT carrier, days AS p90_days FROM (SELECT *, row_number() OVER (PARTITION BY carrier ORDER BY days) AS i, count(*) OVER (PARTITION BY carrier) AS c FROM cx WHERE days IS NOT NULL) WHERE i = least(c, c * 9 // 10 + 1)) b USING (carrier)""", _EX + ", cx AS (SELECT * FROM ex WHERE outcome = 'compared')"), "median_days")
def vintage_alignment(spark, sf_dir):
    rows = A.explained(spark, sf_dir).where("outcome = 'compared'").withColumn("days", F.abs(F.datediff("vintage", "payer_vintage")).cast("long"))
    out = rows.groupBy("carrier").agg(F.median("days").alias("median_days"), F.min("days").alias("min_days"), F.max("days").alias("max_days"), F.count_if(F.col("days").isNull()).alias("unknown"), F.count_if(F.col("days") > 180).alias("beyond"))
    return out.join(aggregate.p90_floor(rows, ["carrier"], "days").withColumnRenamed("p90", "p90_days"), "carrier")


# ranks and look-ups

_CELL = ", cell AS (SELECT facility, code, median(rate) AS rate FROM lft GROUP BY facility, code)"


def _cells(spark, sf_dir):
    return A.left(spark, sf_dir).groupBy("facility", "code").agg(F.median("rate").alias("rate"))


@register(with_("SELECT *, cume_dist() OVER (PARTITION BY code ORDER BY rate) AS percentile, median(rate) OVER w AS peer_median, min(rate) OVER w AS peer_min, max(rate) OVER w AS peer_max, count(*) OVER w AS peers, count(*) OVER w >= 5 AS reliable FROM cell WINDOW w AS (PARTITION BY code)", A.base_sql() + _CELL), "rate percentile peer_median peer_min peer_max")
def market_rank(spark, sf_dir):
    return market.peer_rank(_cells(spark, sf_dir), ["code"])


@register(with_("SELECT code, CAST(round(sum(CAST(CASE WHEN percentile < 0.25 THEN greatest(peer_median - rate, 0) * 10 ELSE 0 END AS DECIMAL(28, 9))), 6) AS DECIMAL(28, 6)) AS opportunity FROM (SELECT code, rate, cume_dist() OVER (PARTITION BY code ORDER BY rate) AS percentile, median(rate) OVER (PARTITION BY code) AS peer_median FROM cell) GROUP BY code", A.base_sql() + _CELL))
def weighted_opportunity(spark, sf_dir):
    r = market.opportunity(market.peer_rank(_cells(spark, sf_dir), ["code"]), 0.25, F.lit(10))
    return r.groupBy("code").agg(F.round(F.sum(F.col("opportunity").cast("decimal(28,9)")), 6).cast("decimal(28,6)").alias("opportunity"))


@register(with_("SELECT code, min(rate) AS low, arg_min(facility, (rate, facility)) AS low_facility, max(rate) AS high, arg_min(facility, (-rate, facility)) AS high_facility, median(rate) AS median_rate, max(rate) / min(rate) AS ratio FROM cell GROUP BY code", A.base_sql() + _CELL), "low high median_rate ratio")
def market_spreads(spark, sf_dir):
    return market.spreads(_cells(spark, sf_dir), ["code"])


@register(with_("SELECT *, CAST(row_number() OVER (ORDER BY coalesce(abs(gap), -1) DESC, facility, carrier) AS INT) AS rank FROM (SELECT facility, carrier, median(CASE WHEN outcome = 'compared' THEN ratio - 1 END) AS gap FROM ex GROUP BY facility, carrier)", _EX), "gap")
def rankings(spark, sf_dir):
    return market.rankings(gold.pairs(A.explained(spark, sf_dir)).select("facility", "carrier", F.col("median_signed_gap").alias("gap")), "gap", ["facility", "carrier"])


@register(with_("SELECT *, rate / min(rate) OVER w AS vs_lowest, rate / median(rate) OVER w AS vs_median, rate = min(rate) OVER w AS is_lowest, rate / median(rate) OVER w >= 3 OR rate / median(rate) OVER w <= CAST(1 AS DOUBLE) / 3 AS far FROM cell WINDOW w AS (PARTITION BY code)", A.base_sql() + _CELL), "rate vs_lowest vs_median")
def head_to_head(spark, sf_dir):
    return market.head_to_head(_cells(spark, sf_dir), ["code"])


@register(with_('SELECT facility, median(x) AS "index", count(*) FILTER (WHERE win) AS wins, count(*) AS published FROM (SELECT facility, rate / median(rate) OVER w AS x, rate = min(rate) OVER w AS win FROM cell WINDOW w AS (PARTITION BY code)) GROUP BY facility', A.base_sql() + _CELL), '"index"')
def scorecard(spark, sf_dir):
    return market.scorecard(_cells(spark, sf_dir), "code", "facility")


@register(with_("SELECT code, facility, min(rate) FILTER (WHERE plan = 'HMO') AS tier_rate, min(rate) FILTER (WHERE plan = 'ChoicePPO') AS standard_rate, tier_rate / standard_rate AS ratio FROM lft GROUP BY code, facility HAVING count(DISTINCT rate) FILTER (WHERE plan = 'HMO') = 1 AND count(DISTINCT rate) FILTER (WHERE plan = 'ChoicePPO') = 1"), "tier_rate standard_rate ratio")
def tier_vs_standard(spark, sf_dir):
    return market.tier_ratios(A.left(spark, sf_dir), ["code", "facility"], "plan", "HMO", "ChoicePPO")


@register(with_("SELECT code, carrier, min(rate) AS low, max(rate) AS high, count(DISTINCT rate) AS n_rates, string_agg(DISTINCT setting, ',' ORDER BY setting) AS labels FROM lft GROUP BY code, carrier"), "low high")
def cell_ranges(spark, sf_dir):
    return market.cell_ranges(A.left(spark, sf_dir), ["code", "carrier"])


_SIDES = ", a AS (SELECT system, code, carrier, median(rate) AS a_rate FROM lft GROUP BY ALL), b AS (SELECT system, code, carrier, median(rate) AS b_rate FROM rgt GROUP BY ALL)"


@register(with_("SELECT system, code, carrier, a_rate, b_rate, CASE WHEN b_rate IS NULL THEN 'a only' WHEN a_rate IS NULL THEN 'b only' WHEN a_rate = b_rate THEN 'equal' ELSE 'differ' END AS found, a_rate / b_rate AS ratio FROM a FULL JOIN b USING (system, code, carrier)", A.base_sql() + _SIDES), "a_rate b_rate ratio")
def full_outer_crosscheck(spark, sf_dir):
    keys = ["system", "code", "carrier"]
    side = lambda df: df.groupBy(*keys).agg(F.median("rate").alias("rate"))
    return market.cross_check(side(A.left(spark, sf_dir)), side(A.right(spark, sf_dir)), keys)


@register(with_("SELECT carrier, quantile_cont(rate, 0.05) AS p05, quantile_cont(rate, 0.5) AS p50, quantile_cont(rate, 0.95) AS p95 FROM lft GROUP BY carrier"), "p05 p50 p95")
def quantiles(spark, sf_dir):
    return A.left(spark, sf_dir).groupBy("carrier").agg(*(F.percentile("rate", q).alias(n) for n, q in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register(with_(f"SELECT code, {', '.join(f"median(rate) FILTER (WHERE carrier = '{c}') AS {c}" for c in _SEGMENTS)} FROM lft GROUP BY code"), " ".join(_SEGMENTS))
def pivot_campus_network(spark, sf_dir):
    return market.wide(A.left(spark, sf_dir), "code", "carrier", _SEGMENTS, F.median("rate"))


@register("SELECT l_orderkey, l_linenumber, 'P' AS payer_name, 'A' AS plan_name, 'negotiated_dollar' AS measure, CAST(CAST(l_quantity AS INT) AS STRING) AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'P', 'A', 'negotiated_percentage', CAST(l_linenumber AS STRING) FROM lineitem WHERE l_returnflag = 'R'")
def wide_to_long(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem")
    wide = t.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").cast("string").alias("standard_charge|P|A|negotiated_dollar"), F.when(F.col("l_returnflag") == "R", F.col("l_linenumber").cast("string")).otherwise(" ").alias("standard_charge|P|A|negotiated_percentage"))
    return files.unpivot_wide(wide, ["l_orderkey", "l_linenumber"])


# lake and contracts

@register(with_("SELECT system, count(*) FILTER (WHERE billing_class = 'professional') AS professional, count(*) FILTER (WHERE billing_class = 'professional') = 0 AS eligible FROM rates WHERE side = 0 GROUP BY system"))
def eligibility(spark, sf_dir):
    n = F.count_if(X.folded(F.col("billing_class")) == "professional")
    return A.rates(spark, sf_dir).where("side = 0").groupBy("system").agg(n.alias("professional"), (n == 0).alias("eligible"))


@register(with_("""SELECT * FROM (SELECT carrier AS file, 'null:plan' AS rule, count(*) FILTER (WHERE plan IS NULL) AS violations FROM rates GROUP BY ALL UNION ALL SELECT carrier, 'null:billing_class', count(*) FILTER (WHERE billing_class IS NULL) FROM rates GROUP BY ALL
  UNION ALL SELECT carrier, 'below:rate', count(*) FILTER (WHERE rate < 100) FROM rates GROUP BY ALL UNION ALL SELECT carrier, 'varies:vintage', count(DISTINCT vintage) - 1 FROM rates GROUP BY ALL) WHERE violations > 0"""))
def contract_report(spark, sf_dir):
    r = A.rates(spark, sf_dir).withColumn("file", F.col("carrier"))
    return files.contract_report(r, "file", "carrier", ["plan", "billing_class"], {"rate": 100}, ["vintage"], [])


@register(with_("SELECT coalesce(a.system, b.system) AS system, coalesce(a.code, b.code) AS code, a.n AS expected, b.n AS observed, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'unexpected' WHEN a.n = b.n THEN 'same' ELSE 'changed' END AS status FROM (SELECT system, code, count(*) AS n FROM rates WHERE side = 0 GROUP BY ALL) a FULL JOIN (SELECT system, code, count(*) AS n FROM rates WHERE side = 1 GROUP BY ALL) b ON a.system = b.system AND a.code = b.code"))
def manifest_diff(spark, sf_dir):
    n = lambda side: A.rates(spark, sf_dir).where(f"side = {side}").groupBy("system", "code").agg(F.count("*").alias("n"))
    return lake.manifest_diff(n(0), n(1), ["system", "code"], "n")


# text and entities

@register("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def explode_codes_json(spark, sf_dir):
    return A.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@register("""WITH r(service, revenue, procedure, excluded) AS (VALUES ('a', ['1', '2'], CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])), ('b', CAST([] AS VARCHAR[]), ['BRAND#2', 'BRAND#4'], CAST([] AS VARCHAR[])), ('c', ['3', '4', '5'], ['BRAND#2', 'BRAND#17'], ['BRAND#17']))
SELECT p_partkey, service FROM part JOIN r ON (len(revenue) = 0 OR list_contains(revenue, CAST(p_size AS VARCHAR))) AND (len(procedure) = 0 OR list_contains(procedure, upper(p_brand))) AND NOT list_contains(excluded, upper(p_brand))""")
def service_rule_match(spark, sf_dir):
    rows = A.table(spark, sf_dir, "part").select("p_partkey", F.array(F.col("p_size").cast("string")).alias("revenue"), F.array(F.upper("p_brand")).alias("procedure"))
    rules = spark.createDataFrame([("a", ["1", "2"], [], []), ("b", [], ["BRAND#2", "BRAND#4"], []), ("c", ["3", "4", "5"], ["BRAND#2", "BRAND#17"], ["BRAND#17"])], "service string, revenue array<string>, procedure array<string>, excluded array<string>")
    return conform.rule_matches(rows, rules).select("p_partkey", "service")


@register("SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(p_type || '_[12]' || p_name || '&amp;' || p_brand, '\\[[^\\]]*\\]', ' ', 'g').replace('&amp;', '&'), '[_/|,;+&()\\[\\]-]+', ' ', 'g'), '\\s+', ' ', 'g')) AS name FROM part")
def normalise_text(spark, sf_dir):
    return A.table(spark, sf_dir, "part").select("p_partkey", X.normalise_name(F.concat("p_type", F.lit("_[12]"), "p_name", F.lit("&amp;"), "p_brand")).alias("name"))


@register("SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query FROM pages")
def url_parts(spark, sf_dir):
    part = lambda p: F.regexp_extract("url", p, 1)
    return A.table(spark, sf_dir, "pages").select("page_id", part(r"^https?://([^/?#]+)").alias("host"), part(r"^https?://[^/?#]+([^?#]*)").alias("path"), part(r"\?([^#]*)").alias("query"))


@register("""SELECT p_name, CASE WHEN regexp_matches(p_name, '\\bsmall ring\\b') THEN 'Ring, small' WHEN regexp_matches(p_name, '\\bring\\b') THEN 'Ring' WHEN regexp_matches(p_name, '\\bbolt\\b') THEN 'Bolt' END AS canonical, count(*) AS n FROM part GROUP BY ALL""")
def alias_match(spark, sf_dir):
    aliases = resolve.alias_table(spark, {"Ring": ["ring"], "Ring, small": ["small ring"], "Bolt": ["bolt"]})
    return resolve.alias_match(A.table(spark, sf_dir, "part").select("p_name"), "p_name", aliases).groupBy("p_name", "canonical").agg(F.count("*").alias("n"))


_JACCARD = """WITH l AS (SELECT DISTINCT p_name AS name, list_distinct(string_split(p_name, ' ')) AS t FROM part), r AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS name, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) AS t FROM part),
s AS (SELECT l.name, r.name AS match, len(list_intersect(l.t, r.t)) / len(list_distinct(list_concat(l.t, r.t))) AS score FROM l JOIN r ON len(list_intersect(l.t, r.t)) > 0),
k AS (SELECT *, row_number() OVER w AS i, coalesce(lead(score) OVER w, 0) AS second FROM s WINDOW w AS (PARTITION BY name ORDER BY score DESC, match))
SELECT name, match, score, second, score >= 0.72 AND score - second >= 0.08 AS sure FROM k WHERE i = 1"""


@register(_JACCARD, "score second")
def jaccard_match(spark, sf_dir):
    part = A.table(spark, sf_dir, "part")
    return resolve.match_names(part.select(F.col("p_name").alias("name")), part.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name")))


@register(_JACCARD, "score second")
def jaccard_match_whole(spark, sf_dir):
    return jaccard_match(spark, sf_dir)


@register("""SELECT l_orderkey, l_linenumber, lower(trim(l_returnflag)) AS billing_class, strftime(l_shipdate, '%Y-%m') AS vintage, substr(sha256(CAST(l_orderkey AS VARCHAR) || '␟' || CAST(l_linenumber AS VARCHAR) || '␟' || l_returnflag || '␟' || l_linestatus), 1, 32) AS row_hash FROM lineitem""")
def conform_and_hash(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").withColumns({"billing_class": F.col("l_returnflag"), "hospital": F.col("l_linestatus"), "file_vintage": F.date_format("l_shipdate", "yyyy-MM-dd")})
    return lake.conform(t).select("l_orderkey", "l_linenumber", "billing_class", "vintage", X.row_hash(*(F.col(c) for c in ("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))).alias("row_hash"))


_RAW = """CASE WHEN l_linenumber = 1 AND l_quantity < 5 THEN '' ELSE 'Acme ' || l_returnflag END AS payer, CASE WHEN l_linenumber = 2 THEN 'Self Pay' WHEN l_linenumber = 3 THEN 'Medicare Advantage' WHEN l_linenumber = 4 THEN 'PPO' ELSE 'Acme ' || l_returnflag END AS plan,
CASE WHEN l_quantity = 7 THEN 'n/a' WHEN l_quantity = 8 THEN '-5' WHEN l_quantity = 9 THEN '$20,000,000' WHEN l_quantity = 10 THEN '' ELSE '$1,' || CAST(100 + CAST(l_quantity AS INT) AS STRING) || '.50' END AS dollar"""


@register(f"""SELECT reject, product_class, rate_dollar, count(*) AS rows FROM (SELECT
  CASE WHEN payer = '' THEN 'missing_payer' WHEN plan = 'Self Pay' THEN 'non_payer_row' WHEN dollar = '' THEN 'no_rate_value' WHEN dollar = 'n/a' THEN 'non_numeric_rate' WHEN dollar = '-5' THEN 'negative_rate' WHEN dollar = '$20,000,000' THEN 'implausible_rate' END AS reject,
  CASE plan WHEN 'Self Pay' THEN 'non_payer' WHEN 'Medicare Advantage' THEN 'medicare_advantage' WHEN 'PPO' THEN 'commercial' ELSE CASE WHEN lower(plan) = lower(payer) THEN 'no_plan_detail' ELSE 'unclassified' END END AS product_class,
  TRY_CAST(replace(replace(dollar, '$', ''), ',', '') AS DOUBLE) AS rate_dollar FROM (SELECT {_RAW} FROM lineitem)) GROUP BY ALL""", "rate_dollar")
def curate_rates(spark, sf_dir):
    raw = A.table(spark, sf_dir, "lineitem").selectExpr(*(x.strip() for x in _split_sql(_RAW))).select(
        F.lit("s3://x").alias("source_url"), F.col("payer").alias("payer_name"), F.col("plan").alias("plan_name"), F.lit("70450").alias("code"), F.lit("CPT").alias("code_type"), F.lit("outpatient").alias("setting"), F.lit("facility").alias("billing_class"),
        F.col("dollar").alias("rate_dollar"), *(F.lit(None).cast("string").alias(c) for c in ("rate_percentage", "rate_algorithm", "methodology")), F.lit("4/1/2026").alias("file_vintage"),
    )
    return conform.curate(raw).groupBy("reject", "product_class", "rate_dollar").agg(F.count("*").alias("rows"))


def _split_sql(columns: str) -> list[str]:
    """A select list's items, cut at the commas that follow AS names."""
    out = [""]
    for part in columns.replace("\n", " ").split(","):
        out[-1] += part
        head = out[-1].split(" AS ")
        if len(head) > 1 and head[-1].strip().isidentifier():
            out.append("")
        else:
            out[-1] += ","
    return [x for x in out if x.strip()]


# payments

_CLAIM = """CAST(5000 AS DOUBLE) + s_nationkey * 100 AS discharge_rate, CAST(400 AS DOUBLE) AS capital_per_discharge, CAST(80 AS DOUBLE) AS capital_per_diem, CAST(120 AS DOUBLE) AS addons_per_discharge, CAST(60 AS DOUBLE) AS transfer_addons,
CAST(550 AS DOUBLE) AS alc_rate, CAST(900 AS DOUBLE) AS dme_rate, CAST(0.1 AS DOUBLE) AS ime_pct, CAST(1.1 AS DOUBLE) AS isaf, CAST(0.5 AS DOUBLE) AS charge_converter, CAST(0 AS DOUBLE) AS hcra_surcharge, l_quantity / 20 AS siw, CAST(l_linenumber AS DOUBLE) AS alos,
CAST(9000 AS DOUBLE) AS cost_threshold, CAST(l_quantity AS INT) AS days, CAST(l_linenumber AS INT) AS alc_days, l_extendedprice AS gross_charges, l_discount * 1000 AS non_covered_charges, l_returnflag = 'R' AS is_transfer"""


@register(f"""SELECT l_orderkey, l_linenumber, payment_type, total, total * CAST(0.0704 AS DOUBLE) AS surcharge FROM (SELECT *, CASE WHEN is_transfer THEN 'transfer' WHEN costs > lim THEN 'high_cost_outlier' ELSE 'inlier' END AS payment_type,
  CASE WHEN is_transfer THEN least(moved, drg) + alc WHEN costs > lim THEN drg + alc + costs - lim ELSE drg + alc END AS total FROM (SELECT *, discharge_rate * siw + capital_per_discharge + addons_per_discharge AS drg, alc_rate * alc_days AS alc,
  (discharge_rate * siw / alos * CASE WHEN alos <= 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(1.2 AS DOUBLE) END + capital_per_diem) * (days - alc_days) + transfer_addons AS moved, (gross_charges - non_covered_charges) * charge_converter AS costs, cost_threshold * isaf AS lim
  FROM (SELECT l_orderkey, l_linenumber, {_CLAIM} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)))""", "total surcharge")
def payment_model(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").join(A.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return payment.payments(t.selectExpr("l_orderkey", "l_linenumber", *_split_sql(_CLAIM))).select("l_orderkey", "l_linenumber", "payment_type", "total", "surcharge")


_MIX = "SELECT p_brand AS drg, CAST(p_size % 4 + 1 AS INT) AS severity, CAST(count(*) AS DOUBLE) AS cases, CAST(avg(p_size) / 10 AS DOUBLE) AS siw, CAST(5000 AS DOUBLE) AS discharge_rate FROM part GROUP BY p_brand, p_size % 4"


def _mix(spark, sf_dir):
    return A.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("drg"), (F.col("p_size") % 4 + 1).cast("int").alias("severity")).agg(F.count("*").cast("double").alias("cases"), (F.avg("p_size") / 10).alias("siw"), F.lit(5000.0).alias("discharge_rate"))


@register(f"SELECT drg, severity, sum(cases) AS cases FROM (SELECT drg, severity, CASE WHEN severity < 4 THEN round_even(cases * CAST(0.75 AS DOUBLE), 0) ELSE cases END AS cases FROM ({_MIX}) UNION ALL SELECT drg, severity + 1, cases - round_even(cases * CAST(0.75 AS DOUBLE), 0) FROM ({_MIX}) WHERE severity < 4) GROUP BY drg, severity", "cases")
def shift_severity(spark, sf_dir):
    return payment.shift_severity(_mix(spark, sf_dir).select("drg", "severity", "cases"), 0.25)


@register(f"SELECT drg, sum(siw * cases * discharge_rate) AS base, sum(siw * round_even(cases * CAST(1.5 AS DOUBLE), 0) * discharge_rate * CAST(1.1 AS DOUBLE)) AS scenario, scenario - base AS delta, CASE WHEN base <> 0 THEN (scenario - base) / base ELSE 0 END AS pct FROM ({_MIX}) GROUP BY drg", "base scenario delta pct")
def scenario_delta(spark, sf_dir):
    total = lambda df, n: df.groupBy("drg").agg(F.sum(F.col("siw") * F.col("cases") * F.col("discharge_rate")).alias(n))
    mix = _mix(spark, sf_dir)
    out = total(mix, "base").join(total(payment.scenario(mix, volume=1.5, rate=1.1), "scenario"), "drg").withColumn("delta", F.col("scenario") - F.col("base"))
    return out.withColumn("pct", F.when(F.col("base") != 0, F.col("delta") / F.col("base")).otherwise(0.0))


@register("SELECT l_orderkey, l_linenumber, l_extendedprice - 900 * l_quantity AS margin, (l_extendedprice - 900 * l_quantity) / l_extendedprice AS margin_pct, (l_extendedprice - 900 * l_quantity) / l_quantity AS per_case, l_extendedprice < 900 * l_quantity AS underwater FROM lineitem", "margin margin_pct per_case")
def margin_lines(spark, sf_dir):
    t = A.table(spark, sf_dir, "lineitem").withColumn("_cost", 900 * F.col("l_quantity"))
    return payment.margins(t, "l_extendedprice", "_cost", "l_quantity").select("l_orderkey", "l_linenumber", "margin", "margin_pct", "per_case", "underwater")


@register("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice * l_quantity AS DECIMAL(28, 2))) AS DOUBLE) / sum(l_quantity) AS mean FROM lineitem GROUP BY l_returnflag", "mean")
def weighted_mean(spark, sf_dir):
    return A.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(payment.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity")).alias("mean"))


@register(with_("""SELECT facility, code, failure, benchmark_amount, CASE WHEN failure IS NULL THEN rate / benchmark_amount END AS percent_of_benchmark FROM (SELECT *, CASE WHEN schedule IS NULL THEN 'unsupported_code_type' WHEN amount IS NULL AND weight IS NULL THEN 'no_benchmark_for_code' WHEN weight IS NOT NULL AND base IS NULL THEN 'no_geography_for_hospital' WHEN weight IS NOT NULL AND wage_index IS NULL THEN 'no_wage_index_for_area' WHEN benchmark_amount <= 0 THEN 'zero_benchmark' END AS failure FROM (
  SELECT *, CASE WHEN weight IS NOT NULL THEN weight * base * (CAST(0.677 AS DOUBLE) * wage_index + CAST(0.323 AS DOUBLE)) WHEN schedule = 'opps' AND wage_index IS NOT NULL THEN amount * (CAST(0.6 AS DOUBLE) * wage_index + CAST(0.4 AS DOUBLE)) ELSE amount END AS benchmark_amount FROM (
  SELECT c.facility, c.code, c.rate, c.schedule, b.amount, b.weight, w.wage_index, w.base FROM sch c LEFT JOIN ben b USING (schedule, code) LEFT JOIN (SELECT n_nationkey AS facility, CASE WHEN n_nationkey % 7 > 0 THEN CAST(0.9 AS DOUBLE) + CAST(0.01 AS DOUBLE) * n_nationkey END AS wage_index, CAST(6000 AS DOUBLE) AS base FROM nation WHERE n_nationkey % 5 <> 0) w USING (facility))))""",
  A.base_sql() + _CELL + """, sch AS (SELECT *, CASE length(code) % 3 WHEN 0 THEN 'ipps' WHEN 1 THEN 'opps' END AS schedule FROM cell),
  ben AS (SELECT 'ipps' AS schedule, p_brand || '-' || p_size AS code, CAST(NULL AS DOUBLE) AS amount, arg_max(p_size, p_partkey) / CAST(10 AS DOUBLE) AS weight FROM part WHERE p_size % 3 > 0 GROUP BY code UNION ALL SELECT 'opps', p_brand || '-' || p_size AS code, arg_max(CAST(p_size AS DOUBLE) * 20, p_partkey), NULL FROM part WHERE p_size % 4 > 0 GROUP BY code)"""), "benchmark_amount percent_of_benchmark")
def benchmark_percent(spark, sf_dir):
    schedule = F.when(F.length("code") % 3 == 0, "ipps").when(F.length("code") % 3 == 1, "opps")
    part = A.table(spark, sf_dir, "part").withColumn("code", F.concat_ws("-", "p_brand", "p_size"))
    none = F.lit(None).cast("double")
    ipps = part.where("p_size % 3 > 0").select(F.lit("ipps").alias("schedule"), "code", F.lit(2026).alias("year"), none.alias("amount"), (F.col("p_size") / F.lit(10.0)).alias("weight"), "p_partkey")
    opps = part.where("p_size % 4 > 0").select(F.lit("opps").alias("schedule"), "code", F.lit(2026).alias("year"), (F.col("p_size") * F.lit(20.0)).alias("amount"), none.alias("weight"), "p_partkey")
    wages = A.table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("facility"), F.when(F.col("n_nationkey") % 7 > 0, F.lit(0.9) + F.lit(0.01) * F.col("n_nationkey")).alias("wage_index"), F.lit(6000.0).alias("base"))
    rows = _cells(spark, sf_dir).withColumns({"schedule": schedule, "rate_kind": F.lit("dollar")})
    return payment.percent_of_benchmark(rows, ipps.unionByName(opps), wages, 2026, labor=0.677, other=0.323, last="p_partkey").select("facility", "code", "failure", "benchmark_amount", "percent_of_benchmark")


@register("SELECT quality AS actual, CAST(toxic AS INT) AS predicted, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return market.confusion(A.table(spark, sf_dir, "labels"), "quality", "toxic")


@register("""SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM (
  SELECT count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality <> 0 AND toxic = 1) AS fp, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS fn, count(*) FILTER (WHERE quality <> 0 AND toxic = 0) AS tn, count(toxic) / count(*) AS coverage FROM labels)""", "coverage precision recall f1")
def matcher_scores(spark, sf_dir):
    return market.scores(A.table(spark, sf_dir, "labels").select((F.col("quality") == 0).alias("bad"), (F.col("toxic") == 1).alias("said")), "bad", "said")


# sets

@register(with_("SELECT DISTINCT l.system, l.code, l.carrier FROM lft l SEMI JOIN rgt r ON l.system = r.system AND l.code = r.code AND l.carrier = r.carrier"))
def semi_join(spark, sf_dir):
    keys = ["system", "code", "carrier"]
    return A.left(spark, sf_dir).select(*keys).distinct().join(A.right(spark, sf_dir), keys, "left_semi")


@register(with_("SELECT DISTINCT l.system, l.code, l.carrier FROM lft l ANTI JOIN rgt r ON l.system = r.system AND l.code = r.code AND l.carrier = r.carrier"))
def anti_join(spark, sf_dir):
    keys = ["system", "code", "carrier"]
    return A.left(spark, sf_dir).select(*keys).distinct().join(A.right(spark, sf_dir), keys, "left_anti")


@register(with_("SELECT code, carrier FROM rates WHERE side = 0 EXCEPT ALL SELECT code, carrier FROM rates WHERE side = 1"))
def except_all(spark, sf_dir):
    r = A.rates(spark, sf_dir)
    return r.where("side = 0").select("code", "carrier").exceptAll(r.where("side = 1").select("code", "carrier"))
