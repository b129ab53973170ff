"""Rate rows made of the order tables, so that the operators run on any star schema of that shape."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.operators import aggregate, compare
from ratesmith.sources import lake

_EXPRESSIONS = {
    "side": "CAST(l_orderkey % 2 AS INT)",
    "system": "n_regionkey",
    "facility": "s_nationkey",
    "code": "concat(p_brand, '-', CAST(p_size AS STRING))",
    "code_type": "CASE p_size % 3 WHEN 0 THEN 'CPT' WHEN 1 THEN 'HCPCS' ELSE 'MS-DRG' END",
    "carrier": "c_mktsegment",
    "plan": "CASE WHEN c_mktsegment = 'BUILDING' OR o_orderpriority = '1-URGENT' THEN 'HMO' WHEN o_orderpriority = '2-HIGH' THEN 'ChoicePPO' WHEN o_orderpriority = '3-MEDIUM' THEN 'EPO/POS' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Commercial' END",
    "setting": "CASE WHEN l_linestatus = 'F' THEN 'inpatient' WHEN l_linenumber % 3 = 0 THEN 'both' ELSE 'outpatient' END",
    "billing_class": "CASE l_returnflag WHEN 'N' THEN 'professional' WHEN 'R' THEN 'facility' END",
    "product_class": "CASE WHEN l_orderkey % 2 = 1 THEN 'commercial' WHEN p_size % 10 = 0 THEN 'medicare_advantage' WHEN p_size % 10 = 5 THEN 'commercial_aggregate' ELSE 'commercial' END",
    # one carrier's contracts have one offset from the hospital side, whatever the code
    "rate": "CASE WHEN c_mktsegment = 'BUILDING' THEN (CAST(100 AS DOUBLE) + p_size) * CASE l_orderkey % 2 WHEN 1 THEN CAST(1.25 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END ELSE l_extendedprice / l_quantity END",
    "rate_kind": "CASE WHEN l_orderkey % 2 = 1 AND l_linenumber = 7 THEN 'percentage' ELSE 'dollar' END",
    "methodology": "CASE WHEN l_orderkey % 2 = 0 AND p_size % 7 = 0 THEN 'per_diem' ELSE 'unknown' END",
    "vintage": "CAST(l_shipdate AS DATE)",
}
LEFT_KEYS = [c for c in compare.LEFT if c != "rate"]
RIGHT_KEYS = [c for c in compare.RIGHT if c != "rate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    rows = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(*(F.expr(e).alias(c) for c, e in _EXPRESSIONS.items()))


def left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.median_by_key(rates(spark, sf_dir).where("side = 0"), LEFT_KEYS).select(*compare.LEFT)


def right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.distinct_then_median(rates(spark, sf_dir).where("side = 1"), compare.RIGHT, RIGHT_KEYS).select(*compare.RIGHT)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of every left rate with the accounts of the compared ones, contracts' offsets applied."""
    return compare.with_offsets(compare.explain(compare.distribution_join(left(spark, sf_dir), right(spark, sf_dir))), written=True)


_written: dict[tuple, DataFrame] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, lengths and times of the files that outcomes() reads."""
    return tuple(lake.file_states(spark, [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer", "part", "supplier", "nation")]))


def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """outcomes(), from working tables that a session writes once for each state of the tables' files: all published tables read it."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _written:
        _written[key] = outcomes(spark, sf_dir)
    return _written[key]


@lru_cache
def base_sql() -> str:
    """CTEs rates, lft and rgt."""
    lk, rk = ", ".join(LEFT_KEYS), ", ".join(RIGHT_KEYS)
    columns = ", ".join(f"{e} AS {c}" for c, e in _EXPRESSIONS.items())
    return f"""rates AS (
  SELECT {columns} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), lft AS (
  SELECT {lk}, median(rate) AS rate, CASE setting WHEN 'both' THEN '' ELSE setting END AS sk, row_number() OVER () AS id FROM rates WHERE side = 0 GROUP BY {lk}
), rgt AS (
  SELECT {rk}, median(rate) AS rate, CASE setting WHEN 'both' THEN '' ELSE setting END AS sk FROM (SELECT DISTINCT {rk}, rate FROM rates WHERE side = 1) GROUP BY {rk}
)"""


_TOKENS = "CASE {} WHEN 'HMO' THEN 'hmo' WHEN 'ChoicePPO' THEN 'ppo' WHEN 'EPO/POS' THEN 'epo,pos' ELSE '' END"


def _verdict_sql(plan: str, network: str) -> str:
    a, b = _TOKENS.format(plan), _TOKENS.format(network)
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 'unknown' WHEN {a} = 'epo,pos' THEN 'aggregate' WHEN {a} = {b} THEN 'match' ELSE 'no_match' END"


@lru_cache
def pairs_sql() -> str:
    """CTE p: pairs with reason and whether they are of one class."""
    return f"""p AS (
  SELECT l.id, l.rate AS l_rate, r.rate AS r_rate, r.plan AS r_plan, r.vintage AS r_vintage, coalesce(l.billing_class = r.billing_class, FALSE) AS alike,
    {_verdict_sql("l.plan", "r.plan")} AS pv, l.system, l.facility, l.code, l.carrier, l.billing_class AS l_class, r.billing_class AS r_class,
    CASE WHEN l.rate_kind <> r.rate_kind THEN 'mixed_rate_kind' WHEN l.rate_kind <> 'dollar' THEN 'not_dollar_denominated' WHEN l.rate <= 0 OR r.rate <= 0 THEN 'zero_rate'
      WHEN l.methodology = 'per_diem' THEN 'incompatible_methodology' WHEN abs(date_diff('day', l.vintage, r.vintage)) > 400 THEN 'vintage_too_far_apart' END AS reason,
    l.product_class
  FROM lft l JOIN rgt r ON l.system = r.system AND l.code = r.code AND l.carrier = r.carrier AND r.sk IN (l.sk, '')
)"""


@lru_cache
def explained_sql() -> str:
    """CTEs up to ex: one row a left rate, as `explained`."""
    return f"""{base_sql()}, {pairs_sql()}, q AS (
  SELECT * FROM p WHERE product_class <> 'medicare_advantage'
), ok AS (
  SELECT *, median(r_rate) OVER (PARTITION BY id) AS med FROM q WHERE alike AND reason IS NULL
), rep AS (
  SELECT id, r_plan AS payer_plan, r_vintage AS payer_vintage FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(r_rate - med), coalesce(r_plan, ''), r_rate, r_vintage) AS i FROM ok) WHERE i = 1
), sp AS (
  SELECT id, count(*) AS n, min(r_rate) AS payer_min, max(med) AS payer_median, max(r_rate) AS payer_max, count(DISTINCT r_plan) AS n_networks,
    string_agg(DISTINCT r_plan, ' + ' ORDER BY r_plan) AS label, bool_or(pv = 'match' AND r_plan IS NOT NULL) AS any_match, bool_or(pv = 'aggregate' AND r_plan IS NOT NULL) AS any_aggregate
  FROM ok GROUP BY id
), cnt AS (
  SELECT id, count(*) AS n_any, count(*) FILTER (WHERE alike) AS n_like FROM q GROUP BY id
), maj AS (
  SELECT id, reason FROM (
    SELECT id, reason, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, list_position(['mixed_rate_kind', 'not_dollar_denominated', 'missing_rate', 'zero_rate', 'incompatible_methodology', 'vintage_too_far_apart'], reason)) AS i
    FROM q WHERE alike AND reason IS NOT NULL GROUP BY id, reason) WHERE i = 1
), oc AS (
  SELECT l.*, CASE WHEN l.product_class = 'medicare_advantage' THEN 'tic_exempt_product' WHEN c.n_any IS NULL THEN 'no payer-side counterpart' WHEN l.billing_class IS NULL THEN 'billing_class_unstated'
      WHEN c.n_like = 0 THEN 'different_billing_class' WHEN s.n IS NULL THEN m.reason ELSE 'compared' END AS outcome,
    coalesce(s.n, 0) AS n, s.payer_min, s.payer_median, s.payer_max, coalesce(s.n_networks, 0) AS n_networks, s.label, s.any_match, s.any_aggregate, r.payer_plan, r.payer_vintage
  FROM lft l LEFT JOIN cnt c USING (id) LEFT JOIN sp s USING (id) LEFT JOIN maj m USING (id) LEFT JOIN rep r USING (id)
), dx AS (
  SELECT *, CASE WHEN rate <> 0 THEN payer_median / rate ELSE 0.0 END AS ratio, abs(payer_median - rate) / least(rate, payer_median) AS relative_difference,
    coalesce(rate BETWEEN payer_min AND payer_max, FALSE) AS inside, abs(date_diff('day', vintage, payer_vintage)) AS days,
    CASE WHEN n_networks > 1 THEN label ELSE coalesce(payer_plan, '') END AS payer_label FROM oc
), ex0 AS (
  SELECT *, relative_difference >= CAST(0.05 AS DOUBLE) AS is_material, greatest(rate, payer_median) / least(rate, payer_median) >= 10 AS is_implausible,
    CASE WHEN outcome <> 'compared' THEN NULL WHEN greatest(rate, payer_median) / least(rate, payer_median) >= 10 THEN 'entity_resolution_suspect'
      WHEN product_class = 'commercial_aggregate' THEN 'granularity_mismatch' WHEN n >= 2 AND payer_max > payer_min AND inside THEN 'within_payer_range'
      WHEN days <> 0 AND relative_difference / (days / CAST(365 AS DOUBLE)) <= CAST(0.40 AS DOUBLE) THEN 'vintage_artifact'
      WHEN n_networks > 1 AND plan IS NOT NULL THEN CASE WHEN any_match THEN 'unexplained' WHEN any_aggregate THEN 'granularity_mismatch' ELSE 'plan_unresolved' END
      WHEN n_networks <= 1 AND plan <> payer_plan THEN CASE {_verdict_sql("plan", "payer_plan")} WHEN 'match' THEN 'unexplained' WHEN 'aggregate' THEN 'granularity_mismatch' ELSE 'plan_unresolved' END
      ELSE 'unexplained' END AS explanation_before
  FROM dx
), oc0 AS (
  SELECT facility, carrier, plan, payer_label, code, ratio, count(*) OVER w AS m, median(ratio) OVER w AS centre FROM ex0 WHERE outcome = 'compared' AND ratio > 0 WINDOW w AS (PARTITION BY facility, carrier, plan, payer_label)
), oc1 AS (
  SELECT facility, carrier, plan, payer_label, median(ratio) FILTER (WHERE abs(ratio - centre) / centre <= CAST(0.03 AS DOUBLE)) AS off FROM oc0 GROUP BY ALL
  HAVING max(m) >= 20 AND count(DISTINCT code) FILTER (WHERE abs(ratio - centre) / centre <= CAST(0.03 AS DOUBLE)) >= 20 AND count(*) FILTER (WHERE abs(ratio - centre) / centre <= CAST(0.03 AS DOUBLE)) / max(m) >= CAST(0.8 AS DOUBLE)
), ex AS (
  SELECT e.*, o.off AS contract_offset, CASE WHEN e.explanation_before = 'unexplained' AND coalesce(abs(e.ratio - o.off) / o.off <= CAST(0.03 AS DOUBLE), FALSE) THEN 'systematic_offset' ELSE e.explanation_before END AS explanation
  FROM ex0 e LEFT JOIN oc1 o ON e.outcome = 'compared' AND e.facility = o.facility AND e.carrier = o.carrier AND e.plan IS NOT DISTINCT FROM o.plan AND e.payer_label IS NOT DISTINCT FROM o.payer_label
), res AS (
  SELECT *, payer_median - rate AS difference FROM ex WHERE outcome = 'compared' AND is_material AND explanation = 'unexplained'
)"""
