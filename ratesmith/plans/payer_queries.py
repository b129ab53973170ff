"""Queries of the insurer side, over order lines that stand for its rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratesmith.operators import payer
from ratesmith.rules import tables as T

from . import analogue as A
from .register import register, with_

_PAYER = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "systems": "CASE l_linenumber % 4 WHEN 0 THEN 'Alpha' WHEN 1 THEN 'Alpha, Beta' WHEN 2 THEN 'Beta Health' ELSE '' END",
    "system_count": "CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END",
    "billing_code": "CAST(l_partkey AS STRING)",
    "code_type": "CASE l_suppkey % 5 WHEN 0 THEN 'CPT' WHEN 1 THEN 'LOCAL' WHEN 2 THEN 'MS-DRG' WHEN 3 THEN 'CSTM-ALL' END",
    "group_tins": "CAST(l_quantity AS INT)", "negotiated_rate": "l_extendedprice",
    "rate_type": "CASE WHEN l_tax > 0.05 THEN ' Percentage' WHEN l_tax > 0.02 THEN 'negotiated' END",
    "service_codes": "CASE l_linenumber WHEN 1 THEN '21' WHEN 2 THEN '22|23' WHEN 3 THEN '11' WHEN 4 THEN '21 | 22' WHEN 5 THEN 'CSTM-00' WHEN 6 THEN '' END",
    "billing_class": "CASE l_returnflag WHEN 'A' THEN 'Institutional' WHEN 'R' THEN ' professional' ELSE 'both' END",
    "label": "CASE l_linenumber WHEN 1 THEN 'AetnaALIC_OpenAccessManagedChoice' WHEN 2 THEN 'UHC_NY_ChoicePlus' WHEN 3 THEN 'Cigna' WHEN 4 THEN 'EmblemHealth_GHIHOS000001' WHEN 5 THEN 'United-Healthcare_' ELSE 'Local_Plan' END",
}
_SQL = f"pay AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _PAYER.items())} FROM lineitem)"


def _rows(spark, sf_dir):
    return A.table(spark, sf_dir, "lineitem").select(*(F.expr(e).alias(c) for c, e in _PAYER.items()))


_BY = "systems, code_type, count(*) AS n, count(DISTINCT billing_code) AS codes"


def _counted(rows):
    return rows.groupBy("systems", "code_type").agg(F.count("*").alias("n"), F.countDistinct("billing_code").alias("codes"))


@register(with_(f"SELECT {_BY} FROM pay WHERE system_count = 1 AND (code_type IS NULL OR code_type NOT IN ('LOCAL', 'CSTM-ALL')) AND group_tins <= 30 AND negotiated_rate >= 1000 GROUP BY ALL", _SQL))
def payer_filter(spark, sf_dir):
    return _counted(_rows(spark, sf_dir).where(payer.payer_filter(max_group_tins=30, min_rate=1000.0)))


@register(with_(f"SELECT {_BY} FROM pay WHERE (contains(systems, 'Beta') OR contains(systems, 'Gamma')) AND starts_with(billing_code, '1') AND code_type IN ('CPT', 'LOCAL') GROUP BY ALL", _SQL))
def payer_filter_systems(spark, sf_dir):
    return _counted(_rows(spark, sf_dir).where(payer.payer_filter(["Beta", "Gamma"], code_prefix="1", code_types=["CPT", "LOCAL"], untranslatable=True, exclusive=False)))


@register(with_("SELECT facility, product_class, count(*) AS n, CAST(round(sum(CAST(rate AS DECIMAL(28, 9))), 4) AS DECIMAL(28, 4)) AS total FROM rates WHERE rate_kind = 'dollar' AND rate > 0 AND facility IN (1, 2, 3) AND product_class IN ('commercial') AND code_type IN ('CPT', 'HCPCS') AND starts_with(code, 'Brand#1') GROUP BY ALL"))
def rate_filter(spark, sf_dir):
    kept = A.rates(spark, sf_dir).where(payer.rate_filter([1, 2, 3], products=["commercial"], code_types=["CPT", "HCPCS"], prefix="Brand#1"))
    return kept.groupBy("facility", "product_class").agg(F.count("*").alias("n"), F.round(F.sum(F.col("rate").cast("decimal(28,9)")), 4).cast("decimal(28,4)").alias("total"))


@register("""WITH c AS (SELECT p_partkey, [{'code': CAST(p_size AS VARCHAR), 'type': CASE p_partkey % 3 WHEN 0 THEN 'RC' WHEN 1 THEN 'rev' ELSE 'XX' END}, {'code': lower(p_brand), 'type': CASE WHEN p_partkey % 2 = 0 THEN 'CPT' END}] AS codes FROM part), k AS (
  SELECT DISTINCT p_partkey FROM (SELECT p_partkey, unnest(codes) AS x FROM c) WHERE (upper(x.type) IN ('RC', 'REV') AND lpad(x.code, 4, '0') IN ('0007', '0012', '0041')) OR (x.type = 'CPT' AND upper(x.code) IN ('BRAND#3', 'BRAND#14')))
SELECT p_partkey FROM k""")
def code_set_membership(spark, sf_dir):
    kinds = F.when(F.col("p_partkey") % 3 == 0, "RC").when(F.col("p_partkey") % 3 == 1, "rev").otherwise("XX"), F.when(F.col("p_partkey") % 2 == 0, "CPT")
    rows = A.table(spark, sf_dir, "part").select("p_partkey", F.array(F.struct(F.col("p_size").cast("string").alias("code"), kinds[0].alias("type")), F.struct(F.lower("p_brand").alias("code"), kinds[1].alias("type"))).alias("codes"))
    scope = spark.createDataFrame([("revenue", "0007"), ("revenue", "0012"), ("revenue", "0041"), ("procedure", "BRAND#3"), ("procedure", "BRAND#14")], "family string, code string")
    return payer.code_scope(rows, "codes", scope).select("p_partkey")


@register("""WITH s AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'revenue' ELSE 'procedure' END AS family, p_brand AS code FROM part), f AS (SELECT family, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM s GROUP BY family)
SELECT substr(sha256((SELECT string_agg(DISTINCT code, ',' ORDER BY code) FROM s) || '|' || (SELECT string_agg(family || '=' || codes, ';' ORDER BY family) FROM f)), 1, 16) AS fingerprint""")
def code_set_fingerprint(spark, sf_dir):
    family = F.when(F.col("p_size") % 2 == 0, "revenue").otherwise("procedure")
    return payer.fingerprint(A.table(spark, sf_dir, "part").select(family.alias("family"), F.col("p_brand").alias("code")).distinct())


@register(with_("SELECT trim(system) AS system, billing_code, negotiated_rate FROM (SELECT unnest(string_split(systems, ',')) AS system, billing_code, negotiated_rate FROM pay) WHERE trim(system) <> ''", _SQL))
def systems_exploded(spark, sf_dir):
    return payer.by_system(_rows(spark, sf_dir), exclusive=False).select("system", "billing_code", "negotiated_rate")


@register(with_("SELECT trim(system) AS system, count(*) AS rows FROM (SELECT unnest(string_split(systems, ',')) AS system FROM pay) WHERE trim(system) <> '' GROUP BY 1", _SQL))
def distinct_systems(spark, sf_dir):
    return payer.distinct_systems(_rows(spark, sf_dir))


@register(with_("""SELECT systems AS system, CASE l_linenumber WHEN 1 THEN 'Aetna' WHEN 2 THEN 'UnitedHealthcare' WHEN 3 THEN 'Cigna' WHEN 4 THEN 'EmblemHealth' WHEN 5 THEN 'UnitedHealthcare' ELSE 'Local' END AS carrier,
  CASE l_linenumber WHEN 1 THEN 'OpenAccessManagedChoice' WHEN 2 THEN 'ChoicePlus' WHEN 3 THEN 'Cigna' WHEN 4 THEN 'GHIHOS000001' WHEN 5 THEN 'United-Healthcare' ELSE 'Plan' END AS plan,
  CASE l_linenumber WHEN 1 THEN 'inpatient' WHEN 2 THEN 'outpatient' WHEN 3 THEN NULL ELSE 'both' END AS setting, CASE billing_class WHEN 'Institutional' THEN 'facility' WHEN ' professional' THEN 'professional' END AS billing_class,
  CASE WHEN rate_type = ' Percentage' THEN 'percentage' ELSE 'dollar' END AS rate_kind, count(*) AS n FROM pay WHERE system_count = 1 GROUP BY ALL""", _SQL))
def payer_rates(spark, sf_dir):
    keys = ["system", "carrier", "plan", "setting", "billing_class", "rate_kind"]
    return payer.payer_rates(_rows(spark, sf_dir)).groupBy(*keys).agg(F.count("*").alias("n"))


@register("SELECT l_returnflag AS payer, min(l_shipdate) AS vintage FROM lineitem GROUP BY 1")
def first_vintages(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("payer"), F.col("l_shipdate").alias("vintage"))
    return payer.first_vintages(rows, "payer", "vintage")
