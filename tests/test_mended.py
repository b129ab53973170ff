"""Cases in which rows or rules were lost: entities, exemplars by system, benchmark payments, outcomes of changed files, names classified once."""

import html

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.operators import evals, gold, payment
from ratesmith.plans import analogue
from ratesmith.sources import lake


def test_references_are_decoded_as_by_the_standard_library(spark):
    given = ["Blue Cross&#8217;s", "a &amp; b", "&lt;x&gt;", "&eacute;t&eacute", "&copy2026", "&#x41;&#X42;&#67;", "&#146;", "&#0;", "&#xD800;", "&#99999999999;", "&nosuch;", "a & b", "&", "", "&amp;lt;", "&notin;", "&notit;", "&#128512;", "&ampamp;", "x&#;y", "&#x;", "&nbsp;|", "AT&T", "&hellip;&hellip;", "&#129;", "&Aacute;&aacute"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, c string").orderBy("i").select(X.decoded(F.col("c")).alias("v")).collect()
    assert [r.v for r in rows] == [html.unescape(x) for x in given]
    assert spark.createDataFrame([("Blue Cross&#8217;s [12]_PPO",), (None,)], "c string").select(X.normalise_name(F.col("c")).alias("v")).collect()[0].v == "Blue Cross’s PPO"


def _residual(spark, rows):
    plain = {"outcome": "compared", "is_material": True, "explanation": "unexplained", "code": "1", "code_type": "CPT", "facility": "f", "plan": None, "setting": "", "billing_class": "", "vintage": "", "rate": 1.0, "payer_median": 2.0}
    kinds = "outcome string, is_material boolean, explanation string, code string, code_type string, facility string, plan string, setting string, billing_class string, vintage string, rate double, payer_median double, system string, carrier string, relative_difference double"
    return spark.createDataFrame([tuple({**plain, **r}[k.split()[0]] for k in kinds.split(", ")) for r in rows], kinds)


def test_each_system_has_its_own_exemplars(spark):
    rows = [{"system": s, "carrier": "c", "code": str(i), "relative_difference": d + i, "payer_median": 2.0 + d} for s, d in (("narrow", 0.1), ("wide", 100.0)) for i in range(30)]
    got = gold.exemplars(_residual(spark, rows)).groupBy("system").count().collect()
    assert {r.system: r["count"] for r in got} == {"narrow": 25, "wide": 25}
    assert {r.system: r["count"] for r in gold.residual_top(_residual(spark, rows), 10).groupBy("system").count().collect()} == {"narrow": 10, "wide": 10}


@pytest.mark.parametrize(("change", "amount", "failure"), [
    ({}, 200.0, None), ({"facility": "rich"}, 200 * (0.6 * 1.3 + 0.4), None), ({"schedule": "ipps", "code": "470"}, 2.0 * 6500, None), ({"schedule": "ipps", "code": "0470", "facility": "rich"}, 2.0 * 6500 * (0.677 * 1.3 + 0.323), None),
    ({"rate": None}, None, "not_dollar_denominated"), ({"rate_kind": "percentage"}, None, "not_dollar_denominated"), ({"code": None}, None, "no_benchmark_for_code"), ({"code": None, "schedule": None}, None, "no_benchmark_for_code"),
    ({"schedule": None}, None, "unsupported_code_type"), ({"code": "00000"}, None, "no_benchmark_for_code"), ({"code": "99999"}, 0.0, "zero_benchmark"), ({"schedule": "ipps", "code": "470", "facility": "nowhere"}, None, "no_geography_for_hospital"),
    ({"schedule": "ipps", "code": "470", "facility": "unknown"}, None, "no_wage_index_for_area"), ({"facility": "unknown"}, 200.0, None), ({"code": "ab1"}, 40.0, None),
])
def test_benchmark_payments(spark, change, amount, failure):
    base = {"facility": "city", "schedule": "opps", "code": "99213", "rate": 300.0, "rate_kind": "dollar"}
    rates = spark.createDataFrame([tuple((base | change).values())], "facility string, schedule string, code string, rate double, rate_kind string")
    benchmarks = spark.createDataFrame(
        [("opps", "99213", 2026, 999.0, None, 0), ("opps", "099213", 2026, 200.0, None, 1), ("opps", "99213", 2024, 1.0, None, 2), ("ipps", "470", 2026, None, 2.0, 0), ("opps", "99999", 2026, 0.0, None, 0), ("opps", "AB1", 2026, 40.0, None, 0)],
        "schedule string, code string, year int, amount double, weight double, ord int",
    )
    wages = spark.createDataFrame([("city", 1.0, 6500.0), ("rich", 1.3, 6500.0), ("unknown", None, 6500.0)], "facility string, wage_index double, base double")
    (got,) = payment.percent_of_benchmark(rates, benchmarks, wages, 2026, labor=0.677, other=0.323, last="ord").collect()
    assert got.failure == failure
    assert amount is None or got.benchmark_amount == pytest.approx(amount)
    assert (got.percent_of_benchmark is None) == (failure is not None) and (failure or got.percent_of_benchmark == pytest.approx(300 / amount))


def test_outcomes_follow_the_files(spark, tmp_path):
    names = ("lineitem", "orders", "customer", "part", "supplier", "nation")
    for name in names:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    first = analogue.explained(spark, str(tmp_path)).count()
    assert analogue.explained(spark, str(tmp_path)).inputFiles() == analogue.explained(spark, str(tmp_path)).inputFiles()
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_orderkey % 3 = 0").write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert 0 < analogue.explained(spark, str(tmp_path)).count() < first
    assert [x for x, _, _ in lake.file_states(spark, [str(tmp_path)])] == sorted(x for x, _, _ in lake.file_states(spark, [str(tmp_path)]))


def test_profile_counts_every_row(spark):
    rows = [("Aetna&#8217;s", "PPO", "Fee Schedule", "1", None, None)] * 3 + [("Aetna", None, None, None, "x", None), (" ", None, None, "1", None, None), (None, "HMO", "", None, None, "50")]
    df = spark.createDataFrame(rows, "payer_name string, plan_name string, methodology string, rate_dollar string, rate_algorithm string, rate_percentage string")
    got = {(r.counter, r.value): r.lines for r in evals.profile(df).collect()}
    assert got["pairs", "Aetna&#8217;s || PPO"] == 3 and got["value_kind", "dollar"] == 3 and got["value_kind", "percentage"] == 1 and got["methodology", "(blank)"] == 2
    assert sum(n for (c, _), n in got.items() if c == "product_class") == 5
