"""The comparison's cases on hand-built rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.operators import aggregate, compare, triage

SCHEMA = "system int, facility string, code string, code_type string, carrier string, plan string, setting string, billing_class string, product_class string, rate double, rate_kind string, methodology string, vintage date"
BASE = {"system": 1, "facility": "F", "code": "70450", "code_type": "CPT", "carrier": "UHC", "plan": "PPO", "setting": "outpatient", "billing_class": "facility", "product_class": "commercial", "rate": 500.0, "rate_kind": "dollar", "methodology": "unknown", "vintage": dt.date(2026, 4, 1)}


def rows(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}[k] for k in BASE) for c in changes], SCHEMA)


def one(spark, left, *right, **more):
    got = compare.explain(compare.distribution_join(rows(spark, left), rows(spark, *right).drop("facility"), **more)).collect()
    assert len(got) == 1
    return got[0]


def test_fan_out_is_one_outcome(spark):
    r = one(spark, {}, *({"rate": 400.0 + i, "plan": f"n{i}"} for i in range(290)))
    assert (r.outcome, r.n, r.payer_min, r.payer_median, r.payer_max, len(r.networks)) == ("compared", 290, 400.0, 544.5, 689.0, 290)
    assert r.explanation == "within_payer_range"


@pytest.mark.parametrize(("left", "right", "outcome"), [
    ({}, [{"code": "1"}], "no payer-side counterpart"),
    ({}, [{"billing_class": "professional"}], "different_billing_class"),
    ({"billing_class": None}, [{}], "billing_class_unstated"),
    ({"product_class": "medicare_advantage"}, [{}], "tic_exempt_product"),
    ({"setting": "outpatient"}, [{"setting": "both"}], "compared"),
    ({"setting": ""}, [{"setting": "outpatient"}], "no payer-side counterpart"),
    ({}, [{"rate": 0.0}, {"rate": 0.0, "plan": "x"}, {"rate_kind": "percentage"}], "zero_rate"),
    ({}, [{"rate": 0.0}, {"rate_kind": "percentage"}], "mixed_rate_kind"),
    ({}, [{"vintage": dt.date(2024, 1, 1)}], "vintage_too_far_apart"),
    ({}, [{"methodology": "per_diem"}], "incompatible_methodology"),
    ({"carrier": " uhc "}, [{}], "compared"),
    ({"code": "064"}, [{"code": "64"}], "no payer-side counterpart"),
])
def test_outcomes(spark, left, right, outcome):
    assert one(spark, left, *right).outcome == outcome


@pytest.mark.parametrize(("left", "right", "explanation"), [
    ({"rate": 100.0}, [{"rate": 1000.0}], "entity_resolution_suspect"),
    ({"rate": 100.0}, [{"rate": 110.0, "vintage": dt.date(2026, 10, 18)}], "vintage_artifact"),
    ({}, [{"rate": 500.0}], "unexplained"),
    ({"rate": 500.0}, [{"rate": 400.0}, {"rate": 600.0}], "within_payer_range"),
    ({"rate": 900.0}, [{"rate": 400.0, "plan": "HMO"}, {"rate": 600.0, "plan": "EPO"}], "plan_unresolved"),
    ({"rate": 900.0, "plan": "HMO/POS"}, [{"rate": 400.0}], "granularity_mismatch"),
    ({"rate": 900.0, "plan": None}, [{"rate": 400.0}], "unexplained"),
    ({"rate": 900.0, "product_class": "commercial_aggregate"}, [{"rate": 400.0}], "granularity_mismatch"),
])
def test_explanations(spark, left, right, explanation):
    assert one(spark, left, *right).explanation == explanation


def test_assumed_facility(spark):
    assert one(spark, {"billing_class": None}, {}, assumed=F.col("system") == 1).outcome == "compared"


def test_offset_keeps_null_plans_and_stragglers(spark):
    data = [("F", "C", None, None, f"{i % 9 + 1}{i}", 1.4, "unexplained") for i in range(30)] + [("F", "C", None, None, "x", 2.0, "unexplained")]
    df = spark.createDataFrame(data, "facility string, carrier string, plan string, payer_label string, code string, ratio double, explanation string")
    offsets = compare.systematic_offsets(df)
    assert [(r.codes, r.rows, r.offset) for r in offsets.collect()] == [(30, 30, 1.4)]
    got = compare.reclassify(df, offsets)
    assert sorted((r.explanation, r["count"]) for r in got.groupBy("explanation").count().collect()) == [("systematic_offset", 30), ("unexplained", 1)]


def test_near_counts_match_all_pairs_and_keep_repeats(spark):
    ratios = [1.0, 1.0, 1.02, 1.03, 1.031, 0.97, 2.0, 0.0, None]
    df = spark.createDataFrame([("a", r) for r in ratios], "k string, ratio double")
    got = sorted((r.ratio or 0, r.near) for r in triage.near_counts(df, ["k"]).collect())
    near = lambda x: sum(x * (1 - 0.03) <= y <= x * (1 + 0.03) for y in ratios if y)
    assert got == sorted((r or 0, near(r) if r else 0) for r in ratios)


def test_medians_and_p90(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(1, 11)] + [(None, 3.0), (None, None)], "k string, rate double")
    assert {r.k: (r.rate, r.n) for r in aggregate.median_by_key(df, ["k"]).collect()} == {"a": (5.5, 10), None: (3.0, 1)}
    assert {r.k: r.p90 for r in aggregate.p90_nearest(df, ["k"], "rate").collect()} == {"a": 9.0, None: 3.0}
    assert {r.k: r.p90 for r in aggregate.p90_floor(df, ["k"], "rate").collect()} == {"a": 10.0, None: 3.0}
    assert aggregate.median_row(df.where("k = 'a'"), ["k"], [F.col("rate")], upper=False).first().rate == 5.0


def test_many_rates_of_one_code_ask_once(spark):
    """A key with 20,000 rates on either side: 400 million pairs, of which no join has to make one for each left row."""
    left = rows(spark, {}).crossJoin(spark.range(20_000)).withColumn("facility", F.concat(F.lit("f"), F.col("id") % 7)).withColumn("rate", F.col("id") + 1.0).drop("id")
    right = rows(spark, {}).drop("facility").crossJoin(spark.range(20_001)).withColumn("rate", F.col("id") + 1.0).drop("id")
    got = compare.distribution_join(left, right).groupBy("outcome", "n", "payer_min", "payer_median", "payer_max").count().collect()
    assert [tuple(r) for r in got] == [("compared", 20_001, 1.0, 10_001.0, 20_001.0, 20_000)]


def test_questions_differ_where_the_answer_does(spark):
    changes = [{}, {"rate": None}, {"rate": 0.0}, {"setting": "both"}, {"setting": "OUTPATIENT "}, {"vintage": None}, {"billing_class": None}, {"rate_kind": "percentage"}, {"plan": "other"}, {"code": " 70450"}, {"methodology": "per_diem"}, {"vintage": dt.date(2024, 1, 1)}]
    left = rows(spark, *({**c, "facility": str(i)} for i, c in enumerate(changes)))
    got = {int(r.facility): (r.outcome, r.n) for r in compare.distribution_join(left, rows(spark, {}, {"setting": "both"}, {"setting": "inpatient"}).drop("facility")).collect()}
    assert got == {
        0: ("compared", 2), 1: ("missing_rate", 0), 2: ("zero_rate", 0), 3: ("compared", 1), 4: ("compared", 2), 5: ("compared", 2), 6: ("billing_class_unstated", 0), 7: ("mixed_rate_kind", 0), 8: ("compared", 2), 9: ("compared", 2),
        10: ("incompatible_methodology", 0), 11: ("vintage_too_far_apart", 0),
    }


def test_days_of_one_code_are_swept(spark):
    """20,000 questions that differ in their day and 20,000 payer rates of one code: pairs would be as many as 400 million."""
    days = lambda n: F.date_add(F.lit("1950-01-01").cast("date"), F.col("id").cast("int") % n)
    left = rows(spark, {}).crossJoin(spark.range(20_000)).withColumn("vintage", days(20_000)).drop("id")
    right = rows(spark, {}).drop("facility").crossJoin(spark.range(20_000)).withColumns({"vintage": days(20_000), "rate": F.col("id") + 1.0, "plan": F.concat(F.lit("p"), F.col("id") % 3)}).drop("id")
    got = compare.distribution_join(left, right).select(F.datediff("vintage", F.lit("1950-01-01")).alias("d"), "n", "payer_min", "payer_median", "payer_max", "networks", F.datediff("payer_vintage", F.lit("1950-01-01")).alias("p")).collect()
    assert len(got) == 20_000
    for r in got:
        low, high = max(0, r.d - 400), min(19_999, r.d + 400)
        mid = (low + high) / 2
        ends = {int(mid)} if mid == int(mid) else {int(mid), int(mid) + 1}
        near = min(ends, key=lambda d: (f"p{d % 3}", d))
        assert (r.n, r.payer_min, r.payer_median, r.payer_max, r.networks, r.p) == (high - low + 1, low + 1.0, mid + 1, high + 1.0, ["p0", "p1", "p2"], near)
    counted = {r.verdict: r.pairs for r in compare.pair_verdicts(left, right, ["system"]).collect()}
    near = sum(r.n for r in got)
    assert counted == {"comparable": near, "vintage_too_far_apart": 400_000_000 - near}


def test_verdicts_are_counted_as_pairs_have_them(spark):
    changes = [{}, {}, {"rate": None}, {"rate": 0.0}, {"setting": "both"}, {"setting": "OUTPATIENT "}, {"vintage": None}, {"billing_class": None}, {"billing_class": "professional"}, {"rate_kind": "percentage"}, {"rate_kind": None}, {"plan": "other"}, {"code": " 70450"}, {"methodology": "per_diem"}, {"methodology": None}, {"vintage": dt.date(2024, 1, 1)}, {"product_class": "medicare_advantage"}, {"code_type": "RC"}, {"code_type": None}, {"carrier": None}, {"system": None}]
    left, right = rows(spark, *changes, {"facility": None}), rows(spark, *changes).drop("facility")
    pairs = compare.pair_join(left, right).groupBy("l_system", "l_facility", F.coalesce("refusal", F.lit("comparable"))).count().collect()
    assert sorted(map(tuple, compare.pair_verdicts(left, right, ["system", "facility"]).collect()), key=str) == sorted(map(tuple, pairs), key=str)
    each = [dict(zip(BASE, r, strict=True)) for r in left.distinct().collect()]
    for i, r in enumerate(each):
        r["facility"] = str(i)
    left = rows(spark, *each)
    n = {r.l_facility: r.n for r in compare.pair_join(left, right).where("refusal IS NULL AND lower(l_billing_class) = lower(r_billing_class)").groupBy("l_facility").agg(F.count("*").alias("n")).collect()}
    assert {r.facility: r.n for r in compare.distribution_join(left, right).collect()} == {r["facility"]: n.get(r["facility"], 0) for r in each}


def test_window_keeps_order_over_blocks(monkeypatch):
    import random

    from ratesmith.operators import sweeps

    monkeypatch.setattr(sweeps, "_BLOCK", 7)
    dice, window, held = random.Random(1), sweeps._Window(), []
    for _ in range(3000):
        if held and dice.random() < 0.47:
            x = held.pop(dice.randrange(len(held)))
            window.remove(x)
        else:
            rate = float(dice.choice([1, 2, 3, dice.random() * 4]))
            x = (rate, dice.choice(["", "a", "b"]), dice.randint(0, 3), True, "", False, rate)
            held.append(x)
            window.add(x)
        held.sort()
        assert [y for block in window.blocks for y in block] == held
        if held:
            median, low, high = sweeps._median(window)
            assert sweeps._nearest(window, median, low, high) == min(held, key=lambda y: (abs(y[0] - median), y[1], y[0], y[2:]))


def test_offsets_read_the_comparison_from_one_table(spark):
    """The comparison stood twice in the plan of the outcomes, and ran twice."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    row = ("f", "c", "p", "l", "x", 1.2, "compared", "unexplained")
    df = spark.createDataFrame([row] * 3, "facility string, carrier string, plan string, payer_label string, code string, ratio double, outcome string, explanation string")
    counted = F.udf(count, "string").asNondeterministic()
    got = compare.with_offsets(df.withColumn("code", counted("code"))).collect()
    assert len(got) == 3 and seen.value == 3


def test_medians_sort_and_trimming_needs_no_regular_expression(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), ("b", None), (None, 3.0), (None, 1.0), (None, 2.0)], "k string, rate double")
    medians = aggregate.median_by_key(df, ["k"])
    assert {(r.k, r.rate, r.n) for r in medians.collect()} == {("a", 2.5, 2), ("b", None, 0), (None, 2.0, 3)}
    assert "ObjectHashAggregate" not in plan(medians)
    spaces = [chr(c) for c in range(0x3001) if re.fullmatch(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", chr(c))]
    texts = [s + "a" + s + "b" + s * 2 for s in [*spaces, "", "\u200b", "\x1c"]] + spaces + [" ".join(spaces), "", "x\r\n", "\n\u3000é ü\u3000\n"]
    both = spark.createDataFrame([(t,) for t in texts], "t string").select(X.stripped(F.col("t")).alias("a"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("b"))
    assert all(r.a == r.b for r in both.collect())
    assert "regexp" not in plan(df.select(X.folded(F.col("k"))))
