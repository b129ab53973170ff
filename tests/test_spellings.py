"""What the comparison works out for spellings, plans and networks, and not for each row."""

from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.operators import aggregate, compare
from ratesmith.sources import lake

from test_compare import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().lower()


def test_texts_are_folded_for_spellings_only(spark, monkeypatch):
    plans, write, fields = {}, lake.working_table, "spark.sql.debug.maxToStringFields"
    spark.conf.set(fields, 1000)
    monkeypatch.setattr(lake, "working_table", lambda df, name: (plans.__setitem__(name, _plan(df)), write(df, name))[1])
    left = rows(spark, *({"facility": f"{i}", "carrier": c, "setting": s} for i, (c, s) in enumerate([("UHC", "outpatient"), (" uhc", "OUTPATIENT"), ("Uhc ", " outpatient"), ("UHC", "inpatient")])))
    got = {r.facility: (r.outcome, r.n, r.carrier) for r in compare.distribution_join(left, rows(spark, {}, {"carrier": "uHC", "plan": "x"}).drop("facility")).collect()}
    spark.conf.unset(fields)
    assert got == {"0": ("compared", 2, "UHC"), "1": ("compared", 2, " uhc"), "2": ("compared", 2, "Uhc "), "3": ("no payer-side counterpart", 0, "UHC")}
    assert not any("trim(" in plans[name] for name in ("asking", "asked"))
    assert {"asking", "asked", "kinds", "payer_kinds"} <= set(plans)


def test_plans_and_networks_are_judged_once(spark):
    plans = [None, "", "HMO", "PPO gold", "HMO/POS", "Open Access", "other"]
    left = rows(spark, *({"facility": f"{i}", "plan": p, "rate": 900.0} for i, p in enumerate(plans)))
    for networks in (["HMO"], ["EPO", "PPO x"], [None], ["OAP", None], ["HMO", "PPO", "zzz"]):
        right = rows(spark, *({"plan": p, "rate": 400.0 + 200 * i} for i, p in enumerate(networks))).drop("facility")
        out = compare.explain(compare.distribution_join(left, right))
        assert "transform(" not in _plan(out) and "split(" not in _plan(out)
        many, stated = F.size("networks") > 1, X.folded(F.col("plan")) != ""
        verdicts = F.transform("networks", lambda x: X.plan_verdict(F.col("plan"), x))
        each = F.when(F.array_contains(verdicts, "match"), "match").when(F.array_contains(verdicts, "aggregate"), "aggregate").otherwise("no_match")
        one = F.when(~many & X.differs(F.col("plan"), F.col("payer_plan")), X.plan_verdict(F.col("plan"), F.col("payer_plan"))).otherwise("match")
        want = F.when(many & stated, each).otherwise(one)
        account = F.when(want == "aggregate", "granularity_mismatch").when(want != "match", "plan_unresolved").otherwise("unexplained")
        label = F.when(many, F.array_join("networks", " + ")).otherwise(F.coalesce("payer_plan", F.lit("")))
        got = out.select("explanation", account.alias("account"), "payer_label", label.alias("label")).collect()
        assert len(got) == len(plans) and all(r.explanation == r.account and r.payer_label == r.label for r in got)


def test_distinct_medians_shuffle_once(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 4.0), ("a", None), ("b", None), (None, 3.0), (None, 1.0), (None, 1.0), ("n", float("nan")), ("n", 2.0), ("n", 3.0)], "k string, rate double")
    medians = aggregate.distinct_then_median(df, ["k", "rate"], ["k"])
    assert _plan(medians).count("exchange") == 1
    assert {(r.k, r.rate, r.n) for r in medians.collect()} == {("a", 2.5, 2), ("b", None, 0), (None, 2.0, 2), ("n", 3.0, 3)}
