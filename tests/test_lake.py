"""Text, sources, publishing and ingest."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.operators import conform, payment
from ratesmith.sources import files, lake
from ratesmith.streaming.ingest import ingest


def value(spark, column, **row):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).select(column.alias("v")).first().v


@pytest.mark.parametrize(("given", "want"), [("4/1/2026", dt.date(2026, 4, 1)), ("2026-4-1", dt.date(2026, 4, 1)), (" 2026-04 ", dt.date(2026, 4, 1)), ("2026", dt.date(2026, 1, 1)), ("", None), ("soon", None), (None, None)])
def test_dates(spark, given, want):
    assert value(spark, X.parse_date(F.col("x")), x=given) == want


@pytest.mark.parametrize(("plan", "network", "want"), [("Cigna Ppo", "NationalPPO", "match"), ("Hmo/Oap", "NationalPPO", "aggregate"), ("Open Access", "NationalOAP", "match"), ("HMO", "POSChoicePlus", "no_match"), ("Commercial", "PPO", "unknown"), (None, "PPO", "unknown"), ("open access plus", "OAP", "match")])
def test_plans(spark, plan, network, want):
    assert value(spark, X.plan_verdict(F.col("p"), F.col("n")), p=plan, n=network) == want


def test_products_and_names(spark):
    f = lambda a, b: value(spark, X.classify_product(F.col("a"), F.col("b")), a=a, b=b)
    assert [f("Aetna", "MAP_Medicare Advantage_MLTC"), f("Aetna", "Medicare Advantage"), f("Aetna", "aetna"), f("Aetna", "Zzz"), f(None, None), f("Self Pay", "")] == ["dual_or_ltc", "medicare_advantage", "no_plan_detail", "unclassified", "no_plan_detail", "non_payer"]
    assert value(spark, X.normalise_name(F.col("x")), x="HIGHMARK&nbsp;BCBS [5143] / A&amp;B") == "HIGHMARK BCBS A B"
    assert value(spark, X.expand_range(F.col("x")), x="360-362") == ["0360", "0361", "0362"]


def test_json_tall_wide(spark, tmp_path):
    doc = {"hospital_name": "H", "last_updated_on": "2026-04-01", "location_name": ["L"], "standard_charge_information": [{"description": "d", "code_information": [{"code": "70450", "type": "CPT"}], "standard_charges": [{"setting": "outpatient", "payers_information": [{"payer_name": "P", "plan_name": "A", "standard_charge_dollar": 12.5}, {"payer_name": "Q"}]}]}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    got = files.read_price_json(spark, str(tmp_path / "a.json")).collect()
    assert [(r.hospital, r.code, r.payer_name, r.rate_dollar) for r in got] == [("H", "70450", "P", "12.5"), ("H", "70450", "Q", None)]
    head = "hospital_name,last_updated_on\nH,4/1/2026\n"
    (tmp_path / "t.csv").write_text(head + "description,code|1,code|1|type,payer_name,plan_name,standard_charge|negotiated_dollar\nscan,70450,CPT,P,A,10\nscan,,,P,B,11\n")
    got = files.read_price_tall(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.code, r.plan_name, r.rate_dollar, r.file_vintage) for r in got] == [("70450", "A", "10", "4/1/2026"), (None, "B", "11", "4/1/2026")]
    (tmp_path / "w.csv").write_text(head + "description,code|1,code|1|type,standard_charge|P|A|negotiated_dollar,standard_charge|P|B|negotiated_percentage\nscan,70450,CPT,10,\nscan,70451,CPT,,55\n")
    got = files.read_price_wide(spark, str(tmp_path / "w.csv")).collect()
    assert sorted((r.code, r.plan_name, r.rate_dollar, r.rate_percentage) for r in got) == [("70450", "A", "10", None), ("70451", "B", None, "55")]


def test_index_file_blocks(spark, tmp_path):
    (tmp_path / "cms-hpt.txt").write_text("location-name: A\nmrf-url: http://a\n\nlocation-name: B\nmrf-url: http://b\nlocation-name: C\n")
    got = files.read_index_files(spark, str(tmp_path / "cms-hpt.txt")).collect()
    assert sorted((r.fields["location-name"], r.fields.get("mrf-url")) for r in got) == [("A", "http://a"), ("B", "http://b"), ("C", None)]


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.publish(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, ["k"])
    lake.publish(spark.createDataFrame([("a", 3), ("a", 4)], "k string, v int"), path, ["k"], ["v"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 3), ("a", 4), ("b", 2)]
    fresh = spark.createDataFrame([("a", 3)], "k string, v int")
    gone = lake.stale_partitions(spark, path, fresh, ["k"], F.lit(True))
    assert lake.remove_partitions(spark, path, gone, ["k"]) == 1
    assert {r.k for r in spark.read.parquet(path).collect()} == {"a"}
    assert sum(r.rows for r in lake.manifest(spark, path, ["k"]).collect()) == 2
    with pytest.raises(Exception, match="null in partition key"):
        lake.publish(spark.createDataFrame([(None, 1)], "k string, v int"), path, ["k"])


def test_gate():
    assert [lake.gate(None, 0), lake.gate({"ok": True}, 4), lake.gate({"ok": False}, 1), lake.gate({"ok": True}, 1)] == ["missing", "stale", "failed", "passed"]


RAW = "source_url string, payer_name string, plan_name string, code string, code_type string, setting string, billing_class string, rate_dollar string, rate_percentage string, rate_algorithm string, methodology string, file_vintage string"


def raw(spark, *changes):
    base = dict(source_url="u", payer_name="Aetna", plan_name="PPO", code="1", code_type="CPT", setting=None, billing_class=" Facility ", rate_dollar="$1,000.50", rate_percentage=None, rate_algorithm=None, methodology="Per Diem", file_vintage="4/1/2026")
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], RAW)


def test_curate(spark):
    cases = [({}, None), ({"payer_name": None}, "missing_payer"), ({"payer_name": "Self Pay"}, "non_payer_row"), ({"code": ""}, "missing_code"), ({"file_vintage": None}, "missing_vintage"), ({"rate_dollar": None}, "no_rate_value"), ({"rate_dollar": "NaN"}, "non_numeric_rate"), ({"rate_dollar": "-1"}, "negative_rate"), ({"rate_dollar": "10000001"}, "implausible_rate"), ({"rate_percentage": "1001"}, "percentage_out_of_range")]
    got = conform.curate(raw(spark, *(c for c, _ in cases))).collect()
    assert [r.reject for r in got] == [want for _, want in cases]
    assert (got[0].rate_dollar, got[0].rate_kind, got[0].billing_class, got[0].vintage, got[0].methodology, len(got[0].row_hash)) == (1000.5, "dollar", "facility", "2026-04", "per_diem", 32)


def test_ingest_reads_each_file_once(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw(spark, {}, {}, {"code": None}).coalesce(1).write.parquet(landing)
    for _ in range(2):
        ingest(spark, landing, RAW, out, str(tmp_path / "cp"))
    assert (spark.read.parquet(f"{out}/curated").count(), spark.read.parquet(f"{out}/rejects").count()) == (1, 1)


def test_payment_paths(spark):
    base = dict(discharge_rate=8870.0, capital_per_discharge=1468.0, capital_per_diem=0.0, addons_per_discharge=0.0, transfer_addons=0.0, alc_rate=550.0, dme_rate=900.0, ime_pct=0.0, isaf=1.0, charge_converter=0.5, hcra_surcharge=0.0, siw=0.85, alos=4.0, cost_threshold=50000.0, days=2, alc_days=0, gross_charges=1000.0, non_covered_charges=0.0, is_transfer=False)
    df = spark.createDataFrame([{**base}, {**base, "is_transfer": True}, {**base, "gross_charges": 200000.0}])
    got = payment.payments(df).collect()
    assert [r.payment_type for r in got] == ["inlier", "transfer", "high_cost_outlier"]
    assert [r.total for r in got] == pytest.approx([8870 * 0.85 + 1468, 8870 * 0.85 / 4 * 1.2 * 2, 8870 * 0.85 + 1468 + 50000])
    with pytest.raises(Exception, match="positive mean stay"):
        payment.payments(spark.createDataFrame([{**base, "is_transfer": True, "alos": 0.0}])).collect()
