"""The payer side, files, the lake and repeated rows, on hand-built cases."""

import zipfile

import pytest
from pyspark.sql import functions as F
from test_compare import rows

from ratesmith.functions import plans
from ratesmith.functions import text as X
from ratesmith.operators import compare, conform, evals, levers, payer, triage
from ratesmith.sources import files, lake
from ratesmith.streaming import ingest


def values(spark, given, expression):
    return [r["v"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, c string").orderBy("i").select(expression(F.col("c")).alias("v")).collect()]


def test_place_settings(spark):
    given = ["21", "21|11", "52", "55|56", "11", "22 | 23", "21|22", "CSTM-00", "", None, " | "]
    assert values(spark, given, X.place_setting) == ["inpatient", "inpatient", "inpatient", "inpatient", None, "outpatient", "both", "both", "both", "both", "both"]


def test_labels(spark):
    given = ["AetnaALIC_OpenAccess", "UHC_NY_ChoicePlus", "UHC_NY", "Aetna", "uhc_CT_x_y", "Oxford_"]
    assert values(spark, given, lambda c: X.split_label(c)[0]) == ["AetnaALIC", "UHC", "UHC", "Aetna", "uhc", "Oxford"]
    assert values(spark, given, lambda c: X.split_label(c)[1]) == ["OpenAccess", "ChoicePlus", "NY", "Aetna", "x_y", "Oxford"]
    assert values(spark, ["United-Healthcare_x", "AetnaALIC", "hiphos", "zz"], payer.canonical_carrier) == ["UnitedHealthcare", "Aetna", "EmblemHealth", None]


def test_filter_keeps_missing_code_types(spark):
    df = spark.createDataFrame([(None, 1, "A"), ("LOCAL", 1, "A"), ("CPT", 2, "A,B"), ("CPT", 1, "B")], "code_type string, system_count int, systems string")
    assert [tuple(r) for r in df.where(payer.payer_filter()).select("code_type", "systems").collect()] == [(None, "A"), ("CPT", "B")]
    assert df.where(payer.payer_filter(["A"], exclusive=False)).count() == 2
    assert payer.only_in_partition(df, F.col("systems") == "C")
    assert not payer.only_in_partition(df, F.col("systems") == "B")


def test_payer_files(spark, tmp_path):
    for name, columns in (("AetnaALIC_OAMC", "rate double, last_updated_on string"), ("UHC_NY_Plus", "rate double, last_updated_on string"), ("Cigna", "x int"), ("Dup_x", "rate double, last_updated_on string")):
        spark.createDataFrame([(1, "2026-04-01")] if "rate" in columns else [(1,)], columns.replace("rate double", "rate int")).coalesce(1).write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("part-*.parquet"))
        part.rename(tmp_path / f"{name}.parquet")
    (tmp_path / "late.parquet.part").write_bytes(b"x")
    found = payer.payer_files(spark, str(tmp_path), ["rate"], duplicates=["Dup_x"], vintages={"UHC_NY_Plus": "2026-05"})
    assert {r.stem: (r.carrier, r.network, r.vintage, r.skipped) for r in found.collect()} == {
        "AetnaALIC_OAMC": ("AetnaALIC", "OAMC", "2026-04-01", None), "UHC_NY_Plus": ("UHC", "Plus", "2026-05", None), "Cigna": ("Cigna", "Cigna", None, "contract"),
        "Dup_x": ("Dup", "x", "2026-04-01", "duplicate"), "late": ("late", "late", None, "in flight"),
    }
    assert sorted(r.stem for r in payer.open_files(spark, found).collect()) == ["AetnaALIC_OAMC", "UHC_NY_Plus"]


def test_alike_left_rows_each_give_theirs(spark):
    got = compare.distribution_join(rows(spark, {}, {}, {"plan": None}, {"setting": None}), rows(spark, {}).drop("facility")).collect()
    assert sorted((str(r.plan), str(r.setting), r.outcome, r.n) for r in got) == sorted([("PPO", "outpatient", "compared", 1)] * 2 + [("None", "outpatient", "compared", 1), ("PPO", "None", "no payer-side counterpart", 0)])
    exempt = compare.distribution_join(rows(spark, {"product_class": "medicare_advantage"}, {"product_class": "medicare_advantage"}), rows(spark, {}).drop("facility")).collect()
    assert [r.outcome for r in exempt] == ["tic_exempt_product"] * 2


def test_offsets_account_for_unexplained_rows(spark):
    left = [{"code": str(10_000 + i), "rate": 100.0 + i, "plan": "PPO"} for i in range(25)]
    right = [{"code": str(10_000 + i), "rate": (100.0 + i) * 1.25, "plan": "PPO"} for i in range(25)]
    got = compare.with_offsets(compare.explain(compare.distribution_join(rows(spark, *left), rows(spark, *right).drop("facility")))).collect()
    assert {(r.explanation_before, r.explanation, round(r.contract_offset, 6)) for r in got} == {("unexplained", "systematic_offset", 1.25)}
    few = compare.with_offsets(compare.explain(compare.distribution_join(rows(spark, *left[:19]), rows(spark, *right).drop("facility")))).collect()
    assert {(r.explanation, r.contract_offset) for r in few} == {("unexplained", None)}


def test_a_rule_is_met_once_by_each_row(spark):
    df = spark.createDataFrame([(1, ["0360", "0361"], ["A"]), (1, ["0360", "0361"], ["A"]), (2, ["0999"], [])], "id int, revenue array<string>, procedure array<string>")
    rules = spark.createDataFrame([("s", ["0360", "0361"], [], []), ("t", [], ["A", "B"], [])], "service string, revenue array<string>, procedure array<string>, excluded array<string>")
    assert sorted((r.id, r.service) for r in conform.rule_matches(df, rules).collect()) == [(1, "s"), (1, "s"), (1, "t"), (1, "t")]


def test_near_counts_against_all_pairs(spark):
    import random

    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.choice([1.0, 1.03, 1.0299, rng.uniform(0.5, 3)])) for _ in range(120)] + [(None, 1.0), (None, 1.01), ("a", 0.0), ("a", None)]
    got = triage.near_counts(spark.createDataFrame(data, "k string, ratio double"), ["k"]).collect()
    want = [(k, r, sum(k2 == k and r2 is not None and r2 > 0 and r * (1 - 0.03) <= r2 <= r * (1 + 0.03) for k2, r2 in data) if r else 0) for k, r in data]
    assert sorted((str(k), r or 0, n) for k, r, n in map(tuple, got)) == sorted((str(k), r or 0, n) for k, r, n in want)


def test_partitions_with_odd_values_go(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("Anthem / Empire BCBS", 1), ("a=b%c", 2), ("plain", 3)], "k string, v int")
    assert lake.publish(df, path, ["k"]) == 3
    assert lake.publish(df.where("v = 2").withColumn("v", F.lit(9)), path, ["k"]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3, 9]
    assert lake.remove_partitions(spark, path, df.where("v < 3"), ["k"]) == 2
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]
    with pytest.raises(Exception, match="null in partition key"):
        lake.publish(spark.createDataFrame([(None, 1)], "k string, v int"), path, ["k"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]
    assert lake.publish(df.where("v > 5"), path, ["k"]) == 0
    assert lake.publish(df.where("v = 1"), path, ["k"], owned=lambda leaf: "plain" not in leaf) == 1
    assert lake.publish(df.where("v = 2"), path, ["k"], owned=lambda leaf: "plain" not in leaf) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]
    assert lake.publish(df.where("v > 5"), path, ["k"], owned=lambda leaf: "plain" not in leaf) == 0
    checked = lake.verified_manifest(spark, path, spark.createDataFrame([("plain", 1)], "k string, rows long"), ["k"], F.lit(True)).collect()
    assert [(r.k, r.rows, r.verified) for r in checked] == [("plain", 1, True)]


def test_status_snapshots_and_release(spark, tmp_path):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    verdict = lake.run_manifest(spark, {"silver": (a, a), "gold": (a, a.where("n = 1"))}, ["k"], "n", str(tmp_path / "s"), "2026-01-01")
    assert verdict == {"at": "2026-01-01", "ok": False, "layers": {"silver": {}, "gold": {"missing": 1}}}
    assert lake.read_status(spark, str(tmp_path / "s")) == verdict
    assert lake.read_status(spark, str(tmp_path / "none")) is None
    for stamp in ("1", "2", "3"):
        left = lake.rotate(a.withColumn("s", F.lit(stamp)), str(tmp_path / "snap"), stamp, keep=2)
    assert left == ["snapshot=2", "snapshot=3"]
    assert {r.s for r in lake.latest_snapshot(spark, str(tmp_path / "snap")).collect()} == {"3"}
    a.coalesce(1).write.parquet(str(tmp_path / "rel"))
    got = lake.release_manifest(spark, str(tmp_path / "rel")).collect()
    assert [(r.rows, len(r.sha256)) for r in got] == [(2, 64)]
    for i in range(2):
        lake.audit(spark, str(tmp_path / "log"), {"load": i})
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "log")).collect()) == ['{"load": 0}', '{"load": 1}']
    systems = spark.createDataFrame([("nyu", "NYU Langone", "NYU")], "slug string, name string, other_name string")
    assert lake.select_systems(systems, " NYU LANGONE ").count() == lake.select_systems(systems, "").count() == 1
    with pytest.raises(ValueError, match="no system"):
        lake.select_systems(systems, "x")


HEAD = "hospital_name,last_updated_on,location_name\n{},2026-0{}-01,Main\n"
TALL = "description,code|1,code|1|type,payer_name,plan_name,standard_charge|negotiated_dollar\n{},1,CPT,P,A,{}\n"


def test_each_file_has_its_own_head(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEAD.format("Alpha", 1) + TALL.format("x", 5))
    (tmp_path / "in" / "b.csv").write_text(HEAD.format("Beta", 2) + "code|1,code|1|type,description,payer_name,plan_name,standard_charge|negotiated_dollar\n2,CPT,y,P,B,7\n")
    with zipfile.ZipFile(tmp_path / "in" / "c.zip", "w") as z:
        z.writestr("one.csv", HEAD.format("Gamma", 3) + TALL.format("z, long", 9).replace("z, long", '"z, long"'))
        z.writestr("two.csv", TALL.format("no head", 11))
    got = {(r.hospital, r.file_vintage, r.description, r.code, r.plan_name, r.rate_dollar) for r in files.read_price_tall(spark, str(tmp_path / "in")).collect()}
    assert got == {("Alpha", "2026-01-01", "x", "1", "A", "5"), ("Beta", "2026-02-01", "y", "2", "B", "7"), ("Gamma", "2026-03-01", "z, long", "1", "A", "9"), (None, None, "no head", "1", "A", "11")}
    (tmp_path / "broken.csv").write_text('description,code|1,code|1|type,payer_name\n"two\nlines",1,CPT,P\n')
    assert [r.description for r in files.read_price_tall(spark, str(tmp_path / "broken.csv"), multi_line=True).collect()] == ["two\nlines"]


def test_newest_batch_of_a_source_holds(spark, tmp_path):
    schema = "source_url string, payer_name string, plan_name string, code string, code_type string, setting string, billing_class string, rate_dollar string, rate_percentage string, rate_algorithm string, methodology string, file_vintage string"
    row = lambda url, rate: (url, "Acme", "PPO", "1", "CPT", "outpatient", "facility", rate, None, None, None, "2026-01-01")
    for i, batch in enumerate(([row("u1", "5"), row("u2", "6")], [row("u1", "5"), row("u1", "8")])):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))
        ingest.ingest(spark, str(tmp_path / "land"), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
        assert spark.read.parquet(str(tmp_path / "out" / "curated")).count() == (2, 4)[i]
    assert sorted((r.source_url, r.rate_dollar) for r in ingest.current(spark, str(tmp_path / "out")).collect()) == [("u1", 5.0), ("u1", 8.0), ("u2", 6.0)]


def test_labels_are_checked(spark):
    ok = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, cause string")
    assert evals.load_labels(ok, ["k"], {"cause": ["x", "y"]}).count() == 2
    with pytest.raises(Exception, match="unknown value"):
        evals.load_labels(ok, ["k"], {"cause": ["x"]}).collect()
    with pytest.raises(Exception, match="comes twice"):
        evals.load_labels(ok.unionByName(ok), ["k"], {"cause": ["x", "y"]}).collect()
    one = lambda p, f: spark.createDataFrame([(p, f)], "precision double, f1 double")
    assert [evals.beats_baseline(one(*a), one(*b)).first().why for a, b in (((0.9, 0.8), (0.9, 0.7)), ((0.8, 0.9), (0.9, 0.7)), ((0.9, 0.71), (0.9, 0.7)))] == ["passed", "precision regressed", "gain too small"]


def test_samples_are_stratified_and_repeatable(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3 if i < 60 else 0], i < 5) for i in range(100)], "id int, s string, sure boolean")
    picked = levers.stratified(df, ["s"], F.col("sure"), 30, ["id"]).collect()
    assert len(picked) == 30
    assert sum(r.sure for r in picked) == 5
    again = levers.stratified(df.repartition(7), ["s"], F.col("sure"), 30, ["id"]).collect()
    assert {r.id for r in picked} == {r.id for r in again}
    assert levers.stratified(df, ["s"], F.col("sure"), 500, ["id"]).count() == 100


def test_rate_sheet_cells(spark):
    given = ["360-362, 490 with 27130-27132 excluding 27131", "Rev 110; G0101-G0103", "6320-63621", "G0101-H0103", "", None]
    got = values(spark, given, plans.parse_rule)
    assert [(r.revenue, r.procedure, r.excluded, r.bad) if r and r.revenue is not None else None for r in got][:4] == [
        (["0360", "0361", "0362", "0490"], ["27130", "27131", "27132"], ["27131"], []), (["0110"], ["G0101", "G0102", "G0103"], [], []), ([], [], [], ["6320-63621"]), ([], [], [], ["G0101-H0103"])]
