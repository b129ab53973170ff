"""In-network files, lists, summary tables and pasted codes."""

import json

from pyspark.sql import functions as F

from ratesmith.functions import plans
from ratesmith.functions import text as X
from ratesmith.sources import extracts

DOC = {
    "reporting_entity_name": "x", "last_updated_on": "2026-01-01",
    "provider_references": [{"provider_group_id": 1, "provider_groups": [{"npi": ["10", "11"], "tin": {"type": "ein", "value": "t"}}, {"npi": ["11"], "tin": {"type": "ein", "value": "u"}}]}, {"provider_group_id": 2, "provider_groups": []}],
    "in_network": [
        {"negotiation_arrangement": "ffs", "name": "n", "billing_code_type": "CPT", "billing_code": "99213", "negotiated_rates": [{"provider_references": [1, 2], "negotiated_prices": [{"negotiated_type": "negotiated", "negotiated_rate": 5.5, "billing_class": "professional", "service_code": ["11"]}, {"negotiated_type": "percentage", "negotiated_rate": 50, "billing_class": "institutional"}]}]},
        {"negotiation_arrangement": "bundle", "name": "m", "description": "d", "billing_code_type": "MS-DRG", "billing_code": "064", "bundled_codes": [{"billing_code_type": "RC", "billing_code": "0360"}, {"billing_code_type": "CPT", "billing_code": "1"}], "negotiated_rates": []},
    ],
}


def test_in_network_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOC))
    e = extracts.read_in_network(spark, str(tmp_path / "a.json"))
    assert [tuple(r) for r in e["items"].orderBy("item_idx").collect()] == [("a.json", 0, "ffs", "CPT", "99213", "n", None), ("a.json", 1, "bundle", "MS-DRG", "064", "d", ["0360"])]
    assert [(r.gid, r.npis, r.tins) for r in e["groups"].orderBy("gid").collect()] == [(1, ["10", "11"], ["t", "u"]), (2, [], [])]
    assert sorted((r.item_idx, tuple(r.refs), r.rate) for r in e["prices"].collect()) == [(0, (1, 2), 5.5), (0, (1, 2), 50.0)]
    codes = spark.createDataFrame([("CPT", "99213")], "code_type string, code string")
    gids = spark.createDataFrame([("a.json", 2)], "source_file string, gid long")
    assert [(r.gid, r.code, r.rate) for r in extracts.rescan(e, codes, gids).collect()] == [(2, "99213", 5.5)]


def test_in_network_files_in_blocks(spark, tmp_path):
    doc = DOC | {"in_network": [DOC["in_network"][i % 2] | {"name": f"n{i}", "description": None} for i in range(40)]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text(json.dumps(doc)[: json.dumps(doc).index('"n33"')])
    for block in (400, None):
        e = extracts.read_in_network(spark, str(tmp_path), block)
        got = sorted((r.source_file, r.item_idx, r.description) for r in e["items"].collect())
        assert got == [("a.json", i, f"n{i}") for i in range(40)] + [("b.json", i, f"n{i}") for i in range(33)]
        assert e["prices"].count() == 40 + 2 * 17 and e["groups"].count() == 4


def test_lists_and_summaries(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Facility ID,Facility Name,City/Town,State,County/Parish,Hospital Type\n1,A ,x,NY,ERIE,Acute Care Hospitals\n2,B,y,NY,,Psychiatric\n,C,z,NY,,Acute\n")
    assert [(r.ccn, r.name) for r in extracts.read_facilities(spark, str(tmp_path / "f.csv")).collect()] == [("1", "A")]
    assert extracts.read_facilities(spark, str(tmp_path / "f.csv"), acute_only=False).count() == 2
    assert {t for _, t in extracts.read_text_csv(spark, str(tmp_path / "*.csv")).dtypes} == {"string"}
    (tmp_path / "coverage.csv").write_text("system,candidates\na,5\n")
    tables, missing = extracts.read_summary(spark, str(tmp_path), {"coverage": "system string, candidates long", "pairs": "facility string"})
    assert ([tuple(r) for r in tables["coverage"].collect()], tables["pairs"].count(), missing) == ([("a", 5)], 0, ["pairs"])


def test_pasted_codes_and_repaired_text(spark):
    text = "RC\tCPT\n0450\t99281\n0450\t99281\n139 4\n99213, 99214\ncode 470 xx\n\n12\tabc1\nno digits"
    got = plans.parse_paste(spark.createDataFrame([(text,)], "t string"), "t").orderBy("place").collect()
    assert [(r.code, r.rc) for r in got] == [("99281", "0450"), ("139-4", None), ("99213", None), ("99214", None), ("470", None), ("12", None)]
    names = ["CafÃ© Hospital", "Café", "plain", None, ""]
    fixed = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i").select(X.repair_mojibake(F.col("n")).alias("v")).collect()
    assert [r.v for r in fixed] == ["Café Hospital", "Café", "plain", None, ""]
