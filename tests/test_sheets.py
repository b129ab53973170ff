"""Workbooks and text tables as cells, and published tables out of them."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import loaders
from ratesmith.sources import sheets

TABLE_5 = 'TABLE 5.-LIST OF MS-DRGS, RELATIVE WEIGHTING FACTORS\t\t\t\n\nMS-DRG\tFinal Post-Acute\tMS-DRG Title\t"1 Weights - 10%\n Cap Applied"\tWeights - Before Cap\n001\tNo\t"HEART, ""NEW"""\t{}\t20\n064\tYes\tSTROKE\t$2.5\t2.6\n998\tNo\tINVALID\t1\t1\n065\tNo\tNONE\t-\t1\n* note\n'
TABLE_1 = "TABLES 1A-1E\n\nTABLE 1A. OPERATING AMOUNTS (67.6 PERCENT)\t\nFull update\t\tReduced\n$4,478.41\t$2,147.23\t$4,300.00\t$2,000.00\n\nTABLE 1B. AMOUNTS\n$4,100.50\t$2,500\n"
TABLE_2 = "TABLE 2\nCCN\tFY 2025 Wage\xa0Index With Quartile and Cap\tGeographic CBSA\tWage Index Payment CBSA\tAverage Case-Mix Indexes\tCounty Name\n330001\t1.4\t35614\t\t1.7\tKINGS\n330001\t1.5\t35614\t10580\t1.8\tKINGS\nx\t1\t1\t1\t1\tno\n"
TABLE_3 = "TABLE 3\nCBSA\tState\tWage Index\n35614\tNY\t1.3\n35614\tNJ\t1.9\n10580\tNY\t\n"


def _zip(members: dict) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


@pytest.fixture(scope="module")
def cms(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    inner = _zip({"CMS Table 5 final.txt": TABLE_5.format("9.4038"), "CMS Table 5 -CN .txt": TABLE_5.format("9.4045"), "Tables 2 wage.txt": TABLE_2, "Tables 3 wage.txt": TABLE_3, "Table 1A-1E.txt": TABLE_1})
    (at / "cms.zip").write_bytes(_zip({"inner.zip": inner, "readme.pdf": b"no"}))
    (at / "cut.zip").write_bytes(_zip({"a.txt": "x\ty\n" * 1000})[:200])
    found = sheets.read(spark.createDataFrame([(str(at / "cms.zip"),), (str(at / "cut.zip"),)], "file string")).cache()
    yield found
    found.unpersist()


def test_weights_prefer_the_correction(cms):
    c = sheets.cells(cms)
    rows = {r.code: (r.weight, r.description, r.source) for r in loaders.inpatient_weights(c, 2025).collect()}
    assert rows == {"001": (9.4045, 'HEART, "NEW"', "IPPS Table 5 FY2025 (CMS Table 5 -CN .txt)"), "064": (2.5, "STROKE", "IPPS Table 5 FY2025 (CMS Table 5 -CN .txt)")}
    old = {r.code: r.weight for r in loaders.inpatient_weights(c, 2025, capped=False, prefer_correction=False).collect()}
    assert old == {"001": 20.0, "064": 2.6, "065": 1.0}
    assert {r.weight for r in loaders.inpatient_weights(c, 2025, prefer_correction=False).where("code = '001'").collect()} == {9.4038}


def test_both_regimes_and_wages(cms):
    c = sheets.cells(cms)
    got = {r.regime: (r.labor, r.other, round(r.labor_share, 4)) for r in loaders.standard_amounts(c, 2025).collect()}
    assert got == {"high": (4478.41, 2147.23, 0.6759), "low": (4100.5, 2500.0, 0.6212)}
    assert [(r.ccn, r.wage_index, r.cbsa, r.case_mix_index, r.county) for r in loaders.wage_index(c).collect()] == [("330001", 1.5, "10580", 1.8, "KINGS")]
    assert [(r.cbsa, r.wage_index) for r in loaders.area_wage_index(c).collect()] == [("35614", 1.3)]


def test_what_cannot_be_read_is_told(cms):
    assert [r.file.endswith("cut.zip") for r in sheets.problems(cms).collect()] in ([True], [])
    lay = {r.member.split("!")[-1]: (r.header, r.missing) for r in sheets.layout(sheets.cells(cms), "ccn", loaders.WAGE_COLUMNS).where(F.col("file").endswith("cms.zip")).collect()}
    assert lay["Tables 2 wage.txt"] == (1, []) and lay["Tables 3 wage.txt"][0] is None and len(lay) == 5


def _book(spark, path, sheet, rows, name="b"):
    df = spark.createDataFrame([(name, sheet, i, r) for i, r in enumerate(rows)], "book string, sheet string, row int, cells array<string>")
    return sheets.cells(sheets.read(sheets.write_workbooks(df, str(path)).select("file"))).cache()


def test_services_under_their_headings(spark, tmp_path):
    rows = [["Service", "Codes"], ["SURGERY & MORE"], ["Hip", "360-362 with 27130"], [], [None, "no name"], ["IMAGING <x>", " "], ["Scan", "0450"], ["Hip", "0490"]]
    c = _book(spark, tmp_path, "Rates & more", rows)
    fix = spark.createDataFrame([("Scan", "0450", "0451", True), ("Hip", "360", "1", False)], "service string, find string, replace string, confirmed boolean")
    got = [(r.category, r.name, r.revenue, r.procedure) for r in loaders.service_rules(c, fix).orderBy("row").collect()]
    assert got == [("SURGERY & MORE", "Hip", ["0360", "0361", "0362"], ["27130"]), ("IMAGING <x>", "Scan", ["0451"], []), ("IMAGING <x>", "Hip", ["0490"], [])]
    assert c.select("sheet").distinct().first().sheet == "Rates & more"


def test_headings_pass_from_block_to_block(spark, tmp_path):
    c = _book(spark, tmp_path, "s", [["A"], *[["x"]] * 7, ["B"], *[["x"]] * 6])
    rows = sheets.rows(c, ["v"]).withColumn("h", F.when(F.col("v") != "x", F.col("v")))
    for size in (1, 3, 100):
        assert [r.h for r in sheets.carried_down(rows, "h", size).orderBy("row").collect()] == ["A"] * 8 + ["B"] * 7


def test_rates_and_severities(spark, tmp_path):
    head, values = ["Cert", "Hospital"], [str(i) for i in range(1, 17)]
    c = _book(spark, tmp_path / "a", "2025_ACUTE", [["banner"], head, ["7000001", "One", *values], ["7000002", "Two", "$1,000.50", None, "n/a"], ["notes", "x"], ["7000003"]])
    got = {r.opcert: r.asDict() for r in loaders.rate_schedules(c, "mmc").collect()}
    assert set(got) == {"7000001", "7000002"} and got["7000001"]["addons_per_discharge"] == 8 + 9 + 10 + 11 + 12 + 13 and got["7000001"]["transfer_addons"] == 25 and got["7000001"]["hcra_surcharge"] == 16
    assert got["7000002"]["discharge_rate"] == 1000.5 and got["7000002"]["isaf"] == 0.0
    ffs = {r.opcert: r for r in loaders.rate_schedules(c, "ffs").collect()}["7000001"]
    assert (ffs.discharge_rate, ffs.capital_per_discharge, ffs.addons_per_discharge, ffs.hcra_surcharge) == (2, 8, 0, 11)
    w = _book(spark, tmp_path / "b", "w", [["DRG"], ["1", "1", "Liver", "9.1", "20", "100,000"], ["139", "5", "no", "1"], ["139", "4", None, "1.5"]])
    assert [(r.apr_drg, r.severity, r.siw, r.alos, r.cost_threshold, r.description) for r in loaders.severity_weights(w).orderBy("row").collect()] == [("001", 1, 9.1, 20.0, 100000.0, "Liver"), ("139", 4, 1.5, 0.0, 0.0, "")]


def test_shared_strings_and_positions(spark, tmp_path):
    main, rel = sheets._MAIN[1:-1], sheets._REL[1:-1]
    cells = '<c r="B1" t="s"><v>0</v></c><c r="AA1"><v>1.5</v></c><c r="AB1" t="e"><v>#N/A</v></c></row><row><c t="s"><v>1</v></c><c t="b"><v>1</v></c><c t="str"><f>A1</f><v>made</v></c>'
    data = _zip({
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="chart" r:id="c"/><sheet name="S" r:id="r"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="c" Target="charts/1.xml"/><Relationship Id="r" Target="/xl/worksheets/s.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>plain</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si></sst>',
        "xl/worksheets/s.xml": f'<worksheet xmlns="{main}"><sheetData><row r="3">{cells}</row></sheetData></worksheet>',
    })
    (tmp_path / "x.xlsx").write_bytes(data)
    got = sheets.read(spark.createDataFrame([(str(tmp_path / "x.xlsx"),)], "file string")).orderBy("row", "col").collect()
    assert [(r.place, r.sheet, r.row, r.col, r.value) for r in got] == [(1, "S", 2, 1, "plain"), (1, "S", 2, 26, "1.5"), (1, "S", 3, 0, "two runs"), (1, "S", 3, 1, "TRUE"), (1, "S", 3, 2, "made")]


def test_fee_tables(spark, tmp_path):
    (tmp_path / "b.csv").write_text('Addendum B,,,\nHCPCS Code,Short Descriptor,Status Indicator,Payment Rate\ng0101,"Exam, any",T,"$1,100.25"\n99213,Visit,N,10\n99214,Visit,,\n')
    (tmp_path / "r.zip").write_bytes(_zip({"rvu.txt": "RVU\t\nHCPCS\tStatus Code\tWork RVU\tNon-Fac PE RVU\tMP RVU\n99213\tA\t1\t0.5\t0.25\n99214\tX\t1\t1\t1\n99215\tR\t1\t\t1\n"}))
    read = lambda name: sheets.cells(sheets.read(spark.createDataFrame([(str(tmp_path / name),)], "file string")))
    assert [(r.code, r.amount, r.description) for r in loaders.outpatient_rates(read("b.csv"), 2025).collect()] == [("G0101", 1100.25, "Exam, any")]
    assert [(r.code, r.amount, r.source) for r in loaders.professional_rates(read("r.zip"), 2025, 32.3465).collect()] == [("99213", 56.61, "PFS RVU CY2025 at CF 32.3465, national GPCIs (rvu.txt)")]
    with pytest.raises(ValueError, match="positive"):
        loaders.professional_rates(read("r.zip"), 2025, 0)


def test_empty(spark):
    none = sheets.cells(sheets.read(spark.createDataFrame([], "file string")))
    assert loaders.rate_schedules(none, "mmc").count() == loaders.service_rules(none).count() == loaders.inpatient_weights(none, 2025).count() == 0
