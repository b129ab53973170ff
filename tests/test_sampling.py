"""Byte windows of ordered files, and footers read by tasks."""

import hashlib

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ratesmith.sources import footers, ranges, sampling

HEAD = "hospital_name,last_updated_on\nHôpital é,2026-01-01\ndescription,code|1,payer_name,standard_charge|negotiated_dollar,standard_charge|negotiated_algorithm\n"


def kind():
    return F.when(F.try_element_at("row", F.lit("standard_charge|negotiated_dollar")) != "", "dollar").otherwise("algorithm")


def test_windows_see_all_of_an_ordered_file(spark, tmp_path):
    body = [f"Svc {i},{i},Aetna,{i}.0," for i in range(4000)] + [f'"Svc {i}, é",{i},Aetna,,base' for i in range(4000)]
    (tmp_path / "f.csv").write_text(HEAD + "\n".join(body) + "\n", encoding="utf-8")
    (tmp_path / "none.csv").write_text("a,b\n1,2\n")
    files = ranges.listed(spark, str(tmp_path))
    rows = sampling.sample_rows(files, 16, 4096)
    assert set(rows.first().row) == set(HEAD.strip().split("\n")[-1].split(","))
    assert 16 == rows.select("window").distinct().count() and rows.count() < 8000
    got = {r.value: r for r in sampling.shares(rows, kind()).collect()}
    assert 0.35 < got["dollar"].share < 0.65 and abs(got["dollar"].share + got["algorithm"].share - 1) < 1e-9 and 0.05 < got["dollar"].error < 0.2
    assert {r.value for r in sampling.shares(sampling.sample_rows(files, 16, 4096).where("window = 0"), kind()).collect()} == {"dollar"}
    whole = sampling.sample_rows(files)
    assert whole.count() == 8000 and whole.select("window").distinct().count() == 1
    assert [r.error for r in sampling.shares(whole, kind()).collect()] == [None, None]
    assert sorted(r.d for r in whole.select(F.try_element_at("row", F.lit("description")).alias("d")).collect())[0] == "Svc 0"


def test_footers(spark, tmp_path):
    pq.write_table(pa.table({"a": list(range(10)), "when": ["2026-05"] * 10}), tmp_path / "x.parquet", row_group_size=4)
    pq.write_table(pa.table({"a": pa.array([], pa.int64())}), tmp_path / "empty.parquet")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 not really")
    got = {r.file.rsplit("/", 1)[1]: r for r in footers.footers(ranges.listed(spark, str(tmp_path)), "when", digest=True).collect()}
    assert (got["x.parquet"].rows, got["x.parquet"].row_groups, got["x.parquet"].columns, got["x.parquet"].first) == (10, 3, ["a", "when"], "2026-05")
    assert got["x.parquet"].sha256 == hashlib.sha256((tmp_path / "x.parquet").read_bytes()).hexdigest()
    assert (got["empty.parquet"].rows, got["empty.parquet"].first, got["bad.parquet"].rows) == (0, None, None) and got["bad.parquet"].error and not got["x.parquet"].error
