"""JSON documents in blocks against the library that reads them whole."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratesmith.sources import files, ranges


def hard(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(['a"b', "x\\", '\\"', "{[,]}:", "é漢😀", "", "\\\\\"", "tab\tnew\nline", "plain"])
    if kind < 4:
        return rng.choice([1, -2.5, True, None, 10**12])
    if kind == 4:
        return [hard(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["k", 'q"', "b\\"]) + str(i): hard(rng, depth + 1) for i in range(rng.randrange(4))}


def elements(spark, path, block, names=None, about=()):
    rows = ranges.json_elements(ranges.listed(spark, str(path)), names, list(about), block).orderBy("file", "place").collect()
    out = {}
    for r in rows:
        out.setdefault((r.file.rsplit("/", 1)[1], r.name), []).append(json.loads(r.value) if r.whole else None)
    return out, rows


def test_block_states_compose():
    rng = random.Random(1)
    data = np.frombuffer(json.dumps([hard(rng) for _ in range(200)], ensure_ascii=False).encode(), np.uint8)
    whole = ranges._summary(data, ranges.OUTSIDE)
    assert whole == (ranges.OUTSIDE, 0)
    for size in (1, 2, 3, 7, 50):
        state = depth = 0
        for low in range(0, len(data), size):
            state, more = ranges._summary(data[low : low + size], state)
            depth += more
        assert (state, depth) == whole


@pytest.mark.parametrize("block", [9, 1 << 20])
def test_elements_as_read_whole(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(ranges, "MORE", 7)
    rng = random.Random(2)
    docs = {f"d{i}.json": {"name": hard(rng, 3), "first": [hard(rng) for _ in range(rng.randrange(4))], "object": {"in": [1, {"x": [2]}], "y": 3}, "scalars": ["a", "b,]"], "empty": [], "second": [hard(rng) for _ in range(3)], "last": "x"} for i in range(4)}
    for n, d in docs.items():
        (tmp_path / n).write_text(json.dumps(d, ensure_ascii=False, indent=rng.choice([None, 1])), encoding="utf-8")
    (tmp_path / "list.json").write_text("[1, 2]")
    (tmp_path / "none.json").write_text("")
    got, rows = elements(spark, tmp_path, block, about=("name", "last", "scalars", "object"))
    assert got == {(n, k): v for n, d in docs.items() for k, v in d.items() if isinstance(v, list) and v}
    for r in rows:
        d = docs[r.file.rsplit("/", 1)[1]]
        assert {k: json.loads(v) for k, v in r.about.items()} == {k: d[k] for k in ("name", "last", "scalars", "object")}
    assert {r.file.rsplit("/", 1)[1] for r in ranges.cut_off(ranges.listed(spark, str(tmp_path)), block).where("truncated").collect()} == set()  # files without bytes aren't listed


def test_a_document_that_is_cut_off_yields_what_it_holds(spark, tmp_path):
    items = [{"description": f"item {i}", "code_information": [{"code": str(i), "type": "CPT"}], "standard_charges": [{"setting": "inpatient", "payers_information": [{"payer_name": "A", "plan_name": "P", "standard_charge_dollar": 5.5}]}]} for i in range(50)]
    text = json.dumps({"hospital_name": "H", "location_name": ["a", "b"], "last_updated_on": "2026-01-01", "standard_charge_information": items})
    (tmp_path / "whole.json").write_text(text)
    (tmp_path / "cut.json").write_text(text[: text.index("item 30") + 3])
    (tmp_path / "packed.json.gz").write_bytes(gzip.compress(text.encode()))
    got = files.read_price_json(spark, str(tmp_path), block=300).withColumn("file", F.regexp_extract("source_url", "([^/]*)$", 1))
    by = {r.file: r["count"] for r in got.groupBy("file").count().collect()}
    assert by == {"whole.json": 50, "cut.json": 30, "packed.json.gz": 50}
    one = {tuple(r) for r in got.where("file <> 'cut.json'").select("hospital", "location_name", "file_vintage", "description", "code", "code_type", "setting", "payer_name", "rate_dollar").collect()}
    assert len(one) == 50 and ("H", "a|b", "2026-01-01", "item 7", "7", "CPT", "inpatient", "A", "5.5") in one
    assert {r.file[-8:]: r.truncated for r in ranges.cut_off(ranges.listed(spark, str(tmp_path / "*.json"))).collect()} == {"ole.json": False, "cut.json": True}


def test_many_tasks_read_one_document(spark, tmp_path):
    (tmp_path / "large.json").write_text(json.dumps({"rows": [{"i": i, "pad": "x" * 200} for i in range(5000)]}))
    rows = ranges.json_elements(ranges.listed(spark, str(tmp_path)), block=100_000)
    each = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in each) == 5000 and len(each) > 5 and max(r["count"] for r in each) < 2500


def test_rows_with_blank_cells_stay(spark, tmp_path):
    head = "hospital_name,last_updated_on,location_name\nH {0},2026-01-0{0},\"a, {0}\"\n\n"
    table = "description,code|1,code|1|type,payer_name,plan_name,standard_charge|negotiated_dollar\n"
    rows = [",1,CPT,A,P,5", "two,2,CPT,A,P,6", ",3,CPT,A,P,7", "\"say \"\"four\"\"\",4,CPT,A,P,8"]
    for i in (1, 2):
        (tmp_path / f"f{i}.csv").write_text(head.format(i) + table + "\n".join(rows) + "\n")
    (tmp_path / "late.csv").write_text("x,y\n" * 40 + table + rows[0] + "\n")
    (tmp_path / "none.csv").write_text("nothing,here\n1,2\n")
    (tmp_path / "own.csv").write_text("note,description,code|1,code|1|type,description\nn,d,9,CPT,other\n")
    got = files.read_price_tall(spark, str(tmp_path)).withColumn("file", F.regexp_extract("source_url", "([^/]*)$", 1))
    by = {}
    for r in got.collect():
        by.setdefault(r.file, []).append((r.hospital, r.file_vintage, r.location_name, r.description, r.code, r.rate_dollar))
    for i in (1, 2):
        about = (f"H {i}", f"2026-01-0{i}", f"a, {i}")
        assert sorted(by[f"f{i}.csv"], key=lambda x: x[4]) == [(*about, None, "1", "5"), (*about, "two", "2", "6"), (*about, None, "3", "7"), (*about, 'say "four"', "4", "8")]
    assert by["late.csv"] == [(None, None, None, None, "1", "5")] or by["late.csv"][0][3:] == (None, "1", "5")
    assert by["own.csv"][0][3:] == ("d", "9", None)
    assert {r.file.rsplit("/", 1)[1]: r.skipped for r in files.price_heads(spark, str(tmp_path)).where("skipped IS NOT NULL").collect()} == {"none.csv": "no header"}


def test_a_task_reads_many_small_blocks(spark):
    """Of 10,000 blocks of a kilobyte no task is made for each; large blocks stay a task each beyond the shuffle's partitions."""
    files = lambda n: spark.createDataFrame([("f", n)], "file string, size long")
    parts = max(ranges.FEW, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert ranges._tasks(ranges.blocks(files(10_000 << 10), 1 << 10), 1 << 10) == parts
    assert ranges._tasks(ranges.blocks(files(1000 << 20), 1 << 20), 1 << 20) == max(parts, 32)
    assert ranges._tasks(ranges.blocks(files(3 << 20), 1 << 20), 1 << 20) == min(parts, 3)
    assert ranges._tasks(ranges.blocks(files(100 * ranges.TASK), ranges.TASK), ranges.TASK) == max(parts, 100)


def test_summaries_of_all_states_agree_with_each():
    dice = random.Random(3)
    for _ in range(2000):
        data = np.frombuffer("".join(dice.choice('"\\{}[],a') for _ in range(dice.randrange(0, 12))).encode(), np.uint8)
        assert ranges._all_summaries(data) == [ranges._summary(data, s) for s in (ranges.OUTSIDE, ranges.INSIDE, ranges.ESCAPED)]
    data = np.frombuffer(b'"{"' * 1000, np.uint8)
    assert ranges._all_summaries(data)[1] == (ranges.INSIDE, 1000)
