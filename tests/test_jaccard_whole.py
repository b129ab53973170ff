"""The name match over all parts, against brute force and on a name that only a large part has."""

import pyspark.sql.functions as F

import __spark_entry__

DIR = "/root/testdata/sf0.001"


def plain(rows):
    left, right = {n for n, _ in rows}, {f"{n} {t.lower()}" for n, t in rows}
    out = {}
    for a in left:
        x = set(a.split())
        scores = [(len(x & y) / len(x | y), b) for b in right if (y := set(b.split())) & x]
        (score, match), *others = sorted(scores, key=lambda s: (-s[0], s[1]))
        out[a] = (match, round(score, 6), round(others[0][0], 6) if others else 0.0)
    return out


def check(spark, sf_dir):
    rows = [(r.p_name, r.p_type) for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect()]
    found = __spark_entry__.queries()["jaccard_match_whole"](spark, sf_dir).collect()
    assert {r.name: (r.match, round(r.score, 6), round(r.second, 6)) for r in found} == plain(rows)
    return {r.name: r.match for r in found}


def test_all_parts_enter(spark):
    check(spark, DIR)


def test_a_name_of_large_parts_only_is_found(spark, tmp_path):
    part = spark.read.parquet(f"{DIR}/part.parquet").limit(40).withColumn("p_size", F.lit(1).cast("int"))
    large = part.limit(1).withColumns({"p_name": F.lit("zinc quaggle"), "p_type": F.lit("SPECIAL"), "p_size": F.lit(50).cast("int")})
    part.unionByName(large).write.parquet(f"{tmp_path}/part.parquet")
    assert check(spark, str(tmp_path))["zinc quaggle"] == "zinc quaggle special"
