"""Names matched without joins on frequent words give what comparing all pairs gives."""

import random

import pytest
from pyspark.sql import functions as F

from ratesmith.operators import places, resolve

RARE = [f"w{i}q" for i in range(60)]


def _names(seed, n):
    r = random.Random(seed)
    out = {" ".join([*r.sample(["aa", "bb", "cc", "dd"], r.randint(0, 4)), *r.sample(RARE, r.choice([0, 0, 1, 2]))]) for _ in range(n)}
    return sorted(out - {""})


def _best(name, others, least=0.72, margin=0.08):
    a = set(name.lower().split())
    scored = sorted((-len(a & b) / len(a | b), x) for x in others if (b := set(x.lower().split())) & a)
    if not scored:
        return None
    s, second = -scored[0][0], -scored[1][0] if len(scored) > 1 else 0.0
    return name, scored[0][1], round(s, 9), round(second, 9), s >= least and s - second >= margin


@pytest.mark.parametrize("often", [2])
def test_best_and_second_of_all_pairs(spark, often):
    left, right = [*_names(1, 60), "AA BB", "nothing alike"], _names(2, 90)
    side = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    got = resolve.match_names(side(left), side(right), often=often).collect()
    assert sorted((r.name, r.match, round(r.score, 9), round(r.second, 9), r.sure) for r in got) == sorted(x for n in left if (x := _best(n, right)))


@pytest.mark.parametrize("by_state", [True])
def test_locations_are_as_with_all_joins(spark, by_state):
    locations = spark.createDataFrame([(x, s) for i, x in enumerate(_names(3, 50)) for s in ["NY", "NJ", None][: 1 + i % 3]], "name string, state string")
    known = spark.createDataFrame([(f"{i:03}", x, "NY" if i % 2 else "NJ") for i, x in enumerate(_names(4, 80))], "id string, name string, state string")
    rows = lambda often: sorted(map(str, places.match_locations(locations, known, by_state, often).collect()))
    whole = rows(1000)
    assert rows(2) == whole and any("under-specified" in r for r in whole) and any("token-overlap" in r for r in whole)


def test_a_word_of_all_names_makes_few_candidates(spark):
    names = spark.range(3000).select(F.concat(F.lit("general "), F.concat(F.lit("x"), F.floor(F.col("id") / 3)), F.lit(" "), F.concat(F.lit("y"), F.col("id"))).alias("name"))
    a = names.select(F.col("name").alias("l"), resolve.name_tokens(F.col("name")).alias("_aw"))
    b = names.select(F.col("name").alias("r"), resolve.name_tokens(F.col("name")).alias("_bw"))
    found = resolve.word_candidates(a, b, ["l"], ["r"]).groupBy("l").count().agg(F.max("count"), F.count("*")).first()
    assert found[0] <= 8 and found[1] == 3000
