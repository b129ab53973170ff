"""Exact order statistics where a few keys have most rows, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratesmith.operators import aggregate


@pytest.mark.parametrize("kind", ["spread", "tied", "few values"])
def test_hot_keys_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(aggregate, "HOT_ROWS", 2000)
    monkeypatch.setattr(aggregate, "ACCURACY", 100)
    rng = np.random.default_rng(1)
    sizes = {("a", 1): 9000, ("a", None): 5001, ("b", 2): 2500, ("c", 3): 7, ("d", 4): 1}
    make = {"spread": lambda n: np.exp(rng.normal(size=n) * 8), "tied": lambda n: np.where(rng.random(n) < 0.7, 5.0, rng.normal(size=n)), "few values": lambda n: rng.integers(0, 3, n).astype(float)}[kind]
    values = {k: make(n) for k, n in sizes.items()}
    data = [(*k, float(v)) for k, own in values.items() for v in own] + [("a", 1, None), ("e", 5, None)]
    df = spark.createDataFrame(data, "x string, y int, v double").repartition(5)
    n = F.col("_n")
    got = {(r.x, r.y): (r.first, r.middle, r.last) for r in aggregate.order_statistics(df, ["x", "y"], "v", {"first": F.lit(1), "middle": F.floor(n / 2) + 1, "last": n}).collect()}
    assert got == {k: (min(v), np.sort(v)[len(v) // 2], max(v)) for k, v in values.items()}
    assert {(r.x, r.y): r["median"] for r in aggregate.exact_median(df, ["x", "y"], "v").collect()} == {k: float(np.median(v)) for k, v in values.items()}
    p90 = {(r.x, r.y): r.p90 for r in aggregate.p90_floor(df, ["x", "y"], "v").collect()}
    assert p90 == {k: np.sort(v)[min(len(v) - 1, len(v) * 9 // 10)] for k, v in values.items()}


def test_no_rows(spark):
    assert aggregate.exact_median(spark.createDataFrame([], "x string, v double"), ["x"], "v").count() == 0
