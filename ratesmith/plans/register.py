"""The query catalogue: named queries over the order tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import analogue as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PLACES = 9


def register(sql: str, doubles: str = ""):
    """The query under its function's name. Doubles are rounded on both sides: medians may differ in the last place."""

    def run_as(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(spark, sf_dir)
            return out.withColumns({c: F.round(c, PLACES) for c, t in out.dtypes if t == "double"})

        QUERIES[f.__name__] = run
        replaced = ", ".join(f"round({c}, {PLACES}) AS {c}" for c in doubles.split())
        ORACLES[f.__name__] = f"SELECT * REPLACE ({replaced}) FROM ({sql}) AS result" if doubles else sql
        return f

    return run_as


def with_(tail: str, head: str | None = None) -> str:
    return f"WITH {head or A.base_sql()} {tail}"
