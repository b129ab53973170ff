"""Cells of rate sheets, each distinct one parsed once."""

from pyspark.sql import functions as F

from ratesmith.functions import plans


def test_a_cell_is_parsed_once_and_by_all_tasks(spark):
    cells = ["360-362, 490 with 27130-27132 excluding 27131", "Rev 110; G0101-G0103", "", None, *(f"{n} and 99281" for n in range(100, 160))]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells * 3)], "id int, cell string").coalesce(1)
    got = plans.with_rules(df, "cell", "r")
    want = df.withColumn("r", plans.parse_rule(F.col("cell")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Aggregate" in plan.split("RepartitionByExpression")[1]
