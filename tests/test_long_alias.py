"""Aliases of any number of words."""

from ratesmith.operators import resolve


def test_an_alias_of_six_words(spark):
    aliases = resolve.alias_table(spark, {"Long": ["a plan with six words here"], "Short": ["plan"]})
    names = spark.createDataFrame([("the a plan with six words here inc",), ("plan b",), ("none",)], "name string")
    assert {r.name: r.canonical for r in resolve.alias_match(names, "name", aliases).collect()} == {"the a plan with six words here inc": "Long", "plan b": "Short", "none": None}
    assert resolve.alias_match(names, "name", aliases.where("false")).where("canonical IS NOT NULL").count() == 0
