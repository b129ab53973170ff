"""Names to entities. All work is done on distinct names, whose results are joined back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.rules import tables as T
from ratesmith.sources import lake

from .aggregate import first_rows


def alias_table(spark: SparkSession, aliases: dict[str, list[str]] = T.PAYER_ALIASES) -> DataFrame:
    return spark.createDataFrame([(a, name, i) for i, (name, a) in enumerate((n, a) for n, each in aliases.items() for a in each)], "alias string, canonical string, ord int")


def alias_match(names: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """Adds canonical: the longest alias that stands in the name as whole words, of ties the first listed; else null.

    Every run of up to as many words of a distinct name as the longest alias has is looked up, an equi-join instead of a pattern per alias."""
    most = aliases.agg(F.max(F.size(F.split("alias", " ")))).first()[0] or 1
    each = names.select(name).distinct().withColumn("_w", F.split(X.canonical_key(F.col(name)), " "))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w"), F.lit(1)))
    runs = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.lit(most)), lambda n: F.array_join(F.slice(F.col("_w"), i, n), " "))))
    found = each.withColumn("alias", F.explode(F.array_distinct(runs))).join(aliases, "alias")
    best = first_rows(found, [name], [F.length("alias").desc(), F.col("ord")]).select(name, "canonical")
    return names.join(best, name, "left")


def name_tokens(c: Column) -> Column:
    """Distinct words of two letters or more, small and sorted."""
    words = F.split(F.lower(F.regexp_replace(X.normalise_name(c), r"[^A-Za-z0-9 ]", " ")), r"\s+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda x: F.length(x) > 1)))


#: Right names that may have a word that is joined on; words of more names are looked at by class.
OFTEN = 32


def likeness(both: Column, a: Column, b: Column) -> Column:
    return both / (a + b - both)


def word_candidates(a: DataFrame, b: DataFrame, a_key: list[str], b_key: list[str], within: list[str] | None = None, score: Callable[[Column, Column, Column], Column] = likeness, often: int = OFTEN) -> DataFrame:
    """(a_key, b_key, _both, _a, _b, _supers): for each name of a, all of b that share a rarer word, and two more that are the best of
    those that share only words of over `often` names of b: the two best of all are among them, by score and then by b_key.

    a: a_key, _aw; b: within, b_key, _bw, arrays of distinct words; within, a part of a_key, has to be equal. No join is on a word
    that many names have. Without a rarer word in common a score rests on the frequent words of both and on b's number of words, so
    names that agree in these are one class, which its two least names stand for: two that share a rarer word with the name
    besides are better than the class, and leave it out of the two best. Classes that share a word are joined on it. _supers: how
    many names of b have all the name's words, summed up over a name's rows with a rarer word, and the same on all others."""
    within = within or []
    on = [*within, "_t"]
    aw, bw = a.withColumn("_t", F.explode("_aw")), b.withColumn("_t", F.explode("_bw"))
    frequent = bw.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > often).select(*on, F.lit(True).alias("_often"))
    read = a.sparkSession.read.parquet
    aw, bw = (read(lake.working_table(x.join(frequent, on, "left"), "name_words")) for x in (aw, bw))

    met = aw.where("_often IS NULL").join(bw.where("_often IS NULL").drop("_often"), on)
    rare = met.groupBy(*a_key, *b_key).agg(F.first("_aw").alias("_aw"), F.first("_bw").alias("_bw"))
    rare = rare.select(*a_key, *b_key, F.size(F.array_intersect("_aw", "_bw")).alias("_both"), F.size("_aw").alias("_a"), F.size("_bw").alias("_b"))
    rare = rare.withColumns({"_rare": (F.col("_both") == F.col("_a")).cast("long"), "_class": F.lit(0).cast("long")})

    words = F.array_sort(F.collect_set("_t"))
    mine = aw.where("_often").groupBy(*a_key).agg(words.alias("_aw"), F.first(F.size("_aw")).alias("_a"))
    theirs = bw.where("_often").groupBy(*within, *b_key).agg(words.alias("_bw"), F.first(F.size("_bw")).alias("_b"))
    of_a, of_b = [*within, "_aw", "_a"], [*within, "_bw", "_b"]
    least = first_rows(theirs, of_b, [F.col(c) for c in b_key], 2).drop("rank")
    counts = theirs.groupBy(*of_b).agg(F.count("*").alias("_n"))
    pairs = mine.select(*of_a).distinct().withColumn("_t", F.explode("_aw")).join(counts.withColumn("_t", F.explode("_bw")), on)
    pairs = read(lake.working_table(pairs.groupBy(*of_a, "_bw", "_b").agg(F.count("*").alias("_both"), F.first("_n").alias("_n")), "name_classes"))
    supers = pairs.where("_both = _a").groupBy(*of_a).agg(F.sum("_n").alias("_class"))
    best = first_rows(pairs.join(least, of_b).withColumn("_score", score(F.col("_both"), F.col("_a"), F.col("_b"))), of_a, [F.desc("_score"), *(F.col(c) for c in b_key)], 2)
    best = best.join(supers, of_a, "left").select(*of_a, *b_key, F.col("_both").cast("int").alias("_both"), "_b", F.coalesce("_class", F.lit(0).cast("long")).alias("_class"))
    classes = mine.join(best, of_a).select(*a_key, *b_key, "_both", "_a", "_b", F.lit(0).cast("long").alias("_rare"), "_class")

    every = rare.unionByName(classes).groupBy(*a_key, *b_key).agg(F.max("_both").alias("_both"), F.first("_a").alias("_a"), F.first("_b").alias("_b"), F.max("_rare").alias("_rare"), F.max("_class").alias("_class"))
    total = Window.partitionBy(*a_key)
    return every.withColumn("_supers", F.sum("_rare").over(total) + F.max("_class").over(total)).drop("_rare", "_class")


def match_names(left: DataFrame, right: DataFrame, least: float = 0.72, margin: float = 0.08, often: int = OFTEN) -> DataFrame:
    """The best right name of each distinct left name by token Jaccard, its score, the runner-up's, and whether that is sure.

    Sides have a column `name`. Names without a token in common don't match. Words that many names have aren't joined on."""
    a = left.select(F.col("name").alias("l_name")).distinct().withColumn("_aw", name_tokens(F.col("l_name")))
    b = right.select(F.col("name").alias("r_name")).distinct().withColumn("_bw", name_tokens(F.col("r_name")))
    found = word_candidates(a, b, ["l_name"], ["r_name"], often=often).withColumn("score", likeness(F.col("_both"), F.col("_a"), F.col("_b")))
    same = a.join(b, (F.lower("l_name") == F.lower("r_name")) & F.arrays_overlap("_aw", "_bw")).select("l_name", "r_name", F.lit(1.0).alias("score"))
    scored = found.select("l_name", "r_name", "score").unionByName(same).groupBy("l_name", "r_name").agg(F.max("score").alias("score"))
    order = Window.partitionBy("l_name").orderBy(F.desc("score"), "r_name")
    top = scored.withColumns({"_i": F.row_number().over(order), "second": F.coalesce(F.lead("score").over(order), F.lit(0.0))}).where("_i = 1")
    return top.select(F.col("l_name").alias("name"), F.col("r_name").alias("match"), "score", "second", ((F.col("score") >= least) & (F.col("score") - F.col("second") >= margin)).alias("sure"))
