"""Collocations against a plain count, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from ratesmith.llm import phrases


def plain(rows, longest, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    long = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = {(lang, w[i:j]) for (lang, w), a in long.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and f[lang, w[i:j]] == a}
    out = defaultdict(list)
    for (lang, w), a in long.items():
        if (lang, w) not in inside:
            score, cut = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]]))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top], 1))


def run(spark, rows, longest=5, least=100, top=2000):
    df = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, k int, phrase string").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(df, longest, least, top).collect())


@pytest.mark.parametrize("slice_bytes", [200, 1 << 20])
def test_collocations_as_counted_plainly(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(phrases, "SLICE", slice_bytes)
    monkeypatch.setattr(phrases, "BUCKET", 500)
    rng = random.Random(1)
    fixed = ["new york city", "the state of the art", "a b", "x x x x x x x", "é ß"]
    text = lambda: "".join(rng.choice([*fixed, *"abcdef", "The", "of", "élan"]) + rng.choice([" "] * 8 + ["\t ", ". ", ",", "\n", "\x0b", "? "]) for _ in range(rng.randint(1, 60)))
    rows = [(rng.choice(["en", "en", "en", "fr", None, "und"]), text()) for _ in range(150)] + [("en", None), (None, None), ("de", ""), ("de", " . , "), ("xx", "only these words"), ("en", "word " * 3000)]
    want = plain(rows, 5, 6, 25)
    assert len({x[0] for x in want}) == 3 and run(spark, rows, 5, 6, 25) == want
    assert run(spark, rows, 3, 2, 10_000) == plain(rows, 3, 2, 10_000)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [("en", None), (None, "")], least=1) == []


def test_products_over_64_bits(spark):
    from pyspark.sql import functions as F

    big = spark.range(1).select(F.lit(10**13).cast("decimal(20,0)").alias("a"), F.lit(10**14).cast("decimal(20,0)").alias("n"))
    got = big.select(F.expr("(cast(a * 1000 as decimal(18,0)) * n) div (a * cast(3 as decimal(20,0)))").alias("x")).first().x
    assert got == 1000 * 10**13 * 10**14 // (3 * 10**13)


def test_query_and_sql_agree(spark):
    d = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in phrases.op13_phrase_collocations(spark, d).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    assert got == sorted(con.sql(phrases.ORACLE["op13_phrase_collocations"]).fetchall()) and got
