"""Every catalogue query against its SQL, on the small tables."""

import duckdb
import pytest

from ratesmith.plans import catalogue

DIR = "/root/testdata/sf0.001"
#: Contracts have enough codes for an offset in larger tables only.
LARGER = {"gold_offsets": "/root/testdata/sf0.01"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    def connected(folder):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        return con

    return {folder: connected(folder) for folder in {DIR, *LARGER.values()}}


def text(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_same_rows(spark, duck, name):
    folder = LARGER.get(name, DIR)
    df = catalogue.QUERIES[name](spark, folder)
    found, columns = df.collect(), sorted(df.columns)
    ran = duck[folder].execute(catalogue.ORACLES[name])
    names = [x[0] for x in ran.description]
    assert columns == sorted(names)
    want = sorted(tuple(text(r[names.index(c)]) for c in columns) for r in ran.fetchall())
    assert sorted(tuple(text(r[c]) for c in columns) for r in found) == want
    assert want


def test_catalogue_has_an_oracle_each():
    assert catalogue.QUERIES.keys() == catalogue.ORACLES.keys()
