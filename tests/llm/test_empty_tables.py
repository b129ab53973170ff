"""op6, op7 and op9 on tables without rows: no rows, by way of the files that they write; repeated ids keep every row."""

import pytest

import __spark_entry__

TABLES = {
    "op6_token_output": ("documents", "doc_id long, text string"),
    "op7_warc": ("pages", "page_id long, url string, html string"),
    "op9_topk_search": ("embeddings", "vec_id long, embedding array<float>"),
}


@pytest.mark.parametrize("query", TABLES)
def test_no_rows(spark, tmp_path, query):
    name, schema = TABLES[query]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert __spark_entry__.queries()[query](spark, str(tmp_path)).count() == 0


def test_repeated_ids_of_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "one two"), (1, "three"), (1, "one two"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(__spark_entry__.queries()["op6_token_output"](spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [1, 1, 1, 2] and rows[-1].n_tokens == 1
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(4)]
