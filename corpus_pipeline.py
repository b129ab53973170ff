"""From raw documents to token files: quality, near duplicates, benchmark passages, mixing, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratesmith.llm.common import forget, saved, spread_join, table, work_path
from ratesmith.llm.decontaminate import decontaminate
from ratesmith.llm.jaccard_join import linked_sets
from ratesmith.llm.mixing import mix
from ratesmith.llm.quality import select_documents
from ratesmith.llm.token_output import read_tokens, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling selects."""
    return select_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts whose five-word shingles have a Jaccard similarity of 0.8 or more: that of the least doc_id.
    Of rows with one doc_id each is judged by its own text; equal texts of one doc_id stay once. Rows without doc_id stay."""
    known = docs.where("doc_id IS NOT NULL").withColumn("_text_hash", F.xxhash64("text"))
    linked = saved(linked_sets(known.select("doc_id", "_text_hash", "text"), k=5, percent=80), "near_duplicates")
    mine = F.struct("doc_id", "_text_hash")
    least = linked.where("component IS NOT NULL").groupBy("component").agg(F.min(mine).alias("least"), F.count("*").alias("n_rows"))
    met = spread_join(linked, least, "component", linked.count())
    gone = saved(met.where(mine != F.col("least")).select("doc_id", "_text_hash").distinct(), "near_duplicates")
    forget(linked)
    again = F.row_number().over(Window.partitionBy("doc_id", "_text_hash").orderBy(F.xxhash64(*docs.columns)))
    rows = known.join(gone, ["doc_id", "_text_hash"], "left_anti").withColumn("_again", again).where("_again = 1")
    return rows.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; those that are mostly such passages go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("cleaned IS NOT NULL OR text IS NULL")
    changed = F.col("n_hit") > 0
    found = found.withColumns({"text": F.when(changed, F.col("cleaned")).otherwise(F.col("text")), "n_chars": F.when(changed, F.char_length("cleaned").cast("long")).otherwise(F.col("n_chars"))})
    return found.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once or twice, so that sources come nearer to each other and none loses a document."""
    return mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token files, read back from them."""
    path = work_path(spark, "tokens")
    write_tokens(docs, path)
    return read_tokens(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", tokens),
]

#: SQL can't express the tokenizer and the seeded samples; tests/llm/test_pipeline_plain.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table of documents, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
