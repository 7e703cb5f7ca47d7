"""Corpus pipeline: toxicity, n-gram Jaccard join, substring dedup, benchmark decontamination, mixing.

Each stage is a function of (spark, docs, sf_dir) on the documents its predecessor kept; its result is written as Parquet
and read again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoweave.llm import decontaminate, mixture, ngram_join, substring_dedup, toxicity
from chronoweave.llm.scratch import Scratch, row_id, sendable
from chronoweave.session import ship_package


def without(docs: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents whose row (rid, a hash of id and text) is not among ``rows``; few (a checked number) go to every task, more
    through a shuffle. The columns travel in one struct, so that no name can clash."""
    whole = docs.select(row_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.join(sendable(scratch.save(rows.select("rid").distinct())), "rid", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score, of the text alone, reaches the threshold.

    Null and empty texts score like texts without evidence; equal texts go or stay together; very long texts are scored whole.
    All columns pass, whatever their names; no rows give no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    index = toxicity.fit(docs, labels)
    return toxicity.keep_clean(docs, index, toxicity.THRESHOLD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group linked by five-word shingles at Jaccard 0.8.

    A document without words, or without an id, is a group of its own; rows that repeat a kept row's id stay with it. Texts
    are compared whole, of any length. All columns pass, whatever their names; no rows give no rows.
    """
    scratch = Scratch(spark)
    groups = ngram_join.similar_documents(docs, scratch, k=5, percent=80)
    return without(docs, groups.where("doc_id <> component_id"), scratch)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that stand in an earlier document (smaller doc_id, a null one last).

    Null, empty and short texts and rows without a repeated passage are unchanged; a row that loses all its words goes; equal
    rows are treated alike; texts are read whole. All columns pass, whatever their names; no rows give no rows.
    """
    return substring_dedup.remove_passages(docs, Scratch(spark))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null and empty texts or items match nothing; a repeated row goes with its equal; texts are read whole, of any length. All
    columns pass, whatever their names; no rows, or an empty benchmark, drop nothing.
    """
    rows = docs.select(row_id().alias("doc_id"), "text")
    leaks = decontaminate.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, leaks.select(F.col("doc_id").alias("rid")), Scratch(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: one row for each document, null and empty texts with 0 words.

    Repeated rows are documents of their own; a null source is a source; texts count whole. Columns other than doc_id, text
    and source are left out; no rows give no rows.
    """
    return mixture.mix_sources(docs.select("doc_id", "text", "source"), Scratch(spark))[0]


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", drop_passages),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix),
]
#: Nearest neighbours, MinHash and SimHash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    ship_package(spark)
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
