"""A training-data pipeline over documents: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontaminate, languages, minhash, raking, substrings
from daybook.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: A document whose languages gain less per n-gram over equally likely ones is rejected.
MIN_FIT = 0.0


def row_key() -> Column:
    """A row by its id and text, for rows without an id and ids with several texts."""
    return F.xxhash64("doc_id", "text")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose row_key stands in gone as doc_id. A row travels as one
    column, so no name of it can clash."""
    whole = docs.select(F.struct("*").alias("doc"), row_key().alias("row"))
    rest = whole.join(gone.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti")
    return rest.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that no language fits: junk in
    letters and languages the model never saw. The model learns from all documents with
    a language; lang is kept as it is.

    Rows without a doc_id are judged by their text; rows of one id and text alike.
    """
    model = languages.train(docs.select("text", "lang"))
    judged = languages.predict(docs.select(row_key().alias("doc_id"), "text"), model)
    return without(docs, judged.where((F.col("lang_pred") == languages.UNKNOWN) | (F.col("fit") < MIN_FIT)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group. Rows
    without a doc_id or without words are in no group and stay."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words or more that stand anywhere else too; every document
    stays, with what is left of its text."""
    return substrings.without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, decontaminate.contaminated(docs.select(row_key().alias("doc_id"), "text"), benchmark).where("contaminated"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that token mass meets the target shares of source, language
    and topic; adds topic, n_words and keep_chance."""
    return raking.sampled(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
]

#: The stages learn models, hash and iterate; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
