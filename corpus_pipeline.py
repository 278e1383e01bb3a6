"""The corpus preparation pipeline: each stage works on all that its
predecessor kept, and its decisions take effect on the rows it returns.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are
written as Parquet in the shared checkpoint folder and reread as the next
stage's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import materialize, read_table
from tideline.llm.exact_dedup import drop_exact_copies
from tideline.llm.packing import pack
from tideline.llm.simhash import drop_near_copies
from tideline.llm.suffix_dedup import drop_repeats
from tideline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.7)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return drop_exact_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (the smallest doc_id)."""
    return drop_near_copies(docs, shingle=4, distance=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start anywhere else are cut out of the texts;
    every document stays, with what is left of it."""
    return drop_repeats(docs, window=200)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048 ids with their sequence and offset."""
    return pack(docs, capacity=2048)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("best_fit_packing", packing),
]

#: Toxicity, SimHash and suffix stages cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
