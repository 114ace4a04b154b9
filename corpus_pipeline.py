"""A training corpus from raw documents: quality, near duplicates, repeated passages, benchmark passages, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes and reads again. All but the last return the
columns of documents; the last adds what the mix takes.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenorbook.llm import decontamination, mixing, ngram_join, quality, substring_dedup  # noqa: E402
from tenorbook.llm.common import read, shared_folder  # noqa: E402
from tenorbook.ship import ship  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject; the model learns from `labels`."""
    ship(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: the one with the least doc_id."""
    ship(spark)
    return ngram_join.keep_one(docs)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated passages; documents stay, n_chars follows the text."""
    ship(spark)
    return substring_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by `benchmark`."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with their size in words and the number of words the mix takes, repeats counted."""
    return mixing.chosen(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near duplicates", one_of_each),
    ("repeated passages", without_passages),
    ("decontamination", clean_of_benchmarks),
    ("mix", mixed),
]

#: The quality model and the mix cannot be said in SQL; tests hold keep_one, dedupe and contamination against brute force on small
#: tables with null and repeated ids, and the words of chosen() by source against those of mix(). Of the stages in a row only columns and row counts are tested.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/tenorbook-stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
