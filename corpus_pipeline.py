"""Corpus pipeline: five operators of ``textloom.llm`` in a row.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; all but the last return the columns of ``documents``.  Models and
counts come from the stage's own input, labels and benchmark items from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontam, langid, packing, quality, simhash
from textloom.llm.common import read_table
from textloom.llm.queries import language_model, tokenizer_path
from textloom.session import checkpoint_dir, scratch_path, ship_package
from textloom.sources.artifacts import delete_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or score below the threshold go."""
    _ready(spark)
    return quality.keep_good(docs, quality.model(docs, read_table(spark, sf_dir, "labels")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go."""
    _ready(spark)
    return langid.keep_identified(docs, language_model(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    _ready(spark)
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    _ready(spark)
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of at most 1024 tokens, with its sequence."""
    _ready(spark)
    return packing.best_fit_pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: n-gram models, the network and the packing search have no SQL form; the
#: tests hold each stage against plain reference code instead
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    checkpoint_dir(spark)
    ship_package(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; a
    stage's table goes when the next one is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
