"""Loading the driver tables with the split assignment used throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.session import checkpoint_dir
from textloom.sources.artifacts import delete_path
from textloom.sources.splits import with_split

TEXT_TABLES = ("documents", "conversations", "pages", "benchmark")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over every core when it has fewer partitions than the
    default parallelism (a single-row-group file is one task).  Large inputs
    already have many splits and are returned untouched: no extra shuffle."""
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    # text rows are CPU-heavy (regex, hashing, Python encoders): use all cores
    return spread(df) if name in TEXT_TABLES else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with ``split``: ``doc_id % 10 == 0`` -> validation."""
    return with_split(table(spark, sf_dir, "documents"), "doc_id")


def settled(df: DataFrame, *scratch: str) -> DataFrame:
    """A small result, checkpointed, so that the scratch folders it was read from can go."""
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    for path in scratch:
        delete_path(df.sparkSession, path)
    return out
