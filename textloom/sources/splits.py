"""Tables with named splits, persisted partitioned by split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_split(df: DataFrame, id_col: str = "doc_id", valid_every: int = 10,
               split_col: str = "split") -> DataFrame:
    """Deterministic train/validation assignment: ``id % valid_every == 0`` -> validation."""
    return df.withColumn(split_col, F.when(F.pmod(F.col(id_col), F.lit(valid_every)) == 0,
                                           F.lit("validation")).otherwise(F.lit("train")))


def read_labelled(spark: SparkSession, source, splits=None, split_col: str = "split",
                  columns=None) -> DataFrame:
    """Read a table with named splits; ``splits`` filters (prunes partitions)."""
    df = spark.read.parquet(source) if isinstance(source, str) else source
    if splits is not None:
        if isinstance(splits, str):
            splits = [splits]
        df = df.filter(F.col(split_col).isin(*splits))
    if columns is not None:
        df = df.select(*columns)
    return df


def save_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite"
                ) -> None:
    """Write one folder per split (partition pruning on read)."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def load_splits(spark: SparkSession, path: str, splits=None, split_col: str = "split"
                ) -> DataFrame:
    return read_labelled(spark, path, splits=splits, split_col=split_col)
