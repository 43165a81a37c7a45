"""Text-file sources: delimiter-framed corpora (S1), byte repair (S3),
whole-file reads (S4), and in-memory records (S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import (EOT, decode_cp1252, trim_chars, universal_newlines,
                                     col_of)

RECORD_ORDER = ["src_file", "src_block", "src_seq"]


def read_delimited_docs(spark: SparkSession, paths, delim: str = EOT, repair_bytes: bool = True,
                        trim: str = " \n", drop_empty: bool = True,
                        drop_unterminated: bool = False) -> DataFrame:
    """Records end at ``delim`` wherever it sits in a line.

    Uses the text source's multi-character ``lineSep``, so files stay
    splittable: a split reader starts at the first delimiter after its start
    offset, exactly like line records.  Every delimiter ends a record (no
    parts are lost when two delimiters share a line), the text after the last
    delimiter is a record of its own, and empty records are dropped.

    Output: ``text`` plus ``src_file, src_block, src_seq`` which order the
    records in file order (split start offset, then ordinal inside the split).
    ``drop_unterminated`` leaves out what follows a file's last delimiter.
    """
    if isinstance(paths, str):
        paths = [paths]
    raw = (spark.read.text(paths, lineSep=delim)
           .select(F.col("value"),
                   F.col("_metadata.file_path").alias("src_file"),
                   F.col("_metadata.file_block_start").alias("src_block"),
                   F.monotonically_increasing_id().alias("src_seq"),
                   F.col("_metadata.file_size").alias("_tl_size")))
    if drop_unterminated:
        # a file whose records and delimiters add up to more than its size has
        # no delimiter after its last record
        n = len(delim.encode())
        open_ended = (raw.groupBy("src_file").agg(
            F.sum(F.octet_length("value") + n).alias("_tl_n"), F.max("_tl_size").alias("_tl_size"),
            F.max(F.struct("src_block", "src_seq")).alias("_tl_last")).filter("_tl_n > _tl_size")
            .select("src_file", "_tl_last.src_block", "_tl_last.src_seq"))
        raw = raw.join(open_ended, RECORD_ORDER, "left_anti")
    text = F.col("value")
    if repair_bytes:
        text = decode_cp1252(text.cast("binary"))
    text = trim_chars(universal_newlines(text), trim)
    out = raw.select(text.alias("text"), *RECORD_ORDER)
    if drop_empty:
        out = out.filter(F.length("text") > 0)
    return out


def write_delimited(df: DataFrame, path: str, text_col: str = "text", delim: str = EOT,
                    mode: str = "overwrite") -> None:
    """Sink counterpart of S1: one record per row, each followed by ``delim``."""
    df.select(col_of(text_col).alias("value")).write.mode(mode).option(
        "lineSep", delim).text(path)


def decode_repair(df: DataFrame, bytes_col: str, out_col: str = "text") -> DataFrame:
    """S3: windows-1252 decode that keeps undefined bytes, then universal newlines."""
    return df.withColumn(out_col, universal_newlines(decode_cp1252(F.col(bytes_col))))


def read_whole_docs(spark: SparkSession, paths) -> DataFrame:
    """Every file is one string row (to be cut by ``split_docs``)."""
    if isinstance(paths, str):
        paths = [paths]
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("src_file"), F.col("value").alias("text")))


def read_tales(spark: SparkSession, paths, sep: str = "\n\n\n\n") -> DataFrame:
    """Pieces between runs of four or more newlines, in file order: the same as
    cutting whole files, but files stay splittable and no row holds one."""
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.text(paths, lineSep=sep).select(
        # a run longer than the separator leaves newlines at the next piece's start
        F.regexp_replace("value", "^\n+|\n+$", "").alias("text"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"))
    return raw.filter(F.length("text") > 0)


def from_records(spark: SparkSession, columns: dict, schema: T.StructType | str | None = None
                 ) -> DataFrame:
    """Dict of equal-length column lists -> DataFrame.

    A bare string value is rejected: it would otherwise become one row per
    character.
    """
    names = list(columns)
    for k, v in columns.items():
        if isinstance(v, (str, bytes)) or not hasattr(v, "__len__"):
            raise TypeError(f"column {k!r} must be a list of values, got {type(v).__name__}")
    lengths = {len(v) for v in columns.values()}
    if len(lengths) > 1:
        raise ValueError(f"columns have different lengths: {sorted(lengths)}")
    rows = list(zip(*[columns[k] for k in names]))
    if schema is None:
        return spark.createDataFrame(rows, names)
    return spark.createDataFrame(rows, schema)
