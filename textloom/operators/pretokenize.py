"""Pre-tokenisation and the corpus word-count pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import byte_level_tokens, word_tokens


def pretokenize_words(df: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                      pos_col: str = "pos", word_col: str = "word") -> DataFrame:
    """One row per whitespace-pre-tokenizer piece, with its position."""
    return (df.select(*id_cols, F.posexplode(word_tokens(F.col(text_col))).alias(pos_col, word_col))
            .withColumn(pos_col, F.col(pos_col).cast("long")))


def pretokenize_bytes(df: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                      pos_col: str = "pos", piece_col: str = "piece") -> DataFrame:
    """Byte-level pieces (leading space kept with the word) and their
    UTF-8 bytes as lower-case hex."""
    out = df.select(*id_cols, F.posexplode(byte_level_tokens(F.col(text_col)))
                    .alias(pos_col, piece_col))
    return (out.withColumn(pos_col, F.col(pos_col).cast("long"))
            .withColumn("hex", F.lower(F.hex(F.encode(F.col(piece_col), "UTF-8")))))


def word_counts(df: DataFrame, text_col: str = "text", level: str = "words",
                word_col: str = "word", count_col: str = "freq") -> DataFrame:
    """Piece -> corpus frequency (partial aggregation; the only
    corpus-sized step of tokenizer training)."""
    toks = word_tokens(F.col(text_col)) if level == "words" else byte_level_tokens(F.col(text_col))
    return (df.select(F.explode(toks).alias(word_col))
            .groupBy(word_col).agg(F.count(F.lit(1)).cast("long").alias(count_col)))
