"""Exact (D1, D2) and near (D3) deduplication as Spark aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import col_of, word_tokens
from textloom.operators.setjoin import similar_texts
from textloom.session import checkpoint_dir

#: rows of a duplicate table up to which it is broadcast
BROADCAST_ROWS = 100_000


def content_hash(c):
    """md5 hex of the UTF-8 text."""
    return F.md5(col_of(c))


def dedup_exact(df: DataFrame, text_col: str = "text", partition_by=("split",),
                order_by="doc_id") -> DataFrame:
    """Keep the first row (smallest ``order_by``, one column or several
    compared left to right) per (partition, md5(text)).

    ``min_by`` over a struct of the row is a partial aggregate: duplicates
    collapse map-side before the shuffle, so a text repeated in a third of all
    rows costs one row per task, not a hot reducer."""
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    cols = df.columns
    first = F.col(order_by) if isinstance(order_by, str) else F.struct(*order_by)
    kept = (df.withColumn("_tl_h", content_hash(text_col))
            .groupBy(*partition_by, "_tl_h")
            .agg(F.min_by(F.struct(*cols), first).alias("_tl_r")))
    return kept.select("_tl_r.*")


def dedup_report(df: DataFrame, text_col: str = "text", partition_by=("split",)) -> DataFrame:
    """Rows in, unique texts, duplicates removed -- per partition."""
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    per_hash = (df.groupBy(*partition_by, content_hash(text_col).alias("_tl_h"))
                .agg(F.count(F.lit(1)).alias("_tl_c")))
    return per_hash.groupBy(*partition_by).agg(
        F.sum("_tl_c").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_unique"),
        (F.sum("_tl_c") - F.count(F.lit(1))).cast("long").alias("n_removed"))


def dedup_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
               k: int = 5, keep_all: bool = False) -> DataFrame:
    """D3: near-duplicate removal by an exact join of word ``k``-gram sets.

    Texts whose distinct ``k``-grams have a Jaccard similarity of ``threshold`` or more
    are linked (``setjoin``: no pair is missed); of every connected component the row
    with the smallest id survives.

    Returns the surviving rows, or (``keep_all``) every row with its ``cluster`` id and
    a ``duplicate`` flag.  Ids may have any type that can be ordered; a null id names a
    cluster only if no other row of it has one.  Null texts are linked with nothing,
    texts without a word with each other.  Rows equal in id and text share their fate."""
    checkpoint_dir(df.sparkSession)
    text = F.col(text_col)
    texts = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = similar_texts(texts, lambda t: F.transform(word_tokens(F.lower(t)), lambda w: F.xxhash64(w)), threshold, k)
    # only rows that are not their own cluster need a lookup
    moved = found.filter(~F.col("id").eqNullSafe(F.col("cluster"))).distinct().checkpoint(eager=True)
    moved = moved.select(F.col("id").alias("_tl_id"), F.col("text_key").alias("_tl_key"), F.col("cluster").alias("_tl_cluster"))
    if moved.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        moved = F.broadcast(moved)
    same = df[id_col].eqNullSafe(F.col("_tl_id")) & (F.xxhash64(df[text_col]) == F.col("_tl_key"))
    out = df.join(moved, same, "left")
    is_moved = F.col("_tl_key").isNotNull()
    out = out.select(*[df[c] for c in df.columns], F.when(is_moved, F.col("_tl_cluster")).otherwise(df[id_col]).alias("cluster"),
                     is_moved.alias("duplicate"))
    if keep_all:
        return out
    return out.filter(~F.col("duplicate")).drop("duplicate")
