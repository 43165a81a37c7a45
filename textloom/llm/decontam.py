"""Benchmark decontamination with DataFrame functions only.

Benchmark texts become windows of ``n`` consecutive normalised words (an item
with fewer words is one shorter window).  The distinct windows are a hash table,
broadcast behind a counted bound; every training text is scanned in one pass
(word array -> one 64-bit hash per window -> hash join), each hash hit is
verified on the words themselves, and one row per text plus its hits is
regrouped.  Nothing else is shuffled: texts stay where they were read.

Beyond the bound the same join is a shuffle join on the window hash, whose
skewed partitions Spark splits.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed, free_names, maybe_broadcast

WINDOW = 10
#: (window, item) pairs up to which the window table is broadcast
MAX_BROADCAST_WINDOWS = 2_000_000

# fixed value: word characters are 0-9, a-z (after lower-casing A-Z) and everything from U+0080
_KEPT = string.digits + string.ascii_letters
_BREAKS = "".join(chr(i) for i in range(128) if chr(i) not in _KEPT)


def words_of(text: Column) -> Column:
    """Array of normalised words; null or wordless text gives an empty array."""
    spaced = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + _BREAKS,
                         string.ascii_lowercase + " " * len(_BREAKS))
    return F.array_remove(F.split(spaced, " "), "")


def _window_hashes(words: Column, n_words: Column, k: int) -> Column:
    starts = F.sequence(F.lit(1), n_words - F.lit(k - 1))
    return F.when(n_words >= k, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(k))))
                  ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """Distinct windows: ``_h`` hash, ``_k`` words, ``_w`` the words, ``_items``
    the ids (as strings) of the items that hold it; a null id names no item."""
    b = benchmark.select(F.col(id_col).cast("string").alias("_item"),
                         words_of(F.col(text_col)).alias("_words"))
    b = b.withColumn("_n", F.size("_words")).filter("_n > 0").withColumn("_k", F.least("_n", F.lit(n)))
    w = b.select("_item", "_k", "_words",
                 F.explode(F.sequence(F.lit(1), F.col("_n") - F.col("_k") + 1)).alias("_i"))
    w = w.select("_item", "_k", F.slice("_words", F.col("_i"), F.col("_k")).alias("_w"))
    return (w.groupBy("_w", "_k").agg(F.collect_set("_item").alias("_items"))
            .withColumn("_h", F.xxhash64("_w")))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text",
                  max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``spans`` (array of
    ``(start, length)`` in words, from 0), ``items`` (sorted item ids as
    strings) and ``text_key`` (hash of the text, which with the id names equal
    rows).

    Null text has no words; repeated rows each give a row; an empty benchmark
    or table gives no hits or no rows.  Only the named columns are read."""
    windows = checkpointed(benchmark_windows(benchmark, n, item_col, item_text_col))
    sizes = [r[0] for r in windows.select("_k").distinct().orderBy("_k").collect()]  # at most n values
    pairs = windows.select(F.explode_outer("_items"))
    table = windows if not _within(pairs, max_broadcast) else F.broadcast(windows)
    d = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                    F.monotonically_increasing_id().alias("_row"), words_of(F.col(text_col)).alias("_words"))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    # place 0 marks the text itself, so texts without a hit keep a row
    arrays = [_window_hashes(F.col("_words"), F.size("_words"), k) for k in sizes]
    d = d.select("*", F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), *arrays)).alias("_at", "_h"))
    j = d.join(table, "_h", "left")
    before = reduce(lambda acc, k: acc + F.when(F.col("_k") > k, F.greatest(
        F.col("n_words") - (k - 1), F.lit(0))).otherwise(F.lit(0)), sizes, F.lit(0))
    start = (F.col("_at") - 1 - before).cast("int")
    j = j.withColumn("_start", F.when(F.col("_k").isNotNull(), start))
    hit = F.col("_k").isNotNull() & (F.slice("_words", F.col("_start") + 1, F.col("_k")) == F.col("_w"))
    hit = F.coalesce(hit, F.lit(False))
    j = j.filter((F.col("_at") == 0) | hit).select(
        "_id", "text_key", "_row", "n_words",
        F.when(hit, F.struct(F.col("_start").alias("start"), F.col("_k").alias("length"))).alias("_span"),
        F.when(hit, F.col("_items")).alias("_items"))
    g = j.groupBy("_id", "text_key", "_row", "n_words").agg(
        F.sort_array(F.collect_list("_span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("items"))
    return g.select(F.col("_id").alias(id_col), "n_words", "spans", "items", "text_key")


def _within(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def hit_words(spans: Column) -> Column:
    """Sorted distinct positions of the words inside any span."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", n: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, without contaminated documents
    (``mode='document'``) or without the hit words (``mode='span'``).

    Decisions are made row by row; rows with equal id and text share theirs.
    In span mode the breaks around removed words stay."""
    if mode not in ("document", "span"):
        raise ValueError(f"unknown mode {mode}")
    found = contamination(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    row, key, cut = free_names(docs, "_id", "_key", "_spans")
    found = found.filter(F.size("spans") > 0).select(
        F.col(id_col).alias(row), F.col("text_key").alias(key),
        *([F.col("spans").alias(cut)] if mode == "span" else []))
    found = checkpointed(found.dropDuplicates([row, key]))
    lookup = maybe_broadcast(found)
    on = docs[id_col].eqNullSafe(F.col(row)) & (F.xxhash64(docs[text_col]) == F.col(key))
    if mode == "document":
        return docs.join(lookup, on, "left_anti")
    j = docs.join(lookup, on, "left")
    text = F.when(F.col(cut).isNull(), docs[text_col]).otherwise(without_words(docs[text_col], F.col(cut)))
    return j.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])


# fixed value: a run of word characters of either case, or a run of breaks
_RUNS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BREAK_START = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def without_words(text: Column, spans: Column) -> Column:
    """The text without its words inside ``spans``; breaks stay as they are."""
    # runs alternate, so the place of a run's word follows from its index and the first run's kind
    runs = F.regexp_extract_all(text, F.lit(f"({_RUNS})"), F.lit(1))
    lead = F.when(text.rlike(_BREAK_START), F.lit(1)).otherwise(F.lit(0))
    gone = hit_words(spans)
    return F.array_join(F.filter(runs, lambda r, i: ~(
        ((i - lead) % 2 == 0) & F.array_contains(gone, ((i - lead) / 2).cast("int")))), "")
