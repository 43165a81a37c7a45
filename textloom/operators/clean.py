"""Document-level cleaning: split (C6), ordered concatenation (C7),
normalisation (C8), preview (C9), and the batch-map surface (U1-U3)."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import col_of, normalize_text_col
from textloom.operators.order import with_row_index

TALE_BREAK = r"\n{4,}"


def split_docs(df: DataFrame, text_col: str = "text", pattern: str = TALE_BREAK,
               piece_col: str = "piece_idx", out_col: str | None = None,
               drop_empty: bool = True) -> DataFrame:
    """One text -> one row per piece between matches of ``pattern``.
    Empty pieces are dropped (not blindly the last one)."""
    out_col = out_col or text_col
    exploded = df.select(*[c for c in df.columns if c != text_col],
                         F.posexplode(F.split(F.col(text_col), pattern, -1))
                         .alias(piece_col, out_col))
    exploded = exploded.withColumn(piece_col, F.col(piece_col).cast("long"))
    if drop_empty:
        exploded = exploded.filter(F.length(out_col) > 0)
    return exploded


def concat_docs(df: DataFrame, group_cols, order_col: str, text_col: str = "text",
                sep: str = "", out_col: str = "text") -> DataFrame:
    """Texts of each group joined in ``order_col`` order.

    Meant for bounded groups (the turns of one conversation).  For a whole
    corpus use ``pack_eos`` instead: it never builds one giant row."""
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("k"),
                                                   F.col(text_col).alias("v"))))
    return df.groupBy(*group_cols).agg(
        F.array_join(F.transform(ordered, lambda s: s["v"]), sep).alias(out_col))


def normalize_text(df: DataFrame, text_col: str = "text", lower: bool = True,
                   strip_accents: bool = True, out_col: str | None = None) -> DataFrame:
    """NFD, optional lower-case, optional removal of combining marks."""
    return df.withColumn(out_col or text_col,
                         normalize_text_col(F.col(text_col), lower, strip_accents))


DEFAULT_RANGES = ((0, 20), (150, 165))


def preview_lines(df: DataFrame, text_col: str = "text", ranges=DEFAULT_RANGES,
                  id_cols=("doc_id",)) -> DataFrame:
    """The lines of each text whose 0-based number falls in ``ranges``."""
    lines = df.select(*id_cols, F.posexplode(F.split(F.col(text_col), "\n", -1))
                      .alias("line_no", "line"))
    cond = None
    for lo, hi in ranges:
        c = F.col("line_no").between(lo, hi)
        cond = c if cond is None else cond | c
    return lines.filter(cond).withColumn("line_no", F.col("line_no").cast("long"))


def preview_edges(df: DataFrame, text_col: str = "text", max_chars: int = 300) -> DataFrame:
    """First and last ``max_chars`` characters of every text."""
    t = F.col(text_col)
    return df.withColumn("head", F.substring(t, 1, max_chars)).withColumn(
        "tail", F.when(F.length(t) <= max_chars, t).otherwise(F.substring(t, -max_chars, max_chars)))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                batch_size: int | None = None, order_by=None) -> DataFrame:
    """Apply ``fn`` to pandas batches; it may return any number of rows.

    With ``batch_size`` and ``order_by`` (a unique key) batch ``b`` holds exactly the
    rows ``b * batch_size ... (b + 1) * batch_size - 1`` of that order, whatever the
    files and partitions are; only the last batch is shorter.  The rows of a batch
    come in order, and batches are spread over tasks.

    With ``batch_size`` alone the Arrow batches of a task are re-cut into exactly
    ``batch_size`` rows, but they end at partition boundaries; no row moves."""
    if order_by is not None:
        if not batch_size:
            raise ValueError("order_by needs a batch_size")
        columns = df.columns
        numbered = with_row_index(df, order_by, "_tl_row")
        numbered = numbered.withColumn("_tl_batch", F.floor(F.col("_tl_row") / batch_size))
        return numbered.groupBy("_tl_batch").applyInPandas(
            lambda pdf: fn(pdf.sort_values("_tl_row")[columns].reset_index(drop=True)), schema)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not batch_size:
            for pdf in it:
                yield fn(pdf)
            return
        buf: list[pd.DataFrame] = []
        held = 0
        for pdf in it:
            buf.append(pdf)
            held += len(pdf)
            while held >= batch_size:
                whole = pd.concat(buf, ignore_index=True)
                yield fn(whole.iloc[:batch_size].reset_index(drop=True))
                rest = whole.iloc[batch_size:].reset_index(drop=True)
                buf, held = [rest], len(rest)
        if held:
            yield fn(pd.concat(buf, ignore_index=True))

    return df.mapInPandas(run, schema)


def select_columns(df: DataFrame, cols) -> DataFrame:
    """U2 (keep)."""
    return df.select(*[col_of(c) for c in cols])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """U2 (remove)."""
    return df.drop(*cols)


def reshard(df: DataFrame, n: int, *keys) -> DataFrame:
    """``n`` parallel shards (hash on ``keys`` when given, else round-robin)."""
    return df.repartition(n, *keys) if keys else df.repartition(n)
