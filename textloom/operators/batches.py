"""Consecutive batches, batch budgets and micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign_batches(df: DataFrame, batch_size: int, drop_last: bool = False,
                   index_col: str = "row_index", batch_col: str = "batch_id",
                   total: int | str | None = None) -> DataFrame:
    """``batch_id = row_index // batch_size``; ``drop_last`` removes the
    short final batch (train), otherwise it is kept (eval).  ``total`` is the
    number of rows, or the column that holds it (``with_row_index`` makes one);
    without it the rows are counted first."""
    out = df.withColumn(batch_col, F.floor(F.col(index_col) / F.lit(batch_size)).cast("long"))
    if drop_last:
        if total is None:
            total = df.agg(F.count(F.lit(1))).first()[0]
        size = F.col(total) if isinstance(total, str) else F.lit(total)
        out = out.filter(F.col(batch_col) < F.floor(size / batch_size))
    return out


def budget(subset: int, base: int, batch_size: int, eval_factor: int = 2) -> tuple[int, int]:
    """Batches to take so the sample count stays steady across batch sizes.
    Python floor division; a negative subset means "all" (-1)."""
    if subset is None or subset < 0:
        return -1, -1
    return (subset * base) // batch_size, (subset * base) // (eval_factor * batch_size)


def take_batches(df: DataFrame, n: int | None, batch_col: str = "batch_id") -> DataFrame:
    """First ``n`` batches; ``None`` or negative keeps everything."""
    if n is None or n < 0:
        return df
    return df.filter(F.col(batch_col) < F.lit(int(n)))


def micro_batches(df: DataFrame, batch_size: int, micro_size: int,
                  index_col: str = "row_index", batch_col: str = "batch_id",
                  out_col: str = "micro_id") -> DataFrame:
    """Split every batch into micro-batches of ``micro_size`` rows."""
    pos = F.col(index_col) - F.col(batch_col) * F.lit(batch_size)
    return df.withColumn(out_col, F.floor(pos / F.lit(micro_size)).cast("long"))
