"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import checkpoint_dir

#: rows up to which a counted table is broadcast
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``rows`` rows (stops counting there)."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a counted bound; beyond it Spark shuffles
    both sides and its skew join splits hot keys."""
    return F.broadcast(df) if small_enough(df, rows) else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
        taken.add(n.lower())
    return out


def row_slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that what goes back to the JVM at once is small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def word_blocks(data: bytes, keep: int = 0, block: int = 1 << 20) -> Iterator[tuple[list[bytes], bool]]:
    """Words (runs without ASCII white space) of a text in bounded blocks.

    Yields ``(words, first)``; every block after the first begins with the last
    ``keep`` words of what came before, so n-grams of ``keep + 1`` words never
    get lost at a cut and none is seen twice."""
    if len(data) <= block:
        yield data.split(), True
        return
    at, tail, first = 0, [], True
    while at < len(data):
        end = min(at + block, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = tail + data[at:end].split()
        at = end
        if first and len(words) <= keep and at < len(data):
            tail = words  # too few words yet: read on
            continue
        if len(words) > len(tail) or first:
            yield words, first
            first = False
        tail = words[-keep:] if keep else []
