"""Lists of keys replaced by what a table holds for them, without a row per key.

A token stream has many more rows than its texts, so exploding, sorting and regrouping
it costs a multiple of the input.  Here a list stays in its row: an Arrow function looks
its keys up in the ``hot`` part of the table (bounded, broadcast).  Keys that are not
there leave a gap; only these become rows, join the whole table by shuffle and go back
into their gaps.  A table that is ``hot`` as a whole moves nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import checkpoint_dir

ROW = "_tl_row"


class HotTable:
    """``key`` -> list of ``values``; two more entries, for null keys (nothing) and for
    keys that are not there (``missing``), can be addressed from the end."""

    def __init__(self, found: pa.Table, missing: list):
        self.keys = found.column("key").combine_chunks()
        lists = found.column("values").combine_chunks()
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        self.values = pa.concat_arrays([lists.flatten(), pa.array(missing, lists.type.value_type)])
        self.sizes = np.concatenate([sizes, [0, len(missing)]]).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def places(self, keys: pa.Array) -> np.ndarray:
        """-1: not there, -2: null."""
        coded = keys.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.keys).fill_null(-1).to_numpy(zero_copy_only=False)
        codes = coded.indices.fill_null(len(at)).to_numpy(zero_copy_only=False)
        return np.append(at, -2)[codes]

    def of(self, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All values in a row, and where those of each place end (from 0)."""
        sizes = self.sizes[places]
        ends = np.append(0, np.cumsum(sizes))
        index = np.arange(ends[-1]) + np.repeat(self.starts[places] - ends[:-1], sizes)
        return self.values.take(pa.array(index)), ends


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where the lists end (from 0) among all their entries; null lists have none."""
    return np.append(0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)))


def _whole(table):
    def run(lists: pa.Array) -> pa.Array:
        at = _bounds(lists)
        values, ends = table.value.of(table.value.places(lists.flatten()))
        return _lists(ends[at], values)
    return run


def _with_gaps(table):
    def run(lists: pa.Array) -> pa.Array:
        at, keys = _bounds(lists), lists.flatten()
        places = table.value.places(keys)
        values, ends = table.value.of(places)
        cold = np.flatnonzero(places == -1)
        # a part begins with its row and after each gap
        order = np.argsort(np.concatenate([2 * at[:-1], 2 * cold + 1]), kind="stable")
        begins = ends[np.concatenate([at[:-1], cold])[order]]
        parts = _lists(np.append(begins, ends[-1]), values)
        first = np.empty(len(order), np.int64)
        first[order] = np.arange(len(order))
        rows = _lists(np.append(first[:len(at) - 1], len(order)), parts)
        gaps = _lists(np.searchsorted(cold, at), keys.take(pa.array(cold)))
        return pa.StructArray.from_arrays([rows, gaps], ["parts", "cold"])
    return run


def replace_keys(df: DataFrame, keys: Column, out_col: str, hot: DataFrame, cold: DataFrame | None = None,
                 missing=(), keep=None) -> DataFrame:
    """``df`` (its columns ``keep``, default all) with ``out_col``: the values of every
    key of the list ``keys``, in order.

    ``hot(key, values)`` is collected and must be bounded; ``cold(key, values)`` has all
    keys (None: ``hot`` has).  Keys of neither give ``missing``, null keys and lists
    nothing.  Columns that are kept are checkpointed when there is ``cold``: texts and
    lists of keys take several times the room of their values."""
    keep = df.columns if keep is None else list(keep)
    spark = df.sparkSession
    kinds = dict(hot.dtypes)
    key, value = kinds["key"], kinds["values"]
    gaps = cold is not None
    table = spark.sparkContext.broadcast(HotTable(hot.select("key", "values").toArrow(), [] if gaps else list(missing)))
    if not gaps:
        return df.select(*keep, F.arrow_udf(_whole(table), value)(keys).alias(out_col))
    checkpoint_dir(spark)
    # read twice, so the numbers of the rows must stay
    units = F.arrow_udf(_with_gaps(table), f"struct<parts:array<{value}>,cold:array<{key}>>")(keys)
    coded = df.select(*keep, F.monotonically_increasing_id().alias(ROW), units.alias("_tl_u")).checkpoint(eager=True)
    other = F.array(*map(F.lit, missing)).cast(value)
    asked = coded.select(ROW, F.posexplode("_tl_u.cold").alias("pos", "key"))
    found = asked.join(cold.select("key", "values"), "key", "left").groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("values", other).alias("v")))).alias("_tl_g"))
    filled = F.zip_with("_tl_u.parts", F.coalesce("_tl_g.v", F.array().cast(f"array<{value}>")),
                        lambda part, v: F.concat(part, F.coalesce(v, F.array().cast(value))))
    return coded.join(found, ROW, "left").withColumn(out_col, F.flatten(filled)).drop(ROW, "_tl_u", "_tl_g")
