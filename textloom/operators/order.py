"""B1/B2: positional addressing and reproducible shuffles without a
single-partition window.

``with_row_index`` gives each row its dense 0-based position in a total
order, plus optional exclusive prefix sums ("running totals") of numeric
columns.  It never sorts all rows in one task:

* numeric leading key: range buckets come from ``approxQuantile`` bounds
  (collected: one number per bucket), rows are bucketed by a JVM binary
  search (``Bucketizer``), bucket sizes/sums come from a partial aggregate
  (one row per bucket), and positions inside a bucket from a window
  partitioned by the bucket.  Every step is a pure function of the data, so a
  lost executor recomputes the same positions.
* any other key: splitters are whole keys (structs of all order columns) from a
  sample by hash of the key, so ties on the leading column cannot fill a bucket;
  rows find their bucket by a binary search among the splitters (keys of types whose
  order Python does not share compare with a coarse set, then with the fine ones of
  one part).  Both are pure functions of the data too, nothing is checkpointed.

The order columns must form a unique key (add a tie-breaker such as an id).
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import checkpoint_dir

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _bucket_count(df: DataFrame, num_buckets: int | None) -> int:
    if num_buckets:
        return int(num_buckets)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bucketize(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    if len(order_by) > 1 or not isinstance(df.schema[order_by[0]].dataType, _NUMERIC):
        return _splitter_buckets(df, order_by, n)
    from pyspark.ml.feature import Bucketizer

    key = order_by[0]
    probs = [i / n for i in range(1, n)]
    bounds = df.approxQuantile(key, probs, 1.0 / (4 * n)) if n > 1 else []
    splits = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
    if len(splits) < 3:
        return df.withColumn("_tl_bucket", F.lit(0))
    dbl = df.withColumn("_tl_key", F.col(key).cast("double"))
    out = Bucketizer(splits=splits, inputCol="_tl_key", outputCol="_tl_b",
                     handleInvalid="keep").transform(dbl)
    return out.withColumn("_tl_bucket", F.col("_tl_b").cast("int")).drop("_tl_key", "_tl_b")


#: sampled keys per bucket
_PER_BUCKET = 64


def splitters(df: DataFrame, order_by: list[str], n: int) -> list:
    """At most ``n - 1`` keys that cut the rows into buckets of about one size.

    The sample is chosen by a hash of the whole key, so it does not depend on how
    rows are partitioned; about ``_PER_BUCKET * n`` keys reach the driver."""
    total = df.count()
    if n < 2 or not total:
        return []
    share = min(1.0, _PER_BUCKET * n / total)
    some = df if share == 1.0 else df.filter(
        F.pmod(F.xxhash64(*order_by), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    ranked = some.select(F.struct(*order_by).alias("k"))
    found = ranked.agg(F.array_sort(F.collect_list("k")).alias("k"))
    places = F.transform(F.sequence(F.lit(1), F.lit(n - 1)),
                         lambda i: F.element_at("k", F.greatest(F.lit(1), (i * F.size("k") / n).cast("int"))))
    row = found.filter(F.size("k") > 0).select(F.array_distinct(places).alias("s")).first()
    return [tuple(k) for k in row["s"]] if row else []


#: types whose order Python shares (strings go as bytes)
_PLAIN = {"string", "binary", "bigint", "int", "smallint", "tinyint", "boolean", "date"}


def _places(keys: list):
    """How many of the sorted ``keys`` are not above the key of a row; nulls first."""
    coded = [tuple(y for v in k for y in (v is not None, v.encode() if isinstance(v, str) else v)) for k in keys]

    def run(*columns: pa.Array) -> pa.Array:
        values = [x for c in columns for x in (c.is_valid().to_pylist(), c.to_pylist())]
        return pa.array([bisect_right(coded, k) for k in zip(*values)], pa.int32())
    return run


def _splitter_buckets(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    keys = splitters(df, order_by, n)
    if not keys:
        return df.withColumn("_tl_bucket", F.lit(0))
    kinds = dict(df.dtypes)
    if all(kinds[c] in _PLAIN for c in order_by):
        columns = [F.col(c).cast("binary") if kinds[c] == "string" else F.col(c) for c in order_by]
        return df.withColumn("_tl_bucket", F.arrow_udf(_places(keys), "int")(*columns))
    kind = df.select(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_by)]).alias("k")).dtypes[0][1]

    def literal(rows):
        columns = [F.array(*[F.lit(r[i]) for r in rows]).alias(f"k{i}") for i in range(len(order_by))]
        return F.arrays_zip(*columns).cast(f"array<{kind}>")

    step = max(1, int(len(keys) ** 0.5))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_by)]).cast(kind)
    below = lambda some: F.size(F.filter(some, lambda s: s <= F.col("_tl_key")))
    out = df.withColumn("_tl_key", key).withColumn("_tl_part", below(literal(keys[::step])))
    # the part's first splitter is passed already; the next step - 1 remain
    start = (F.col("_tl_part") - 1) * step
    fine = below(F.slice(literal(keys), F.greatest(start, F.lit(0)) + 2, F.lit(step - 1))) if step > 1 else F.lit(0)
    out = out.withColumn("_tl_bucket", F.when(F.col("_tl_part") == 0, 0).otherwise(start + 1 + fine).cast("int"))
    return out.drop("_tl_key", "_tl_part")


def with_row_index(df: DataFrame, order_by, index_col: str = "row_index",
                   prefix_sums: dict[str, str] | None = None, num_buckets: int | None = None,
                   partition_by=None, checkpoint_input: bool = False,
                   size_col: str | None = None) -> DataFrame:
    """Dense 0-based ``index_col`` in ``order_by`` order (within each
    ``partition_by`` group when given); ``prefix_sums`` maps an output column
    to a numeric column whose exclusive running total it holds; ``size_col``
    names a column for the number of rows of the group.

    The input is read up to three times (bounds, sizes, positions); pass
    ``checkpoint_input=True`` when it is expensive to recompute."""
    order_by = _names(order_by)
    if checkpoint_input:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    prefix_sums = dict(prefix_sums or {})
    groups = _names(partition_by) if partition_by else []
    spark = df.sparkSession
    n = _bucket_count(df, num_buckets)
    b = _bucketize(df, order_by, n)
    aggs = [F.count(F.lit(1)).alias("_tl_n")] + [
        F.sum(F.col(v)).alias(f"_tl_s_{i}") for i, v in enumerate(prefix_sums.values())]
    # one row per (group, bucket); offsets are exclusive running sums over the
    # buckets of a group -- computed in Spark, windowed per group
    sizes = b.groupBy(*groups, "_tl_bucket").agg(*aggs)
    wb = Window.partitionBy(*groups).orderBy("_tl_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *groups, "_tl_bucket",
        F.coalesce(F.sum("_tl_n").over(wb), F.lit(0)).cast("long").alias("_tl_off"),
        *[F.coalesce(F.sum(f"_tl_s_{i}").over(wb), F.lit(0)).cast("long").alias(f"_tl_o_{i}")
          for i in range(len(prefix_sums))],
        *([F.sum("_tl_n").over(Window.partitionBy(*groups)).cast("long").alias(size_col)] if size_col else []))
    # at most groups x buckets rows; AQE broadcasts it when small
    joined = b.join(offsets, [*groups, "_tl_bucket"], "left")
    w = Window.partitionBy(*groups, "_tl_bucket").orderBy(*order_by)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = joined.withColumn(index_col, (F.col("_tl_off") + F.row_number().over(w) - 1).cast("long"))
    for i, (name, v) in enumerate(prefix_sums.items()):
        out = out.withColumn(name, (F.col(f"_tl_o_{i}") + F.coalesce(
            F.sum(F.col(v)).over(before), F.lit(0))).cast("long"))
    return out.drop("_tl_bucket", "_tl_off", *[f"_tl_o_{i}" for i in range(len(prefix_sums))])


def running_total(df: DataFrame, value_col: str, order_by, out_col: str = "start",
                  partition_by=None, num_buckets: int | None = None) -> DataFrame:
    """Exclusive running total of ``value_col`` in ``order_by`` order (B1)."""
    tmp = "_tl_ri"
    out = with_row_index(df, order_by, tmp, {out_col: value_col}, num_buckets, partition_by)
    return out.drop(tmp)


def shuffle_key(seed: int, epoch: int, id_col: str):
    """60 bits of md5("seed:epoch:id") as a non-negative long: a stable,
    engine-independent pseudo-random rank (SQL engines can recompute it)."""
    text = F.concat_ws(":", F.lit(str(int(seed))), F.lit(str(int(epoch))),
                       F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def seeded_shuffle(df: DataFrame, seed: int, epoch: int = 0, id_col: str = "doc_id",
                   index_col: str = "row_index", partition_by=None,
                   num_buckets: int | None = None) -> DataFrame:
    """B2: reproducible permutation; position = rank of ``shuffle_key(seed,
    epoch, id)`` (ties broken by id).  Same seed and epoch -> same order on
    any cluster and any partitioning."""
    keyed = df.withColumn("_tl_shuf", shuffle_key(seed, epoch, id_col))
    out = with_row_index(keyed, ["_tl_shuf", id_col], index_col, None, num_buckets, partition_by)
    return out.drop("_tl_shuf")
