"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import checkpoint_dir


def _star(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the smallest of itself and its neighbours ``v``."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(m, "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every end of an edge: the smallest id reachable.

    Each round hangs neighbours on smaller and smaller ids until every node
    points straight at its root; rounds grow with the logarithm of the longest
    path.  It ends when a round changes nothing, without a cap on rounds.
    Minima are pre-aggregated before the shuffle; the joins on a hub's id are
    plain shuffle joins, whose skewed partitions Spark splits."""
    checkpoint_dir(edges.sparkSession)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = e.filter("u <> v").distinct().checkpoint()
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        e = (small.select("u", F.col("m").alias("v"))
             .unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
             .distinct().checkpoint())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            break
        state = now
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())
