import pytest
from pyspark.sql import functions as F

from textloom.operators.bounded import TooLargeToBroadcast, bounded_broadcast, skew_safe_lookup


def test_skew_safe_lookup_matches_plain_join(spark):
    # key 0 holds a third of all rows
    big = spark.range(0, 3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    weight = big.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    plain = {(r.row, r.v) for r in big.join(small, "k", "left").collect()}
    for hot_k in (0, 1, 5, 100):
        for bound in (0, 10_000):  # shuffled with salts, broadcast
            got = {(r.row, r.v) for r in skew_safe_lookup(
                big, small, ["k"], weight, hot_k, broadcast_rows=bound).collect()}
            assert got == plain
    inner = skew_safe_lookup(big, small, ["k"], weight, 2, how="inner", broadcast_rows=0)
    assert inner.count() == big.join(small, "k").count()


def test_bounded_broadcast_checks_size(spark):
    assert bounded_broadcast(spark.range(5), 5).count() == 5
    with pytest.raises(TooLargeToBroadcast):
        bounded_broadcast(spark.range(6), 5)


def test_lookup_with_map_column_and_null_keys(spark):
    big = spark.range(0, 60).select(
        F.col("id").alias("row"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    small = spark.range(0, 4).select(F.col("id").alias("k"), (F.col("id") + 7).alias("v"))
    weight = big.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    want = {(r, (r % 5) + 7 if r % 3 and r % 5 < 4 else None) for r in range(60)}
    for bound in (0, 10):
        got = skew_safe_lookup(big, small, ["k"], weight, 2, broadcast_rows=bound).collect()
        assert {(r.row, r.v) for r in got} == want and len(got) == 60


def test_small_lookup_does_not_shuffle_the_big_side(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        big = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("row"))
        small = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
        j = skew_safe_lookup(big, small, ["k"], big.groupBy("k").count().withColumnRenamed("count", "w"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
