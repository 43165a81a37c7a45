import os

from pyspark.sql import functions as F

from textloom import streaming
from textloom.session import scratch_path
from textloom.sources import text as src


def test_stream_dedup_across_micro_batches(spark):
    d = scratch_path(spark, "st-in")
    for i, chunk in enumerate([["a", "b", "a"], ["b", "c"], ["a", "d"]]):
        spark.createDataFrame([(f" {t}\n",) for t in chunk], "text string").coalesce(1) \
            .write.mode("append").option("lineSep", "<|endoftext|>").text(d)
    s = streaming.read_delimited_stream(spark, d, max_files_per_trigger=1)
    out, ck = scratch_path(spark, "st-out"), scratch_path(spark, "st-ck")
    streaming.run_available_now(streaming.dedup_stream(s).select("text"), out, ck)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]
    # restart with the same checkpoint: nothing new, nothing repeated
    streaming.run_available_now(streaming.dedup_stream(
        streaming.read_delimited_stream(spark, d)).select("text"), out, ck)
    assert spark.read.parquet(out).count() == 4


def test_stream_dedup_within_watermark(spark):
    d = scratch_path(spark, "wm-in")
    rows = [("2024-01-01 00:00:00", "x"), ("2024-01-01 00:00:05", "x"),
            ("2024-01-01 00:00:06", "y")]
    spark.createDataFrame(rows, "ts string, text string").select(
        F.to_timestamp("ts").alias("ts"), "text").write.parquet(d)
    stream = spark.readStream.schema("ts timestamp, text string").parquet(d)
    out, ck = scratch_path(spark, "wm-out"), scratch_path(spark, "wm-ck")
    deduped = streaming.dedup_stream(stream, "text", watermark_col="ts", delay="1 minute")
    streaming.run_available_now(deduped.select("ts", "text"), out, ck)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["x", "y"]
