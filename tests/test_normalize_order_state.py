"""NFD in expressions, whole-key splitters, exact batches, seen tables, artifacts."""

import random
import sys
import threading
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom import streaming
from textloom.functions.text import nfd, normalize_text_col
from textloom.operators import clean, order
from textloom.session import scratch_path
from textloom.sources import artifacts


# ---------------------------------------------------------------- C8
def nfd_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(4)
    return [r.n for r in df.select("i", nfd(F.col("t")).alias("n")).orderBy("i").collect()]


def test_nfd_of_every_code_point(spark):
    points = [chr(p) for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p < 0xE000]
    lines = ["".join(points[i:i + 400]) for i in range(0, len(points), 400)]
    alone = [c for c in points if unicodedata.normalize("NFD", c) != c]
    spaced = [" ".join(alone[i:i + 100]) for i in range(0, len(alone), 100)]
    assert nfd_of(spark, lines + spaced) == [unicodedata.normalize("NFD", t) for t in lines + spaced]


def test_nfd_orders_marks(spark):
    r = random.Random(1)
    marks = [chr(p) for p in range(0x300, 0x370)] + ["\u093c", "\u094d", "\u0e48", "\u20d0", "\U0001d165", "\u0488", "\u0903"]
    base = list("aeé\u1e69한각 \n") + ["\u212b", "日", "\u0958"]
    texts = ["".join(r.choice(marks) if r.random() < 0.6 else r.choice(base) for _ in range(r.randrange(1, 40)))
             for _ in range(800)] + [None, "", "plain", "\u0301" * 2000 + "\u0323" * 2000]
    assert nfd_of(spark, texts) == [None if t is None else unicodedata.normalize("NFD", t) for t in texts]


@pytest.mark.parametrize("lower", [True, False])
def test_accents_go_from_every_code_point(spark, lower):
    points = [chr(p) for p in range(1, 0x3000) if not 0xD800 <= p < 0xE000]
    texts = points + ["".join(points[i:i + 90]) for i in range(0, len(points), 90)] + [None, "", "Crème Brûlée – İstanbul"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(4)
    by_hand = F.regexp_replace(F.lower(nfd(F.col("t"))) if lower else nfd(F.col("t")), r"\p{M}+", "")
    got = df.select(normalize_text_col(F.col("t"), lower).alias("a"), by_hand.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_normalize_needs_no_python(spark):
    df = spark.createDataFrame([("É\u0327 Ünï",)], "t string").select(normalize_text_col(F.col("t")).alias("n"))
    assert df.first().n == "e uni"
    assert "Python" not in df._jdf.queryExecution().toString()


# ---------------------------------------------------------------- B1
def sizes(df, keys, n):
    return sorted(r["count"] for r in order._bucketize(df, keys, n).groupBy("_tl_bucket").count().collect())


def test_one_value_in_half_of_the_rows_is_split(spark):
    df = spark.range(0, 8000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("k"),
                                     F.md5(F.col("id").cast("string")).alias("name"), "id")
    for keys in (["k", "id"], ["k", "name"], ["name"]):
        got = sizes(df, keys, 16)
        assert len(got) == 16 and got[-1] < 3 * 8000 / 16, (keys, got)
    want = {r.id: i for i, r in enumerate(df.orderBy("k", "name").collect())}
    out = order.with_row_index(df.repartition(5), ["k", "name"], "ri", num_buckets=16)
    assert {r.id: r.ri for r in out.collect()} == want


def test_keys_with_nulls_strings_and_doubles(spark):
    r = random.Random(2)
    rows = [(r.choice([None, -1.5, 0.0, 2.25, float("inf")]), r.choice([None, "", "a", "ab", "B", "é"]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, s string, i int").repartition(3)
    want = {x.i: n for n, x in enumerate(df.orderBy("x", "s", "i").collect())}
    for n in (1, 2, 5, 40):
        out = order.with_row_index(df, ["x", "s", "i"], "ri", num_buckets=n)
        assert {x.i: x.ri for x in out.collect()} == want
    assert order.with_row_index(df.limit(0), ["s", "i"], "ri").count() == 0


def test_buckets_do_not_depend_on_partitions(spark):
    df = spark.range(0, 3000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    place = lambda d: {r.id: r._tl_bucket for r in order._bucketize(d, ["k", "id"], 9).collect()}
    assert place(df.repartition(2)) == place(df.repartition(7))


# ---------------------------------------------------------------- U1
def test_exact_batches_cross_files(spark, tmp_path):
    spark.range(0, 1050).withColumn("v", F.col("id") * 2).repartition(6, "v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def run(pdf):
        return pd.DataFrame({"first": [pdf["id"].iloc[0]], "last": [pdf["id"].iloc[-1]], "n": [len(pdf)],
                             "sorted": [bool(pdf["id"].is_monotonic_increasing)], "columns": [",".join(pdf.columns)]})

    got = clean.map_batches(df, run, "first long, last long, n long, sorted boolean, columns string", 200, "id").collect()
    assert sorted(map(tuple, got)) == [(i, min(i + 199, 1049), min(200, 1050 - i), True, "id,v") for i in range(0, 1050, 200)]
    with pytest.raises(ValueError):
        clean.map_batches(df, run, "n long", order_by="id")


# ---------------------------------------------------------------- D4
def put(spark, path, texts):
    spark.createDataFrame([(t, 1) for t in texts], "text string, v int").coalesce(1).write.mode("append").parquet(path)


def run(spark, base, **options):
    stream = spark.readStream.schema("text string, v int").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    return streaming.run_dedup(stream, f"{base}/out", f"{base}/state", f"{base}/ckpt", buckets=4, **options)


def texts_of(spark, base):
    return sorted(str(r.text) for r in streaming.read_deduped(spark, f"{base}/out").collect())


def test_seen_table_over_batches_restarts_and_compaction(spark):
    base = scratch_path(spark, "seen")
    for chunk in (["a", "b", "a", None], ["b", "c", None], ["a", "d"], ["e"], ["e", "f", "a"]):
        put(spark, f"{base}/in", chunk)
    table = run(spark, base, compact_every=2)
    assert texts_of(spark, base) == ["None", "a", "b", "c", "d", "e", "f"]
    assert table.size() == 7 and table.hashes().columns == ["hash", "bucket"]
    names = artifacts.list_names(spark, f"{base}/state")
    assert [n for n in names if n.startswith("base-")] == ["base-3"] and "batch-4" in names and "batch-3" not in names
    run(spark, base, compact_every=2)  # nothing new
    put(spark, f"{base}/in", ["a", "g"])
    assert run(spark, base, compact_every=2).size() == 8
    assert texts_of(spark, base) == ["None", "a", "b", "c", "d", "e", "f", "g"]


def test_a_batch_that_runs_again_gives_the_same(spark):
    base = scratch_path(spark, "again")
    table = streaming.SeenTable(spark, f"{base}/state", buckets=4, compact_every=2)

    def batch(texts, i):
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        kept = table.accept(df, ["text"], i).checkpoint()
        table.remember(kept, i)
        return sorted(r.text for r in kept.collect())

    assert batch(["a", "b"], 0) == ["a", "b"]
    for _ in range(3):  # fails after writing, before it is committed
        assert batch(["b", "c"], 1) == ["c"]
    for _ in range(2):  # compacts first, also again
        assert batch(["a", "c", "d"], 2) == ["d"]
    # a base whose writer stopped is not read
    spark.range(1).write.parquet(f"{base}/state/base-9")
    artifacts.delete_path(spark, f"{base}/state/base-9/_SUCCESS")
    assert batch(["d", "e"], 3) == ["e"] and table.size() == 5


# ---------------------------------------------------------------- S8
def test_of_two_builders_one_wins(spark):
    base, meet, out = scratch_path(spark, "race"), threading.Barrier(2), []

    def build(n):
        df = spark.range(n)
        meet.wait(60)  # both have found nothing and write
        return df

    def go(n):
        out.append(artifacts.materialize(spark, base, "x", {"a": 1}, lambda: build(n)).count())

    threads = [threading.Thread(target=go, args=(n,)) for n in (3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert len(out) == 2 and out[0] == out[1]
    path = artifacts.artifact_path(base, "x", {"a": 1})
    names = artifacts.list_names(spark, path)
    assert len([n for n in names if n.startswith("data-")]) == 1 and "CURRENT" in names


def test_a_build_that_fails_leaves_nothing_to_read(spark):
    base = scratch_path(spark, "fails")
    broken = lambda: spark.range(3).select(F.raise_error(F.lit("no")))
    with pytest.raises(Exception):
        artifacts.materialize(spark, base, "x", {}, broken)
    with pytest.raises(FileNotFoundError):
        artifacts.materialize(spark, base, "x", {}, None)
    assert artifacts.materialize(spark, base, "x", {}, lambda: spark.range(2)).count() == 2


def test_places_follow_spark_order(spark):
    import pyarrow as pa
    from textloom.operators.order import _places

    values = [None, "", "a", "\x00", "ü", "￿", "\U0001f600", "b", "aa"]
    rows = [(n, w) for n in (None, -3, 0, 2) for w in values]
    df = spark.createDataFrame(rows, "n int, w string")
    ranked = [(r.n, r.w) for r in df.orderBy("n", "w").collect()]
    got = _places(ranked[::3])(pa.array([n for n, _ in ranked], pa.int32()),
                               pa.array([None if w is None else w.encode() for _, w in ranked], pa.binary()))
    assert got.to_pylist() == [i // 3 + 1 for i in range(len(ranked))]
