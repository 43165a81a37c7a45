from pyspark.sql import functions as F

from textloom.operators import batches as bt
from textloom.operators import order


def test_row_index_dense_and_partition_independent(spark):
    df = spark.range(0, 997).withColumn("v", (F.col("id") % 7).cast("long")).repartition(5)
    base = None
    for n in (1, 4, 7):
        out = order.with_row_index(df, ["id"], "ri", {"start": "v"}, num_buckets=n)
        got = sorted((r.id, r.ri, r.start) for r in out.collect())
        assert [g[1] for g in got] == list(range(997))
        if base is None:
            base = got
        assert got == base
    # prefix sums are exclusive running totals
    run, exp = 0, []
    for i in range(997):
        exp.append(run)
        run += i % 7
    assert [g[2] for g in base] == exp


def test_row_index_string_key(spark):
    df = spark.createDataFrame([(c,) for c in "zyxwvutsrq"], "k string")
    out = order.with_row_index(df, ["k"], "ri", num_buckets=3)
    assert [r.k for r in out.orderBy("ri").collect()] == sorted("zyxwvutsrq")


def test_seeded_shuffle_is_repeatable_permutation(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    a = order.seeded_shuffle(df, 42, 0)
    b = order.seeded_shuffle(df.repartition(3), 42, 0)
    c = order.seeded_shuffle(df, 42, 1)
    ra = {r.doc_id: r.row_index for r in a.collect()}
    rb = {r.doc_id: r.row_index for r in b.collect()}
    rc = {r.doc_id: r.row_index for r in c.collect()}
    assert sorted(ra.values()) == list(range(500))
    assert ra == rb and ra != rc
    assert [ra[i] for i in range(10)] != list(range(10))


def test_drop_last_and_budget(spark):
    df = order.with_row_index(spark.range(10), ["id"])
    tr = bt.assign_batches(df, 4, drop_last=True)
    ev = bt.assign_batches(df, 4, drop_last=False)
    assert tr.select("batch_id").distinct().count() == 2
    assert ev.select("batch_id").distinct().count() == 3
    assert bt.budget(200, 40, 56) == (142, 71)
    assert bt.budget(-1, 40, 56) == (-1, -1)
    assert bt.take_batches(ev, 2).count() == 8
    assert bt.take_batches(ev, -1).count() == 10
    mb = bt.micro_batches(ev, 4, 2).filter("batch_id = 0").select("micro_id").collect()
    assert sorted(r.micro_id for r in mb) == [0, 0, 1, 1]


def test_row_index_heavy_ties_in_leading_key(spark):
    # a third of the rows share one leading value: must not become one bucket,
    # and the index must follow (lead, tiebreak) for every bucket count
    df = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(-(F.col("id") % 17)).alias("lead"),
        F.format_string("w%05d", F.col("id")).alias("word"))
    expected = sorted(((r.lead, r.word) for r in df.collect()))
    for n in (2, 5, 9):
        out = order.with_row_index(df, ["lead", "word"], "ri", num_buckets=n)
        got = [(r.lead, r.word) for r in out.orderBy("ri").collect()]
        assert got == expected
        assert sorted(r.ri for r in out.collect()) == list(range(900))
