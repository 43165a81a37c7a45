import os
import tempfile

from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import clean, dedup
from textloom.session import scratch_path
from textloom.sources import files, text as src


def _write_bytes(data: bytes) -> str:
    d = tempfile.mkdtemp(prefix="tl-src-")
    with open(os.path.join(d, "part.txt"), "wb") as f:
        f.write(data)
    return d


def _texts(df):
    return [r.text for r in df.orderBy(*src.RECORD_ORDER).collect()]


def test_delimiter_framing(spark):
    p = _write_bytes(b"one\ntwo\n<|endoftext|>\nthree<|endoftext|>tail")
    assert _texts(src.read_delimited_docs(spark, p)) == ["one\ntwo", "three", "tail"]


def test_drop_unterminated_matches_reference(spark):
    p = _write_bytes(b"one\ntwo\n<|endoftext|>\nthree<|endoftext|>tail")
    got = _texts(src.read_delimited_docs(spark, p, drop_unterminated=True))
    assert got == ["one\ntwo", "three"]


def test_two_delimiters_on_one_line(spark):
    p = _write_bytes(b"a<|endoftext|>b<|endoftext|>c\n<|endoftext|>")
    assert _texts(src.read_delimited_docs(spark, p)) == ["a", "b", "c"]


def test_framing_exact_across_many_splits(spark):
    docs = [f"doc {i} " + "x" * (i % 37) + "\nline" for i in range(300)]
    p = _write_bytes("".join(d + "<|endoftext|>" for d in docs).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        got = _texts(src.read_delimited_docs(spark, p))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == docs


def test_trim_set(spark):
    df = spark.createDataFrame([("\n a\t \n",)], "t string")
    assert df.select(tx.trim_chars("t")).first()[0] == "a\t"


def test_byte_repair(spark):
    p = _write_bytes(bytes([0x93, 0x71, 0x94, 0x81]))
    assert _texts(src.read_delimited_docs(spark, p)) == ["“q”\u0081"]


def test_universal_newlines(spark):
    df = spark.createDataFrame([("a\r\nb\rc",)], "t string")
    assert df.select(tx.universal_newlines("t")).first()[0] == "a\nb\nc"


def test_reflow(spark):
    df = spark.createDataFrame([("a\nb\n\nc",), ("x\n\n\ny",), ("\na",)], "t string")
    got = [r[0] for r in df.select(tx.reflow_newlines("t")).collect()]
    assert got == ["a b\nc", "x\n\n\ny", " a"]


def test_tale_split(spark):
    df = spark.createDataFrame([(1, "x\n\n\n\n\ny\n\n\n\n")], "id long, text string")
    got = [r.text for r in clean.split_docs(df).orderBy("piece_idx").collect()]
    assert got == ["x", "y"]


def test_collapse_and_affix(spark):
    df = spark.createDataFrame([(" a\n\n\nb",)], "t string")
    r = df.select(tx.collapse_blank_lines("t"), tx.strip_one_leading_space("t"),
                  tx.affix("t", "# ", tx.EOT)).first()
    assert r[0] == " a\nb" and r[1] == "a\n\n\nb" and r[2] == "#  a\n\n\nb<|endoftext|>"


def test_dedup_order_and_report(spark):
    df = spark.createDataFrame([(0, "x", "train"), (1, "y", "train"), (2, "x", "train")],
                               "doc_id long, text string, split string")
    kept = sorted(r.doc_id for r in dedup.dedup_exact(df).collect())
    assert kept == [0, 1]
    # several order columns compare left to right
    df2 = spark.createDataFrame([("f2", 0, "x"), ("f1", 9, "x"), ("f1", 3, "x")],
                                "f string, pos long, text string").withColumn("split", F.lit("t"))
    first = dedup.dedup_exact(df2, order_by=["f", "pos"]).first()
    assert (first.f, first.pos) == ("f1", 3)
    rep = dedup.dedup_report(df).first()
    assert (rep.n_rows, rep.n_unique, rep.n_removed) == (3, 2, 1)
    # idempotent
    again = dedup.dedup_exact(dedup.dedup_exact(df))
    assert sorted(r.doc_id for r in again.collect()) == [0, 1]


def test_normalize(spark):
    df = spark.createDataFrame([("Éléphant Straße",)], "text string")
    assert clean.normalize_text(df).first().text == "elephant straße"


def test_route_files(spark):
    df = spark.createDataFrame([("TinyStoriesV2-valid.txt",), ("TinyStories-train.txt",),
                                ("readme.md",)], "file_name string")
    got = {r.file_name: (r.split, r.version) for r in files.route_files(df).collect()}
    assert got == {"TinyStoriesV2-valid.txt": ("validation", "version2"),
                   "TinyStories-train.txt": ("train", "original")}
    v2 = files.route_files(df, data_slice="version2").collect()
    assert [r.file_name for r in v2] == ["TinyStoriesV2-valid.txt"]


def test_from_records_rejects_bare_string(spark):
    import pytest
    with pytest.raises(TypeError):
        src.from_records(spark, {"tales": "abc"})
    assert src.from_records(spark, {"tales": ["abc"]}).count() == 1


def test_near_dedup(spark):
    from textloom.operators.dedup import dedup_near
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30", "zz")
    other = " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(1, base), (2, near), (3, other), (4, base)],
                               "doc_id long, text string")
    out = dedup_near(df, threshold=0.8, keep_all=True)
    got = {r.doc_id: r.cluster for r in out.collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_materialize_builds_once(spark):
    from textloom.sources import artifacts
    base = scratch_path(spark, "art")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    artifacts.materialize(spark, base, "x", {"a": 1}, build)
    assert artifacts.materialize(spark, base, "x", {"a": 1}, build).count() == 3
    assert len(calls) == 1
    import pytest
    with pytest.raises(FileNotFoundError):
        artifacts.materialize(spark, base, "x", {"a": 2}, None)


def test_map_batches_exact_batch_size(spark):
    import pandas as pd
    df = spark.range(0, 25).coalesce(1)

    def sizes(pdf):
        return pd.DataFrame({"n": [len(pdf)]})

    got = sorted(r.n for r in clean.map_batches(df, sizes, "n long", batch_size=10).collect())
    assert got == [5, 10, 10]
