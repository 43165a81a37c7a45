"""Token streams stay in their rows; n-gram tables are not taken for small ones."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import encode as enc
from textloom.operators import packing
from textloom.operators import scoring as sc
from textloom.operators.lookup import replace_keys


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_known_dictionary_moves_no_token(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 2)], "word string, freq long")
    tok = enc.Tokenizer("word", enc.word_level_vocab(counts))
    df = spark.createDataFrame([(0, "a zz b"), (1, ""), (2, None)], "doc_id long, text string")
    ids = enc.encode(df, tok)
    back = enc.decode(ids, tok)
    assert "Exchange" not in _plan(ids) and "Sort" not in _plan(ids)
    assert "Exchange" not in _plan(back) and "Sort" not in _plan(back)
    assert {r.doc_id: r.input_ids for r in ids.collect()} == {0: [5, 0, 6], 1: [], 2: []}
    assert {r.doc_id: r.text for r in back.collect()} == {0: "a b", 1: "", 2: ""}


@pytest.mark.parametrize("hot", [0, 1, 7, 30])
@pytest.mark.parametrize("missing", [[], [0]])
def test_gaps_are_filled_in_place(spark, hot, missing):
    rng = random.Random(hot)
    table = {f"k{i}": [10 * i + j for j in range(i % 4)] for i in range(30)}
    rows = [(i, [rng.choice([f"k{rng.randrange(33)}", None, "ü"]) for _ in range(rng.randrange(12))]) for i in range(40)]
    rows += [(7, ["k1", "k29"]), (7, ["k1", "k29"]), (None, ["k29", "k2"]), (50, None), (51, [])]
    df = spark.createDataFrame(rows, "doc_id long, keys array<string>").repartition(3)
    whole = spark.createDataFrame(list(table.items()), "key string, values array<int>")
    some = whole.filter(F.substring("key", 2, 2).cast("int") < hot)
    want = sorted((str(i), [v for k in keys or [] if k is not None for v in table.get(k, missing)]) for i, keys in rows)
    got = replace_keys(df, F.col("keys"), "out", some, whole, missing).collect()
    assert sorted((str(r.doc_id), r.out) for r in got) == want
    if hot == 30:
        got = replace_keys(df, F.col("keys"), "out", some, None, missing).collect()
        assert sorted((str(r.doc_id), r.out) for r in got) == want


def test_ngram_sides_do_not_go_through_the_driver(spark):
    rows = [(1, "a b c d e", "a b c d f"), (1, "a b", "b a b"), (None, "x y", "x y"), (2, "", "q"), (3, None, "q r")]
    toks = spark.createDataFrame(rows, "k long, p string, r string").select(
        "k", sc.whitespace_tokens("p").alias("p"), sc.whitespace_tokens("r").alias("r"))
    out = sc.ngram_overlap(toks, "k", "p", "r", (1, 2))
    assert "Broadcast" not in _plan(out)
    got = sorted((str(r.k), r.n, r.tp, r.tr, r.m) for r in out.collect() if r.k != 3)
    assert got == [("1", 1, 2, 3, 6), ("1", 1, 5, 5, 6), ("1", 2, 1, 2, 4), ("1", 2, 4, 4, 4),
                   ("2", 1, 0, 1, 0), ("2", 2, 0, 0, 0), ("None", 1, 2, 2, 0), ("None", 2, 1, 1, 0)]


def test_columns_in_step_are_plain_lists(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [9, 8, 7]), (1, [4, 5], [6]), (2, None, [1])], "doc_id long, a array<int>, b array<int>")
    out = packing.group_texts(df, 2, 10, ["a", "b"])
    assert {r.chunk_id: (r.a, r.b) for r in out.collect()} == {0: ([1, 2], [9, 8]), 1: ([3, 4], [7, 6])}
    assert "array<struct<a" not in out._jdf.queryExecution().analyzed().treeString() and "_tl_z" not in _plan(out)


def test_texts_and_pieces_are_not_checkpointed(spark):
    counts = spark.createDataFrame([(f"w{i}", 50 - i) for i in range(30)], "word string, freq long")
    tok = enc.Tokenizer("word", enc.word_level_vocab(counts))
    df = spark.createDataFrame([(0, "w0 w29 zz w1"), (0, "w28"), (1, None)], "doc_id long, text string")
    ids = enc.encode(df, tok, hot_words=2, broadcast_rows=1)
    scans = [x for x in _plan(ids).splitlines() if "Scan ExistingRDD" in x and "_tl_u" in x]
    assert scans and not any("_tl_w" in x or "text" in x for x in scans)
    assert sorted(r.input_ids for r in ids.collect()) == [[], [5, 34, 0, 6], [33]]
