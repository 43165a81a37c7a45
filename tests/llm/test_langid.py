import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import langid as L
from textloom.llm.queries import held_out, language_model

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_windows_hold_every_ngram_once():
    for n in (0, 1, 3, 4, 255, 256, 257, 509, 510, 2000):
        data = bytes(np.random.default_rng(n).integers(0, 256, n, np.uint8))
        w = L.windows_of(data)
        assert w.shape[1] == L.WINDOW
        flat = np.concatenate([w[:, :L.STRIDE].ravel(), w[-1, L.STRIDE:]])
        assert bytes(flat[:n].astype(np.uint8)) == data and (flat[n:] == L.PAD).all()
        grams = [tuple(r[i:i + 4]) for r in w for i in range(L.STRIDE)]
        assert sum(L.PAD not in g for g in grams) == max(0, n - 3)


def model(seed=0, langs=("aa", "bb", "cc")):
    r, n = np.random.default_rng(seed), L.FILTERS * len(L.WIDTHS)
    return L.Model(list(langs), r.normal(size=(257, L.DIM)), r.normal(size=(L.WIDEST, L.DIM, n)) * L._mask(),
                   r.normal(size=n), r.normal(size=(n, len(langs))), r.normal(size=len(langs)))


def test_tables_equal_the_plain_convolution():
    m = model()
    windows = np.concatenate([L.windows_of(x) for x in (b"", b"ab", "é ü 日本".encode(), b"hello world " * 60)])
    for w, got in zip(windows, m.probabilities(windows)):
        e = m.emb[w]
        z = np.array([sum(e[t + k] @ m.conv[k] for k in range(L.WIDEST)) for t in range(L.WINDOW - L.WIDEST + 1)])
        z = np.maximum(z.max(0) + m.bias, 0) @ m.out + m.out_bias
        p = np.exp(z - z.max())
        assert np.allclose(got, p / p.sum(), atol=1e-4)


def test_documents_share_batches():
    m = model()
    texts = ["abc", "x" * 5000, "", "é" * 300] * 40
    alone = [next(L.document_scores(m, iter([t]))) for t in texts]
    together = list(L.document_scores(m, iter(texts)))
    assert [a[0] for a in alone] == [b[0] for b in together]
    assert np.allclose([a[1] for a in alone], [b[1] for b in together], atol=1e-5)


def test_held_out_accuracy_and_fold(spark):
    docs = spark.read.parquet(DOCS)
    m = language_model(docs)
    rows = L.identify(docs, m).join(docs.select("doc_id", "lang", held_out().alias("out")), "doc_id").collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r.out]
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    # what the held-out rows say does not reach the model
    other = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "text", F.when(held_out(), F.lit("zzz qqq")).otherwise(F.col("text")))
    assert np.array_equal(language_model(other).out, m.out)


def test_nulls_letters_and_clashes(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "Été"), (None, "abc"), (4, "Été"), (5, "日本"), (6, "a" * 100_000)]
    df = spark.createDataFrame([(i, t, "q", 3.0) for i, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in L.identify(df, model()).collect()}
    assert got == {(1, True, True), (2, True, True), (3, True, True), (4, False, False), (None, False, False),
                   (5, False, False), (6, False, False)}
    kept = L.keep_identified(df, model(), min_score=0.0)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "6", "None"]
    assert L.keep_identified(df, model(), min_score=1.1).count() == 0


def test_sample_is_bounded_and_whole_corpus_small(spark):
    rows = [(i, f"text number {i}", "aa" if i % 3 else "bb") for i in range(300)] + [(900, "x", None), (901, None, "aa"), (902, "77", "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.unionByName(spark.createDataFrame([(5, "text number 5", "aa")] * 400, "doc_id long, text string, lang string"))
    x, y = L.training_windows(df, per_lang=20)
    assert len(x) == len(y) == 40 and set(y) == {"aa", "bb"}
    x, y = L.training_windows(df, per_lang=20, total=10)
    assert len(y) == 10
    with pytest.raises(ValueError):
        L.training_windows(df, total=1)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    m = L.fit(df)
    assert [r.lang_pred for r in L.identify(df, m).collect()] == ["und", "und"]
    assert L.identify(df.limit(0), m).count() == 0 and L.keep_identified(df, m).count() == 1
