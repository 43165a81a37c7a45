"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from textloom.llm import search
from textloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
rng = random.Random(12)
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    tfs = [(i, c, sum(c.values())) for i, c in tfs if c]
    n_docs, total = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    out = []
    for item, text in items:
        asked, scored = set(terms(text)), []
        for i, c, n in tfs:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, q string"),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int"))


def texts(n, words=60):
    vocabulary = [f"w{i}" for i in range(words)] + ["Ünï", "日本", "A1", "a1"]
    return [" ".join(rng.choices(vocabulary, [1 / (1 + j) for j in range(len(vocabulary))], k=rng.randrange(1, 90)))
            for _ in range(n)]


def test_terms_are_those_of_the_pattern():
    for t in [None, "", "A-b_c9 É{x}", "\x00a\x7fb\x80c", "".join(map(chr, range(1, 300)))]:
        assert [w.decode() for w in search.terms_of((t or "").encode())] == terms(t)


@pytest.mark.parametrize("coordinates", [4, 64, 1 << 20])
def test_bounds_are_never_below_scores(coordinates):
    docs, asked = texts(60), texts(7) + ["w0 " * 3]
    block = search.Block(list(range(8)), [sorted(set(search.terms_of(t.encode()))) for t in asked], {}, 60, 3000)
    block.weights = {t: rng.randrange(1, 5000) for ts in block.terms for t in ts}
    docs += ["w0 " * 300 + "w1 " * 255 + "w2 " * 256]
    import pyarrow as pa
    kept = [search.sketch(t.encode(), coordinates) for t in docs]
    got = search._bounded(block, coordinates)(np.array([n for n, _ in kept]), pa.array([s.tobytes() for _, s in kept], pa.binary()))
    want = np.array([search.score(t.encode(), range(8), block) for t in docs])
    assert got.shape == want.shape and (got >= want).all()
    if coordinates == 1 << 20:  # few terms, no shared coordinate, small frequencies
        assert (got[:60] == want[:60]).all()


@pytest.mark.parametrize("options", [{}, {"coordinates": 16}, {"block_queries": 2}, {"block_terms": 5}])
def test_results_are_exact(spark, options):
    docs = list(enumerate(texts(200))) + [(900, None), (901, ""), (902, "... !"), (903, "w0 " * 700 + "w59")]
    docs += [(1000 + i, "w7 w50 w51 same") for i in range(80)]  # ties far beyond k
    docs += [(5, docs[5][1]), (None, "w50 w51"), (None, None)]
    rng.shuffle(docs)
    items = [(i, t) for i, t in enumerate(texts(6, 70))] + [(6, None), (7, "?"), (8, "absent words"), (9, "same"),
                                                          (10, "w50 W50 w51"), (3, "w59 ünï")]
    d, q = tables(spark, docs, items)
    got = search.search(d, q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(docs, items)


def test_more_documents_than_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(search, "maybe_broadcast", lambda df, rows=0: df)
    docs, items = list(enumerate(texts(150))), list(enumerate(texts(3)))
    assert found(search.search(*tables(spark, docs, items), k=10)) == brute(docs, items, 10)


def test_long_texts_and_empty_tables(spark):
    docs = [(1, "needle " + "hay " * 400_000), (2, "needle"), (3, "hay")]
    d, q = tables(spark, docs, [(1, "needle"), (2, "hay needle")])
    assert found(search.search(d, q)) == brute(docs, [(1, "needle"), (2, "hay needle")])
    no_docs, no_items = tables(spark, docs, [(1, "x")])
    assert search.search(d.limit(0), no_items).count() == 0
    assert search.search(no_docs, q.limit(0)).count() == 0


def test_query_on_whole_tables(spark):
    read = lambda t, i: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(i, "text").collect()]
    assert found(QUERIES["op12_ranked_search"](spark, SF)) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
