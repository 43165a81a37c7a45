import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.llm import decontam
from textloom.llm.decontam import contamination, decontaminate, hit_words

rng = random.Random(3)
VOCAB = [f"w{i}" for i in range(40)] + ["É", "straße", "x9"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n):
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if (g := tuple(w[a:a + k])) in windows:
                    hit |= set(range(a, a + k))
                    found |= windows[g]
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def sample():
    items = [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.choice([2, 5, 6, 9])))) for i in range(12)]
    items += [(3, items[0][1]), (None, "only w1 null W2 id w3"), (50, None), (51, " .,; "), (52, "")]
    docs = [(None, None), (1, None), (1, ""), (2, " -- "), (7, "w1"), (7, "w1")]
    for i in range(40):
        w = [rng.choice(VOCAB) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0 and len(w) > 4:
            cut = words(items[i % 12][1])
            w[3:3] = [x.upper() for x in cut]
        docs.append((i, rng.choice([" ", ", ", "\n--"]).join(w)))
    docs.append((99, " ".join([docs[-1][1]] * 50) + " " + items[1][1]))
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "c", 1, 2) for d, t in docs],
                                  "doc_id long, text string, spans string, _id int, _h int"),
            spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, _k int"))


@pytest.mark.parametrize("n", [1, 6, 10])
def test_matches_brute_force(spark, n):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    for bound in (decontam.MAX_BROADCAST_WINDOWS, 0):  # broadcast, shuffled
        got = contamination(d, b, n, max_broadcast=bound).select("doc_id", "n_words", hit_words(F.col("spans")).alias("h"), "items")
        assert sorted(((r[0], r[1], len(r[2]), r[3]) for r in got.collect()), key=str) == brute(docs, items, n)


def test_documents_go(spark):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    clean = [x[0] for x in brute(docs, items, 6) if not x[2]]
    got = decontaminate(d, b, "document", 6)
    assert got.columns == d.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(clean, key=str)


def test_spans_go_and_breaks_stay(spark):
    d = spark.createDataFrame([(1, "Keep, A1 b2 C3! and d4 (a1--b2\nc3) end.", 7), (2, "a1 b2 x", 8), (3, None, 9),
                               (1, "Keep, A1 b2 C3! and d4 (a1--b2\nc3) end.", 7)], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(1, "a1 b2 c3")], "item_id long, text string")
    got = sorted((r.doc_id, r.text, r.item_id) for r in decontaminate(d, b, "span", 3).collect())
    cut = "Keep,   ! and d4 (--\n) end."
    assert got == [(1, cut, 7), (1, cut, 7), (2, "a1 b2 x", 8), (3, None, 9)]
    with pytest.raises(ValueError):
        decontaminate(d, b, "other")


def test_empty_tables(spark):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    none = contamination(d, b.limit(0))
    assert none.filter(F.size("spans") > 0).count() == 0 and none.count() == len(docs)
    assert contamination(d.limit(0), b).count() == 0
    assert decontaminate(d, b.limit(0)).count() == len(docs)
