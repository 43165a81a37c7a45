import math
import random
import re
import zlib

import numpy as np
import pytest

from textloom.llm import quality as Q

rng = random.Random(4)


def brute_rules(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


TEXTS = [None, "", " \n\t", "a", "a b c", "a a a a", "a a a", "x y z x y z q", "é#*$ %&|<> é\n\né#*$ %&|<> é\n é\n",
         "l\nl\nl \n \n \n", "a b c d\x0ba b c", "one two  three", "\x1c \x85"] + [
    " ".join(rng.choice("abc") for _ in range(rng.randrange(2, 60))) for _ in range(40)]


@pytest.mark.parametrize("text", TEXTS)
def test_rules_match_brute_force(text):
    assert Q.rules(text) == brute_rules(text)


def test_many_distinct_words(monkeypatch):
    words = [str(rng.randrange(6)) for _ in range(200)]
    want = Q.repeated_words([w.encode() for w in words])
    assert want == brute_rules(" ".join(words))[4]


def brute_ngrams(text, buckets):
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\r\x0b\x0c]+", (text or "").encode())
    h = [zlib.crc32(t) for t in found]
    mix = lambda x: (x * 0x9E3779B97F4A7C15 % 2**64 >> 32) % buckets
    return [mix(x) for x in h] + [mix(a * 31 + b + 1) for a, b in zip(h, h[1:])]


@pytest.mark.parametrize("block", [1 << 20, 1000, 7, 1])
def test_ngrams_do_not_depend_on_blocks(block):
    for text in ("ab cd, ef!! gh ij kl mn op qr", "x" * 3000, "!?" * 900 + "a\n\n  b", " \n", "é日 本,x " * 400,
                 " ".join(rng.choice(["the", "of,", "##!", "tree\n"]) * rng.randrange(4) for _ in range(2000))):
        got = sorted(int(x) for g in Q.ngram_buckets(text, 997, block) for x in g)
        assert got == sorted(brute_ngrams(text, 997))


def corpus():
    good = [" ".join(rng.choice(["the", "of", "and", "house", "tree"]) for _ in range(80 + i)) for i in range(30)]
    bad = [" | ".join(rng.choice(["###", "$$$", "zz"]) + str(i) for _ in range(80)) for i in range(15)]
    docs = [(i, t) for i, t in enumerate(good + bad)] + [(100, None), (101, ""), (None, good[0]), (0, good[0])]
    labels = [(i, int(i < 30), 0) for i in range(0, 45, 2)] + [(None, 1, 0), (1, 1, 1), (3, 1, None), (2, None, None)]
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(d, t, True, 0) for d, t in docs], "doc_id long, text string, kept boolean, score int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_scores_match_brute_force(spark):
    docs, labels = corpus()
    d, lab = frames(spark, docs, labels)
    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    n = Q.BUCKETS
    raw, target = np.zeros(n), np.zeros(n)
    for i, t in docs:
        for g in brute_ngrams(t, n):
            raw[g] += 1
            target[g] += i in trusted
    ratio = lambda g: math.log((target[g] + 1) / (target.sum() + n)) - math.log((raw[g] + 1) / (raw.sum() + n))
    model = Q.model(d, lab)
    got = Q.quality(d, model).collect()
    assert len(got) == len(docs)
    want = []
    for i, t in docs:
        g = brute_ngrams(t, n)
        s = sum(map(ratio, g)) / len(g) if g else 0.0
        b = brute_rules(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((i, *b, failed, not failed and s >= Q.THRESHOLD, round(s, 9)))
    assert sorted(((*r[:8], round(r[8], 9)) for r in got), key=str) == sorted(want, key=str)
    kept = Q.keep_good(d, model)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if w[7])


def test_trusted_sample_is_bounded(spark):
    _, lab = frames(spark, *corpus())
    assert Q.trusted_ids(lab, 5).count() == 5


def test_empty_tables(spark):
    docs, labels = corpus()
    d, lab = frames(spark, docs, labels)
    assert Q.quality(d.limit(0), Q.model(d.limit(0), lab)).collect() == []
    assert not Q.model(d, lab.limit(0)).any()  # no trusted documents: the rules alone decide


def test_separates_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.quality(docs, Q.model(docs, labels)).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.02 * len(bad)
