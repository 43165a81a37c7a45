"""BPE training: chains of numbered symbols, and merges of a list that change places."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.operators import bpe


def _effects(words, merge):
    delta = Counter()
    for syms, n in words:
        after = bpe._merge(syms, *merge)
        for p in zip(syms, syms[1:]):
            delta[p] -= n
        for p in zip(after, after[1:]):
            delta[p] += n
    return {p: d for p, d in delta.items() if d}, [(bpe._merge(syms, *merge), n) for syms, n in words]


def test_chain_merges_like_the_plain_loop():
    r = random.Random(3)
    for wanted in (False, True):
        for _ in range(60):
            words = [([r.choice("abc") for _ in range(r.randrange(2, 12))], r.randrange(1, 9)) for _ in range(20)]
            of, merges, plain, want = bpe.Symbols(list("abc")), [], words, []
            for _ in range(8):
                merges.append(r.choice([p for syms, _ in plain for p in zip(syms, syms[1:])] or [("a", "b")]))
                change, plain = _effects(plain, merges[-1])
                want.append(change)
            triples = [of.triple(m) for m in merges]
            chain = bpe.SymbolChain(pa.array([[of.of(s) for s in syms] for syms, _ in words], pa.list_(pa.int32())),
                                    np.array([n for _, n in words]), np.unique([x << 32 | y for x, y, _ in triples]) if wanted else None)
            got = []
            for t in triples:
                found = chain.merge(*t)
                got.append({of.pair(c): d for c, d in zip(found[0].tolist(), found[1].tolist())} if found else {})
            assert got == want
            assert [[of.names[i] for i in w] for w in chain.words().to_pylist()] == [syms for syms, _ in plain]


def test_merges_that_only_touch_change_places_with_their_effects():
    r, swapped = random.Random(4), 0
    for _ in range(3000):
        words = [([r.choice("abcde") for _ in range(r.randrange(2, 12))], r.randrange(1, 9)) for _ in range(6)]
        q, p = ((r.choice("abcde"), r.choice("abcde")) for _ in range(2))
        of_q, after_q = _effects(words, q)
        of_p, _ = _effects(after_q, p)
        first, after_p = _effects(words, p)
        second, _ = _effects(after_p, q)
        if bpe._swap(q, p, of_q, of_p, set("abcde")):
            swapped += 1
            assert {x: d for x, d in of_p.items() if d} == first and {x: d for x, d in of_q.items() if d} == second
    assert swapped > 1000


def test_a_prediction_from_half_of_the_words_takes_few_jobs(spark):
    """Before, a list ended at the first merge that came in another order."""
    r = random.Random(5)
    parts = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 4))) for _ in range(60)]
    words = Counter("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(3000))
    df = spark.createDataFrame(sorted(words.items()), "w string, freq long").select(
        bpe.byte_symbols(F.col("w")).alias("syms"), "freq")
    one, half = [], []
    want = bpe._merge_loop(spark, df, 150, 2, 200_000, 10 ** 6, report=one)
    got = bpe._merge_loop(spark, df, 150, 2, 200_000, len(words) // 4, report=half)
    assert got == want and len(half) <= 12
