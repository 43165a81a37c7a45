import random

import numpy as np
import pytest
import xxhash

from textloom.llm import simhash
from textloom.llm.simhash import (covering_masks, drop_near_duplicates, fingerprint, links,
                                  simhash_groups, spanning_links)

from brute import components

rng = random.Random(5)
WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa"]


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", "  \n", "one", "One two", "a b c d", "a b c d e",
                                  "É b c é d e f", "x" * 5000, " ".join(WORDS * 30)])
def test_fingerprint_matches_brute_force(text):
    assert fingerprint(text) == brute_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    import textloom.llm.common as common
    text = " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(3000)) + "\n\n  "
    whole = brute_fingerprint(text)
    small = common.word_blocks
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "word_blocks", lambda d, k, b=block: small(d, k, b))
        assert fingerprint(text) == whole


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & bits for m in masks)


def flip(x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


def cluster():
    """A chain, a dense ball, exact opposites and noise."""
    out = [0, (1 << 64) - 1]
    x = rng.getrandbits(64)
    for _ in range(60):
        out.append(x)
        x = flip(x, 4)
    c = rng.getrandbits(64)
    out += [flip(c, rng.randrange(1, 7)) for _ in range(200)]
    out += [rng.getrandbits(64) for _ in range(200)]
    return sorted(set(out))


def pairs(values, r):
    v = np.array(values, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= r):
            yield values[i], values[i + 1 + j]


def test_spanning_links():
    v = cluster()
    got = spanning_links(np.array(v, np.uint64), 4)
    assert len(got) < len(v)
    assert components(v, got) == components(v, pairs(v, 4))


@pytest.mark.parametrize("max_bucket", [16_384, 2])  # 2: every bucket is split until few bits are free
def test_links_lose_no_component(spark, max_bucket):
    v = cluster()
    signed = {x: x - (1 << 64) if x >> 63 else x for x in v}
    df = spark.createDataFrame([(signed[x],) for x in v], "fp long")
    got = [(a, b) for a, b in links(df, 4, max_bucket).collect()]
    back = {s: x for x, s in signed.items()}
    assert components(v, [(back[a], back[b]) for a, b in got]) == components(v, pairs(v, 4))


def rows():
    base = " ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(150))
    near = base.split()
    near[3] = "other"
    out = [(7, base), (3, base), (9, " ".join(near)), (4, None), (2, ""), (11, " \n"), (None, base),
           (None, None), (5, "x y"), (5, "x y"), (6, "X  y"), (8, "entirely different words here")]
    return out + [(20 + i, f"{i} " + " ".join(rng.choice(WORDS) for _ in range(40))) for i in range(30)]


def expected(data):
    fps = [brute_fingerprint(t) for _, t in data]
    comp = components(sorted(set(fps)), pairs(sorted(set(fps)), 4))
    least = {}
    for (i, _), f in zip(data, fps):
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return fps, comp, least


def test_groups_match_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, "c", 1, 2) for i, t in data],
                               "doc_id long, text string, root string, fp int, component_id int")
    got = simhash_groups(df).collect()
    fps, comp, least = expected(data)
    want = sorted(((i, f, least.get(comp[f])) for (i, _), f in zip(data, fps)), key=str)
    assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_one_row_of_each_group_stays(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(data)], "doc_id long, text string, _key int")
    got = drop_near_duplicates(df).collect()
    fps, comp, least = expected(data)
    assert len(got) == len({comp[f] for f in fps})
    assert {r.doc_id for r in got} == set(least.values())
    assert set(df.columns) == set(got[0].asDict())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(df).collect() == [] and drop_near_duplicates(df).collect() == []
