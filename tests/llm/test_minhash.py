"""MinHash groups against all pairs of full sets."""

import random

import numpy as np
import pytest

from textloom.llm import minhash
from textloom.llm.queries import QUERIES

from brute import components

SF = "/root/testdata/sf0.001"
rng = random.Random(13)


def shingles(text, k=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows):
    """per row (id, size, smallest id reachable)"""
    sets = [shingles(t) for _, t in rows]
    by_set = {}
    for r, s in enumerate(sets):
        by_set.setdefault(frozenset(s), []).append(r)
    distinct = [s for s in by_set if s]
    links = [(by_set[s][0], r) for s in distinct for r in by_set[s][1:]]
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 85 * len(a | b):
                links.append((by_set[a][0], by_set[b][0]))
    root = components(range(len(rows)), links)
    least = {}
    for r, (i, _) in enumerate(rows):
        least.setdefault(root[r], []).append(i)
    smallest = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    return sorted(((i, len(sets[r]), smallest[root[r]]) for r, (i, _) in enumerate(rows)), key=str)


def groups(spark, table, **options):
    docs = spark.createDataFrame([(i, t, b"x", 1) for i, t in table], "doc_id long, text string, node binary, n_shingles int")
    return sorted((tuple(r) for r in minhash.minhash_groups(docs, **options).collect()), key=str)


def words(n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def edited(text, share):
    out = list(text)
    for i in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[i] = words(1)[0]
    return out


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two\n"), (8, "a b c"),
         (9, "A b c"), (10, "É b c"), (11, "é b c"), (4, "one"), (4, "else entirely here"), (None, "a b c"),
         (None, "lonely null id"), (None, None), (12, "x" * 4000 + " y z"), (13, "a b c a b c a b c"), (14, "a b c a b c")]


def test_edge_cases_and_clashing_names(spark):
    assert groups(spark, EDGES) == brute(EDGES)


@pytest.mark.parametrize("options", [{}, {"max_bucket": 4}, {"max_bytes": 3000}])
def test_groups_are_those_of_all_pairs(spark, options):
    rows = []
    for _ in range(8):  # sizes around the threshold, the original with any id
        base = words(rng.randrange(40, 200))
        rows += [" ".join(edited(base, rng.choice([0.01, 0.02, 0.03, 0.05]))) for _ in range(14)] + [" ".join(base)]
    chain = words(120)
    for _ in range(12):
        rows.append(" ".join(chain))
        chain = chain[4:] + words(4)  # neighbours are linked, ends are not
    rows += [" ".join(words(30)) for _ in range(20)] + [rows[3]] * 4
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert groups(spark, rows, **options) == brute(rows)


def test_large_bucket_of_unlike_texts(spark):
    """All texts share half of their shingles: one bucket in many bands, few links."""
    common = words(150)
    rows = [" ".join(common + words(rng.choice([60, 70, 80]))) for _ in range(60)]
    rows += [" ".join(edited(r.split(), 0.01)) for r in rows[:9]]
    rows = list(enumerate(rows))
    assert groups(spark, rows, max_bucket=10, rows=2, bands=16) == brute(rows)


def test_parts_of_a_bucket_are_one_family(spark):
    """40 nodes share one band and no other; only two each are alike beyond it, whatever their parts."""
    sig = lambda i: np.array([7] * 5 + ([10_000 + i] + [1000 + i // 2] * 4) * 31, np.uint32).tobytes()
    nodes = spark.createDataFrame([(bytearray([i]), bytearray(sig(i))) for i in range(40)], "node binary, sig binary")
    found = {r.node[0]: r.family for r in minhash.families(nodes, 85, 5, 32, 1e-6, 4).collect()}
    assert all(i in found and found[i] == found[i + 1] for i in range(0, 40, 2))


def test_exact_threshold():
    base = [f"s{i}" for i in range(102)]  # 100 shingles
    assert len(shingles(" ".join(base))) == 100
    same, other = minhash.shingle_hashes(b" ".join(w.encode() for w in base)), None
    for cut in (85, 84):
        other = minhash.shingle_hashes(b" ".join(w.encode() for w in base[:cut + 2]))
        both = len(np.intersect1d(same, other))
        assert (100 * both >= 85 * (len(same) + len(other) - both)) == (cut == 85)


def test_families_in_parts_without_pivots(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PIVOTS", 0)
    base = words(100)
    rows = [" ".join(edited(base, s)) for s in (0.01, 0.02, 0.03, 0.04, 0.05) for _ in range(12)] + [" ".join(base)]
    rows = list(enumerate(rows))
    assert groups(spark, rows, max_bucket=7) == brute(rows)


def test_failed_links_are_followed_by_others(spark, monkeypatch):
    """A search that trusts anything still ends with exact components."""
    monkeypatch.setattr(minhash, "least_matches", lambda n, percent, miss: 0)
    base = words(80)
    rows = [" ".join(edited(base, s)) for s in (0.01, 0.02, 0.03, 0.04, 0.06, 0.08) for _ in range(5)]
    rows = list(enumerate(rows))
    assert groups(spark, rows, rows=1, bands=32) == brute(rows)


def test_hashes_of_texts_in_blocks(monkeypatch):
    text = " ".join(words(3000)).encode()
    whole = minhash.shingle_hashes(text)
    assert len(whole) == len(shingles(text.decode()))
    blocks = minhash.word_blocks
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(minhash, "word_blocks", lambda d, k, s=size: blocks(d, k, s))
        assert (minhash.shingle_hashes(text) == whole).all()
        assert (minhash.shingle_hashes(b"only two") == minhash.shingle_hashes(b"Only  two\n")).all()


def test_posterior_bound_by_integration():
    for n in (32, 96, 160):
        m = minhash.least_matches(n, 85, 1e-6)
        s = np.linspace(0, 1, 200_001)
        for k, enough in ((m, True), (m - 1, False)):
            density = s ** k * (1 - s) ** (n - k)
            assert (density[s >= 0.85].sum() / density.sum() >= 1e-6) == enough


def test_signatures_estimate_similarity():
    a, b = minhash.permutations(minhash.PERMUTATIONS, minhash.SEED)
    for share in (0.02, 0.1):
        x = words(2000)
        y = edited(x, share)
        hx, hy = (minhash.shingle_hashes(" ".join(t).encode()) for t in (x, y))
        true = len(np.intersect1d(hx, hy)) / len(np.union1d(hx, hy))
        assert abs((minhash.signature(hx, a, b) == minhash.signature(hy, a, b)).mean() - true) < 0.12


def test_empty_table(spark):
    assert groups(spark, [(1, None)]) == [(1, 0, 1)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.minhash_groups(none).count() == 0


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_minhash_near_dedup"](spark, SF).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
