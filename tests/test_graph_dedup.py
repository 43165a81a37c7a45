import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import setjoin
from textloom.operators.dedup import dedup_near
from textloom.operators.graph import connected_components
from textloom.session import checkpoint_dir


def components(edges):
    root = {}

    def find(n):
        root.setdefault(n, n)
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


def test_components_of_a_long_chain_a_star_and_noise(spark):
    r = random.Random(1)
    chain = list(range(1000, 1200))
    r.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(5, i) for i in range(6, 60)] + [(3, 3), (70, 71), (71, 70), (70, 71)]
    edges += [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(70)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = components([e for e in edges if e[0] != e[1]])
    assert {x.id: x.component for x in got} == want and len(got) == len(want)


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def clusters(spark, sets, **options):
    """(id, cluster) of every row that is not its own cluster; sets become texts of one-word shingles."""
    rows = [(i, " ".join(f"w{x}" for x in s)) for i, s in sets.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {(x.doc_id, x.cluster) for x in dedup_near(df, k=1, keep_all=True, **options).collect() if x.duplicate}


def test_members_that_the_first_rejects_are_still_compared(spark):
    sets = {1: [1, 2, 3], 2: [10, 11, 12, 13], 3: [10, 11, 12, 13, 14], 4: [50], 5: [51], 6: [10, 11, 12, 13]}
    assert clusters(spark, sets) == {(3, 2), (6, 2)}


def brute(sets, threshold=0.8):
    ids = sorted(sets)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    found = components(edges)
    return {(i, c) for i, c in found.items() if i != c}


def test_copies_meet_through_an_original_with_the_largest_id(spark):
    base = set(range(100))
    sets = {i: base - set(range(10 * (i % 10), 10 * (i % 10) + 10)) | set(range(1000 * i, 1000 * i + 10)) for i in range(1, 51)}
    got = clusters(spark, sets | {999: base})
    assert got == brute(sets | {999: base}) and len(got) == 50


def test_large_buckets_of_mixed_members_equal_all_pairs(spark):
    r = random.Random(4)
    sets = {}
    for i in r.sample(range(1000), 40):
        kind = r.randrange(2)
        s = set(range(1000 * kind, 1000 * kind + 40))
        for x in r.sample(sorted(s), r.randrange(6)):
            s.remove(x)
            s.add(r.randrange(10_000, 10_000_000))
        sets[i] = s
    want = brute(sets)
    assert clusters(spark, sets) == want and len({c for _, c in want}) > 1


def test_near_copies_of_an_original_with_the_largest_id_are_one_cluster(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        at = 4 * i
        rows.append((i, " ".join(base[:at] + [f"x{i}_{k}" for k in range(15)] + base[at + 15:])))
    r.shuffle(rows)
    df = spark.createDataFrame([*rows, (999, " ".join(base))], "doc_id long, text string")
    assert {x.cluster for x in dedup_near(df, keep_all=True).collect()} == {0}


def test_near_duplicates_equal_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.cluster for r in dedup_near(docs, keep_all=True).collect()}
    import re
    from textloom.functions.text import WORD_PATTERN
    shingles = {}
    rows = docs.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0)).alias("w")).collect()
    for r in rows:
        shingles[r.doc_id] = {tuple(r.w[i:i + 5]) for i in range(max(1, len(r.w) - 4))}
    ids = sorted(shingles)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    want = components(edges)
    assert got == {i: want.get(i, i) for i in ids}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_random_sets_equal_all_pairs(spark, threshold):
    r = random.Random(int(threshold * 10))
    sets = {}
    for i in r.sample(range(10_000), 120):
        if sets and r.random() < 0.6:
            s = set(r.choice(list(sets.values())))
            for x in r.sample(sorted(s), min(len(s) - 1, r.randrange(6))):
                s.remove(x)
            s |= {r.randrange(60) for _ in range(r.randrange(4))}
        else:
            s = {r.randrange(60) if r.random() < 0.5 else r.randrange(10 ** 6) for _ in range(r.randrange(1, 40))}
        sets[i] = s
    assert clusters(spark, sets, threshold=threshold) == brute(sets, threshold)


def test_a_common_element_in_every_prefix(spark):
    """One group holds all sets, few of which are similar: more hubs than one are needed."""
    r = random.Random(9)
    sets = {i: {0, 1, 2, 3} | {100 * i + j for j in range(2)} for i in range(1, 70)}
    sets |= {i + 500: s | {0, 7} for i, s in r.sample(sorted(sets.items()), 12)}
    assert clusters(spark, sets, threshold=0.6) == brute(sets, 0.6)


def test_null_empty_and_repeated_rows_and_other_ids(spark):
    rows = [("b", None, 1), ("a", None, 2), ("d", "", 3), ("c", " \n", 4), ("e", "x y z", 5), ("f", "X y  z", 6),
            (None, "x y z", 7), ("g", "x y z w v u t s", 8), ("g", "other text", 9), ("e", "x y z", 10), (None, "alone", 11),
            (None, None, 12)]
    df = spark.createDataFrame(rows, "name string, body string, cluster_ int")
    got = sorted((tuple(x) for x in dedup_near(df, "name", "body", keep_all=True).collect()), key=lambda x: x[2])
    assert [(x[3], x[4]) for x in got] == [
        ("b", False), ("a", False), ("c", True), ("c", False), ("e", False), ("e", True), ("e", True), ("g", False),
        ("g", False), ("e", False), (None, False), (None, False)]
    assert dedup_near(df, "name", "body").count() == 9
    assert dedup_near(df.limit(0), "name", "body").count() == 0


def test_prefixes_hold_a_common_element_of_every_similar_pair():
    r = random.Random(3)
    for threshold in (0.5, 0.75, 0.8, 0.9):
        for _ in range(300):
            a = {r.randrange(40) for _ in range(r.randrange(1, 30))}
            b = {x for x in a if r.random() < 0.9} | {r.randrange(40) for _ in range(r.randrange(3))}
            if b and len(a & b) >= threshold * len(a | b):
                first = [set(sorted(s)[:setjoin.prefix_length(len(s), threshold)]) for s in (a, b)]
                assert first[0] & first[1]


def test_hot_elements_are_dealt_over_partitions(spark, monkeypatch):
    part = setjoin.shared_prefixes
    monkeypatch.setattr(setjoin, "shared_prefixes", lambda *a: part(*a, max_rows=3))
    r = random.Random(6)
    sets = {i: {0, 1} | {r.randrange(30) for _ in range(6)} for i in range(60)}
    assert clusters(spark, sets, threshold=0.6) == brute(sets, 0.6)


def test_sets_move_once_to_a_cell_not_once_per_pair(spark, monkeypatch):
    checkpoint_dir(spark)
    monkeypatch.setattr(setjoin, "_BLOCK_SETS", 8)
    r = random.Random(8)
    family = {f"{i:02}".encode(): sorted({x for x in range(60) if r.random() < 0.85}) for i in range(40)}
    sets = spark.createDataFrame([(bytearray(n), s) for n, s in family.items()], "node binary, sh array<long>")
    pairs = [(a, b) for a in family for b in family if a > b]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in pairs], "a binary, b binary")
    assert setjoin._cells(df, sets).count() <= 40 * 6 < len(pairs)  # five blocks; twice in its own
    similar = lambda a, b: len({*family[a]} & {*family[b]}) >= 0.75 * len({*family[a]} | {*family[b]})
    got = [(bytes(x.a), bytes(x.b), x.ok) for x in setjoin._verified(df, sets, 0.75).collect()]
    assert sorted(got) == sorted((a, b, similar(a, b)) for a, b in pairs)
    assert {ok for *_, ok in got} == {True, False}


def test_only_sets_whose_sketches_are_close_are_built_again(spark, monkeypatch):
    built = []
    of = setjoin.sets_of
    monkeypatch.setattr(setjoin, "sets_of", lambda words, k: built.append(words.count()) or of(words, k))
    sets = {i: {0, 1, 2, 3} | set(range(100 * i, 100 * i + 12)) for i in range(1, 41)}
    sets |= {i + 500: sets[i] | {7} for i in (3, 9)}
    assert clusters(spark, sets, threshold=0.6) == brute(sets, 0.6) == {(503, 3), (509, 9)}
    assert sum(built) < 10


@pytest.mark.parametrize("options", [{"whole_sets": 2}, {"whole_elements": 100}, {"node_bits": 7}])
def test_large_components_and_numbers_that_two_sets_share(spark, monkeypatch, options):
    from textloom.operators import dedup

    monkeypatch.setattr(dedup, "similar_texts", lambda *a: setjoin.similar_texts(*a, **options))
    r = random.Random(11)
    sets = {}
    for i in range(24):
        s = set(range(1000 * (i % 3), 1000 * (i % 3) + 30))
        sets[i] = s - set(r.sample(sorted(s), r.randrange(5))) | {r.randrange(10 ** 6) for _ in range(r.randrange(5))}
    assert clusters(spark, sets) == brute(sets) != set()


def test_sketches_pass_every_similar_pair_and_few_sets_equal_all_pairs():
    import numpy as np

    r = random.Random(12)
    for threshold in (0.5, 0.8, 1.0):
        plain = {}
        for i in range(150):
            s = set(r.choice(list(plain.values()))) if plain and r.random() < 0.5 else {r.randrange(2 ** 63) for _ in range(r.choice([3, 50, 64, 65, 200]))}
            for x in r.sample(sorted(s), r.randrange(min(len(s), 9))):
                s.remove(x)
            plain[i] = s | {r.randrange(2 ** 63) for _ in range(r.randrange(9))} if r.random() < 0.9 else s
        sets = {i: np.array(sorted(s), np.uint64) for i, s in plain.items()}
        sketches = {i: np.append(np.uint64(len(s)), setjoin.sketch(s)) for i, s in sets.items()}
        passed = {(a, b) for a in sets for b in sets if a < b and setjoin.may_be_similar(sketches[a], sketches[b], threshold)}
        right = {(a, b) for a in sets for b in sets if a < b and setjoin.similar(sets[a], sets[b], threshold)}
        assert right <= passed and len(passed) < 150 * 149 // 2
        order = r.sample(sorted(sets), len(sets))
        assert dict(setjoin.components_of(order, [sets[i] for i in order], threshold)) == components(right)
