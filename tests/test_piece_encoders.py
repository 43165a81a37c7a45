"""Linear encoders against the plain definitions; rows that share ids."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.operators import encode as enc
from textloom.operators.piece_encoders import build_encoder

rng = random.Random(7)


def plain_bpe(merges, ids, piece):
    syms = [f"{b:02x}" for b in piece.encode()]
    rank = {m: i for i, m in enumerate(merges)}
    while True:
        best = min((p for p in zip(syms, syms[1:]) if p in rank), key=rank.get, default=None)
        if best is None:
            return [ids[s] for s in syms]
        out, i = [], 0
        while i < len(syms):
            if tuple(syms[i:i + 2]) == best:
                out.append(syms[i] + syms[i + 1])
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out


def bpe_spec(n, letters="abc"):
    """Any merges, also symbols that are made twice and in odd order."""
    symbols, merges = [f"{ord(c):02x}" for c in letters], []
    while len(merges) < n:
        m = rng.choice(symbols), rng.choice(symbols)
        if m not in merges and len(m[0] + m[1]) < 14:
            merges.append(m)
            symbols.append(m[0] + m[1])
    rng.shuffle(merges)
    return merges, {s: i for i, s in enumerate(dict.fromkeys(symbols))}


def test_bpe_equals_the_definition():
    for _ in range(60):
        merges, ids = bpe_spec(rng.randrange(1, 25))
        encode = build_encoder(("bytebpe", merges, ids))
        for _ in range(20):
            piece = "".join(rng.choice("abc") for _ in range(rng.randrange(30)))
            assert encode(piece) == plain_bpe(merges, ids, piece)


def plain_wordpiece(vocab, word):
    out, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            sub = word[start:end] if start == 0 else "##" + word[start:end]
            if sub in vocab:
                break
        else:
            return [0]
        out.append(vocab[sub])
        start = end
    return out


def test_wordpiece_equals_the_definition():
    for _ in range(200):
        pieces = {("##" if rng.random() < 0.6 else "") + "".join(rng.choice("ab#") for _ in range(rng.randrange(1, 5)))
                  for _ in range(rng.randrange(1, 14))}
        vocab = {p: i + 1 for i, p in enumerate(sorted(pieces))}
        encode = build_encoder(("wordpiece", vocab, 0, 100))
        for _ in range(40):
            word = "".join(rng.choice("ab#") for _ in range(rng.randrange(12)))
            assert encode(word) == plain_wordpiece(vocab, word), (vocab, word)
    assert build_encoder(("wordpiece", {"a": 1, "##a": 2}, 0, 3))("aaaa") == [0]


def plain_unigram(scores, word, unk=0):
    unk_score = min((s for _, s in scores.values()), default=0.0) - 10.0
    best, back = [0.0] + [-math.inf] * len(word), [None] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(end):
            hit = scores.get(word[start:end])
            if hit and best[start] + hit[1] > best[end]:
                best[end], back[end] = best[start] + hit[1], (start, hit[0])
        if best[end - 1] + unk_score > best[end]:
            best[end], back[end] = best[end - 1] + unk_score, (end - 1, unk)
    ids, at = [], len(word)
    while at:
        at, i = back[at]
        if not (i == unk and ids and ids[-1] == unk):
            ids.append(i)
    return ids[::-1]


def test_unigram_equals_the_definition():
    for _ in range(150):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 20))}
        scores = {p: (i + 1, rng.choice([-1.0, -2.0, -3.5, -rng.random() * 8])) for i, p in enumerate(sorted(pieces))}
        encode = build_encoder(("unigram", scores, 0))
        for _ in range(20):
            word = "".join(rng.choice("abcd") for _ in range(rng.randrange(14)))
            assert encode(word) == plain_unigram(scores, word), (scores, word)


def test_pieces_of_100000_characters_take_a_second():
    long = "".join(rng.choice("abc") for _ in range(100_000))
    merges, ids = bpe_spec(400)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(2000)] + ["a", "b", "c", "a" * 5000]
    scores = {w: (i, -float(len(w))) for i, w in enumerate(dict.fromkeys(words))}
    wordpiece = {p: i for i, p in enumerate(dict.fromkeys(words + ["##" + w for w in words]))}
    for spec in (("bytebpe", merges, ids), ("unigram", scores, 0), ("wordpiece", wordpiece, 0, 10 ** 6)):
        encode = build_encoder(spec)
        for text in (long, "a" * 100_000):
            start = time.process_time()
            assert encode(text)
            assert time.process_time() - start < 4, spec[0]  # about one on an idle core


@pytest.fixture(scope="module")
def word_tok(spark):
    counts = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 6)], "word string, freq long")
    return enc.Tokenizer("word", enc.word_level_vocab(counts))


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_rows_of_one_id_stay_apart(spark, word_tok, broadcast_rows):
    rows = [(1, "a b"), (1, "c d"), (1, "a b"), (None, "d"), (None, "c"), (2, None), (2, ""), (2, "a x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = enc.encode(df, word_tok, broadcast_rows=broadcast_rows)
    want = sorted([(1, [5, 6]), (1, [7, 8]), (1, [5, 6]), (None, [8]), (None, [7]), (2, []), (2, []), (2, [5, 0])], key=str)
    assert sorted(((r.doc_id, r.input_ids) for r in got.collect()), key=str) == want
    assert all(r.num_tokens == len(r.input_ids) for r in got.collect())
    back = enc.decode(got, word_tok, broadcast_rows=broadcast_rows)
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(
        [(1, "a b"), (1, "c d"), (1, "a b"), (None, "d"), (None, "c"), (2, ""), (2, ""), (2, "a")], key=str)


def test_pairs_of_one_id_stay_apart(spark, word_tok):
    rows = [(1, "a", "b"), (1, "c d", "a"), (1, "a", "b"), (None, "d", None)]
    df = spark.createDataFrame(rows, "pair_id long, s string, t string")
    got = enc.encode_pair(df, word_tok, "s", "t", max_length=3, max_target_length=2).collect()
    assert sorted(((r.pair_id, r.input_ids, r.labels) for r in got), key=str) == sorted(
        [(1, [5, 1, 1], [6, 1]), (1, [7, 8, 1], [5, 1]), (1, [5, 1, 1], [6, 1]), (None, [8, 1, 1], [1, 1])], key=str)


def test_special_tokens_alone_decode_to_an_empty_row(spark, word_tok):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, [5])], "doc_id long, input_ids array<int>")
    assert {r.doc_id: r.text for r in enc.decode(df, word_tok).collect()} == {1: "", 2: "", 3: "a"}
    assert df.filter(F.size("input_ids") > 0).count() == 2
