from collections import Counter

import pytest
from textloom.operators.piece_encoders import build_encoder
from pyspark.sql import functions as F

from textloom.functions import arrays as ar
from textloom.functions.text import SPECIAL_TOKENS
from textloom.operators import bpe, encode as enc, packing as pk


def _ids_df(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)],
                                 "doc_id long, input_ids array<int>")


def test_pack_eos_batches(spark):
    df = _ids_df(spark, [[1, 2, 3], [4, 5], [6, 7, 8, 9], [1]])
    out = pk.pack_eos(df, 3, 0, batch_size=2)
    got = [r.input_ids for r in out.orderBy("stream_id", "chunk_id").collect()]
    assert got == [[1, 2, 3, 0], [6, 7, 8, 9]]


def test_pack_short_batch_kept(spark):
    out = pk.pack_eos(_ids_df(spark, [[1]]), 3, 0, batch_size=2)
    assert [r.input_ids for r in out.collect()] == [[1, 0]]


def test_pack_whole_stream_matches_python(spark):
    import random
    rnd = random.Random(7)
    rows = [[rnd.randint(1, 50) for _ in range(rnd.randint(0, 40))] for _ in range(60)]
    df = _ids_df(spark, rows)
    L = 16
    got = [r.input_ids for r in pk.pack_eos(df, L - 1, 0).orderBy("chunk_id").collect()]
    flat = [t for r in rows for t in r + [0]]
    n = (len(flat) // L) * L
    assert got == [flat[i:i + L] for i in range(0, n, L)]
    # partition count does not change the result
    got2 = [r.input_ids for r in pk.pack_eos(df.repartition(7), L - 1, 0)
            .orderBy("chunk_id").collect()]
    assert got2 == got


def test_group_texts_aligned_columns(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [1, 0, 1]), (1, [4, 5, 6], [1, 0, 1])],
                               "doc_id long, input_ids array<int>, m array<int>")
    out = pk.group_texts(df, 4, 2, ["input_ids", "m"]).collect()
    assert [(r.input_ids, r.m) for r in out] == [([1, 2, 3, 4], [1, 0, 1, 1])]


def test_windows_shift_masks(spark):
    df = _ids_df(spark, [[1, 2, 3, 4, 5, 6, 7]])
    w = [r.input_ids for r in pk.overflow_windows(df, 3).orderBy("window_id").collect()]
    assert w == [[1, 2, 3], [4, 5, 6]]
    sh = pk.causal_shift(_ids_df(spark, [[1, 2, 3, 4]])).first()
    assert sh.input_ids == [1, 2, 3] and sh.labels == [2, 3, 4]
    m = pk.causal_labels_masked(_ids_df(spark, [[5, 0, 6, 0]]), 0).first()
    assert m.labels == [5, -100, 6, -100]
    s2 = pk.seq2seq_labels(spark.createDataFrame([([7, 8],)], "labels array<int>"), 0, 0,
                           max_target_length=4).first()
    assert s2.labels == [7, 8, -100, -100] and s2.decoder_input_ids == [0, 7, 8, 0]
    sw = pk.pack_sweep(_ids_df(spark, [list(range(300))]), (128, 256))
    assert sorted((r.seq_len, r.window_id) for r in sw.collect()) == [(128, 0), (128, 1), (256, 0)]


def test_pad_truncate_and_specials(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    r = df.select(ar.truncate_pad("ids", 5, 1).alias("a"), ar.attention_mask("ids", 5).alias("m"),
                  ar.truncate_pad("ids", 2, 1, keep_last=3).alias("t")).first()
    assert r.a == [5, 6, 7, 1, 1] and r.m == [1, 1, 1, 0, 0] and r.t == [5, 3]


def test_mlm_mask_rates(spark):
    n = 20000
    df = spark.createDataFrame([(0, [10] * n, [0] * n)],
                               "doc_id long, input_ids array<int>, special_tokens_mask array<int>")
    r = pk.mlm_mask(df, 4, 1000, seed=1).first()
    chosen = [i for i, l in enumerate(r.labels) if l != -100]
    share = len(chosen) / n
    assert 0.14 < share < 0.16
    masked = sum(1 for i in chosen if r.input_ids[i] == 4) / len(chosen)
    assert 0.77 < masked < 0.83
    again = pk.mlm_mask(df, 4, 1000, seed=1).first()
    assert again.labels == r.labels
    sp = spark.createDataFrame([(0, [10] * 100, [1] * 100)],
                               "doc_id long, input_ids array<int>, special_tokens_mask array<int>")
    assert set(pk.mlm_mask(sp, 4, 1000, seed=1).first().labels) == {-100}


def test_bpe_merge_is_left_to_right(spark):
    df = spark.createDataFrame([("a a a b", 1)], "syms string, freq long")
    assert bpe.apply_merges(df, [("a", "a")]).first()[0] == "aa a b"
    # a pair that only a later merge makes is not merged by an earlier one
    assert bpe.apply_merges(df, [("aa", "a"), ("a", "a")]).first()[0] == "aa a b"


def _python_bpe(words: Counter, n_merges: int, min_frequency: int):
    """Plain sequential greedy BPE with the same tie-break, for checking."""
    w = {tuple(f"{b:02x}" for b in k.encode()): c for k, c in words.items()}
    merges = []
    for _ in range(n_merges):
        pc = Counter()
        for syms, c in w.items():
            for p in zip(syms, syms[1:]):
                pc[p] += c
        if not pc:
            break
        (l, r), c = min(pc.items(), key=lambda kv: (-kv[1], kv[0]))
        if c < min_frequency:
            break
        merges.append((l, r))
        nw = {}
        for syms, cnt in w.items():
            out, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and (syms[i], syms[i + 1]) == (l, r):
                    out.append(l + r)
                    i += 2
                else:
                    out.append(syms[i])
                    i += 1
            nw[tuple(out)] = nw.get(tuple(out), 0) + cnt
        w = nw
    return merges


def test_bpe_training_exact(spark):
    from textloom.plans.tables import documents
    docs = documents(spark, "/root/testdata/sf0.001").filter("split = 'train'").limit(60)
    texts = [r.text for r in docs.collect()]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=4 + 256 + 60)
    got = [(r.left, r.right) for r in merges.orderBy("rank").collect()]
    import regex
    from textloom.functions.text import BYTE_LEVEL_PATTERN
    import re
    pat = regex.compile(re.sub(r"\\x\{([0-9A-Fa-f]+)\}",
                               lambda m: "\\U%08x" % int(m.group(1), 16), BYTE_LEVEL_PATTERN))
    words = Counter(m for t in texts for m in pat.findall(t))
    assert got == _python_bpe(words, 60, 2)
    assert vocab.count() == 4 + 256 + len(got)


def test_bpe_roundtrip_and_wordpiece(spark):
    texts = ["the cat sat on the mat", "the dog sat", "héllo wörld, the end!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=280, min_frequency=1)
    tok = enc.Tokenizer("bytebpe", vocab, merges, specials=tuple(SPECIAL_TOKENS[1:]))
    ids = enc.encode(df, tok)
    back = {r.doc_id: r.text for r in enc.decode(ids, tok).collect()}
    assert back == dict(enumerate(texts))
    wv, wm = bpe.train_wordpiece(df, vocab_size=60)
    wt = enc.Tokenizer("wordpiece", wv, wm)
    dec = {r.doc_id: r.text for r in enc.decode(enc.encode(df, wt), wt).collect()}
    assert dec[0] == "the cat sat on the mat"
    assert dec[2] == "hello world, the end!"
    raw = {r.doc_id: r.text for r in enc.decode(enc.encode(df, wt), wt, clean_up=False).collect()}
    assert raw[2] == "hello world , the end !"


def test_wordpiece_unknown_word(spark):
    vocab = spark.createDataFrame(
        [(i, s, s, True) for i, s in enumerate(SPECIAL_TOKENS)] +
        [(5, "ab", "ab", False), (6, "##c", "##c", False), (7, "a", "a", False)],
        "id int, piece string, text string, special boolean")
    tok = enc.Tokenizer("wordpiece", vocab)
    f = tok.piece_encoder()
    assert f("abc") == [5, 6] and f("abx") == [0] and f("a") == [7]


def test_word_level_vocab_and_decode(spark):
    counts = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "word string, freq long")
    v = enc.word_level_vocab(counts)
    assert [(r.id, r.piece) for r in v.orderBy("id").collect()][5:] == [(5, "a"), (6, "b"), (7, "c")]
    tok = enc.Tokenizer("word", v)
    df = spark.createDataFrame([(0, "a c zz b")], "doc_id long, text string")
    ids = enc.encode(df, tok).first()
    assert ids.input_ids == [5, 7, 0, 6] and ids.num_tokens == 4
    assert enc.decode(enc.encode(df, tok), tok).first().text == "a c b"
    # the hot/cold path (dictionary above the broadcast bound) gives the same ids
    hc = enc.encode(df, tok, hot_words=1, broadcast_rows=1).first()
    assert hc.input_ids == [5, 7, 0, 6]


def test_bpe_hot_cold_path(spark):
    texts = ["the cat sat on the mat", "the dog sat", "héllo wörld, the end!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocab, merges = bpe.train_bpe(df, vocab_size=270, min_frequency=1)
    tok = enc.Tokenizer("bytebpe", vocab, merges, specials=tuple(SPECIAL_TOKENS[1:]))
    a = {r.doc_id: r.input_ids for r in enc.encode(df, tok).collect()}
    b = {r.doc_id: r.input_ids for r in enc.encode(df, tok, hot_words=2, broadcast_rows=1).collect()}
    assert a == b


def test_unigram_train_and_roundtrip(spark):
    from textloom.operators.unigram import train_unigram
    texts = ["the cat sat on the mat", "the cat ate the rat", "a mat for the cat"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vocab = train_unigram(df, vocab_size=30, max_piece_len=6)
    rows = vocab.orderBy("id").collect()
    assert [r.piece for r in rows[:5]] == list(SPECIAL_TOKENS)
    assert len(rows) <= 30
    pieces = {r.piece for r in rows}
    assert {"▁", "t", "h", "e"} <= pieces  # single characters are never pruned
    tok = enc.Tokenizer("unigram", vocab)
    back = {r.doc_id: r.text for r in enc.decode(enc.encode(df, tok), tok).collect()}
    assert back == dict(enumerate(texts))
    f = tok.piece_encoder()
    assert f("▁q") == [f("▁")[0], 0]  # unknown character -> unknown id


@pytest.mark.parametrize("max_pairs,rebase,predict", [(200_000, 400, 100), (200_000, 3, 2), (5, 400, 3), (1, 2, 0), (200_000, 2, 0)])
def test_bpe_is_sequential_whatever_the_bounds(spark, max_pairs, rebase, predict):
    counts = {"abababab": 5, "banana": 7, "aaaaa": 3, "aaaa": 4, "cabcab": 6, "bcabc": 2, "xyxyx": 1, "nanb": 9}
    df = spark.createDataFrame(list(counts.items()), "w string, freq long").select(
        bpe.byte_symbols(F.col("w")).alias("syms"), "freq")
    got = bpe._merge_loop(spark, df, 60, 1, max_pairs, predict, rebase_every=rebase)
    assert [m[:2] for m in got] == _python_bpe(counts, 60, 1)


@pytest.mark.parametrize("predict", [500_000, 40])
def test_bpe_on_documents_is_sequential_and_reads_fewer_words(spark, predict):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 40").select("text")
    words = docs.select(F.explode(bpe.byte_level_tokens(F.col("text"))).alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).cast("long").alias("freq")).checkpoint()
    report = []
    got = bpe._merge_loop(spark, words.select(bpe.byte_symbols(F.col("w")).alias("syms"), "freq"), 300, 2, 200_000, predict,
                          rebase_every=100, report=report)
    want = _python_bpe(Counter({r["w"]: r["freq"] for r in words.collect()}), 300, 2)
    assert [m[:2] for m in got] == want and sum(r["taken"] for r in report) == len(want)
    if predict == 500_000:  # every word is predicted from: lists come true, and later ones read fewer words
        assert all(r["taken"] == r["tried"] for r in report) and len(report) < 8
        assert report[-1]["words"] < report[0]["words"]


def test_older_pairs_lead_to_every_word_that_holds_a_pair():
    import random
    r = random.Random(8)
    for _ in range(200):
        word = [r.choice("abc") for _ in range(r.randrange(2, 9))]
        merges, syms = [], list(word)
        for _ in range(5):
            if len(syms) > 1:
                merges.append(r.choice(list(zip(syms, syms[1:]))))
                syms = bpe._merge(syms, *merges[-1])
            merges.append((r.choice("abc"), r.choice("abc")))
            syms = bpe._merge(syms, *merges[-1])
        for p in zip(syms, syms[1:]):
            assert bpe.older_pairs([p], merges) & set(zip(word, word[1:]))


def test_wordpiece_stops_at_its_size(spark):
    texts = ["the cat sat on the mat", "the dog sat on a log"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    vocab, merges = bpe.train_wordpiece(df, vocab_size=40)
    m = [(r.left, r.right) for r in merges.orderBy("rank").collect()]
    assert 0 < len(m) == len(set(m)) and vocab.count() <= 40


def test_unigram_ends_and_keeps_every_character(spark):
    from textloom.operators.unigram import train_unigram
    df = spark.createDataFrame([(0, "abcdefghij klmnop"), (1, "qrstu abc")], "doc_id long, text string")
    vocab = train_unigram(df, vocab_size=15).collect()
    pieces = {r.piece for r in vocab if not r.special}
    assert pieces == set("abcdefghijklmnopqrstu") | {"▁"}
    assert train_unigram(df.limit(0)).filter("NOT special").count() == 0
    tok = enc.Tokenizer("unigram", train_unigram(df, vocab_size=40))
    assert {r.text for r in enc.decode(enc.encode(df, tok), tok).collect()} == {"abcdefghij klmnop", "qrstu abc"}


def test_unigram_expected_uses_by_enumeration():
    import math
    from textloom.operators.unigram import best_path, expected_uses, lattice
    logp = {p: math.log(x) for p, x in {"a": .2, "b": .1, "ab": .3, "ba": .15, "aba": .05, "bab": .2}.items()}

    def paths(w):
        if not w:
            yield ()
        for p in logp:
            if w.startswith(p):
                yield from ((p, *rest) for rest in paths(w[len(p):]))

    for w in ("ab", "abab", "ababa", "bbab"):
        edges = lattice(w, logp, 3)
        prob = {x: math.exp(sum(logp[p] for p in x)) for x in paths(w)}
        want = Counter()
        for x, v in prob.items():
            for p in x:
                want[p] += v / sum(prob.values())
        got = Counter()
        for (_, _, p, _), u in zip(edges, expected_uses(len(w), edges)):
            got[p] += u
        assert all(math.isclose(got[p], want[p], abs_tol=1e-12) for p in logp)
        assert math.isclose(sum(logp[p] for p in best_path(len(w), edges)), math.log(max(prob.values())))
    n = 3000  # below the range of doubles: the logarithms take over
    uses = expected_uses(n, lattice("ab" * (n // 2), logp, 3))
    assert all(0 <= u <= 1 + 1e-9 for u in uses) and expected_uses(1, []) is None


def test_encoder_takes_the_longest_piece_of_the_vocabulary():
    long = "▁abcdefghijklmnopqrst"
    f = build_encoder(("unigram", {long: (7, -1.0), "▁": (5, -9.0), "a": (6, -9.0)}, 0))
    assert f(long) == [7]
    g = build_encoder(("wordpiece", {"a": 1, "##a": 2}, 0, 5))
    assert g("aaaaa") == [1, 2, 2, 2, 2] and g("aaaaaa") == [0]


def test_unigram_reads_compatibility_forms(spark):
    from textloom.functions.text import nfkc
    df = spark.createDataFrame([("ﬁne ½",), ("plain  x",), (None,)], "s string")
    assert [r[0] for r in df.select(nfkc("s")).collect()] == ["fine 1⁄2", "plain  x", None]


def test_unigram_counts_of_many_words_equal_those_of_each():
    import math
    import random

    import numpy as np
    from textloom.operators import unigram as ug
    r = random.Random(6)
    seeds = {"".join(r.choice("abß😀") for _ in range(r.randrange(1, 5))) for _ in range(40)} | set("abß😀")
    trie = ug.Pieces(seeds, 4)
    for _ in range(5):
        logp = {p: math.log(r.random()) for p in seeds if len(p) == 1 or r.random() < 0.7}
        words = ["".join(r.choice("abß😀") for _ in range(r.randrange(1, 14))) for _ in range(50)] + ["ab" * 30, "a"]
        freq = np.array([float(r.randrange(1, 9)) for _ in words])
        got = np.zeros((2, len(trie.names)))
        trie.scored(trie.scores(logp)).uses(words, freq, *got)
        ex, vit = Counter(), Counter()
        for w, f in zip(words, freq):
            edges = ug.lattice(w, logp, 4)
            for (_, _, p, _), u in zip(edges, ug.expected_uses(len(w), edges)):
                ex[p] += f * u
            vit.update({p: f * n for p, n in Counter(ug.best_path(len(w), edges)).items()})
        assert all(math.isclose(got[0][i], ex[p], abs_tol=1e-9) and got[1][i] == vit[p] for i, p in enumerate(trie.names))
    tiny = trie.scored(trie.scores({p: -20.0 if len(p) > 1 else -30.0 for p in seeds}))
    got, alone = np.zeros((2, len(trie.names))), np.zeros((2, len(trie.names)))
    tiny.uses(["ab" * 30], np.array([2.0]), *got)  # below the range of doubles: word by word
    tiny.use("ab" * 30, 2.0, *alone)
    assert np.allclose(got, alone) and alone.sum() > 0


def test_only_chunks_at_the_ends_are_parts(spark):
    import numpy as np
    import pyarrow as pa

    rows = [("a", 0, 0, [1, 2, 3]), ("a", 0, 3, [4]), ("a", 0, 4, [5, 6, 7, 8, 9]), ("b", 0, 5, [10, 11]), ("b", 0, 9, [12] * 5)]
    names = ["seq_len", "_tl_j", "g", "_tl_stream", "_tl_s", "_tl_c0"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]),
         pa.array([len(r[3]) for r in rows]), pa.array([np.array(r[3], np.int32) for r in rows], pa.list_(pa.int32()))],
        ["g", "_tl_stream", "_tl_s", "_tl_n", "_tl_c0"])

    def cut(whole):
        return sorted((r["seq_len"], r["g"], r["_tl_j"], r["_tl_s"], r["_tl_c0"]) for out in pk._cutter(
            [2, 4], names, ["_tl_c0"], ["g"], whole)([batch]) for r in out.to_pylist())

    assert cut(True) == [(2, "a", 0, 0, [1, 2]), (2, "a", 1, 2, [3, 4]), (2, "a", 2, 4, [5, 6]), (2, "a", 3, 6, [7, 8]),
                         (2, "b", 5, 10, [12, 12]), (2, "b", 6, 12, [12, 12]), (4, "a", 0, 0, [1, 2, 3, 4]), (4, "a", 1, 4, [5, 6, 7, 8])]
    assert cut(False) == [(2, "a", 4, 8, [9]), (2, "b", 2, 5, [10]), (2, "b", 3, 6, [11]), (2, "b", 4, 9, [12]),
                          (4, "a", 2, 8, [9]), (4, "b", 1, 5, [10, 11]), (4, "b", 2, 9, [12, 12, 12]), (4, "b", 3, 12, [12, 12])]


def test_arr_str_leaves_null_ids_out(spark):
    from textloom.plans.q_tokens import arr_str
    df = spark.createDataFrame([(0, [5, None, 7]), (1, []), (2, None), (3, [None]), (4, [-100, 3])], "k int, a array<int>")
    got = {r.k: r.s for r in df.coalesce(1).select("k", arr_str("a").alias("s")).collect()}
    assert got == {0: "5 7", 1: "", 2: None, 3: "", 4: "-100 3"}
