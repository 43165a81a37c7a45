import sys
import unicodedata

from pyspark.sql import functions as F

from textloom.functions.text import WHITESPACE_CLASS, _CHUNK, _SEPARATOR
from textloom.operators.encode import Tokenizer, encode
from textloom.operators.unigram import substring_counts

TEXTS = [None, "", " \t", "a b  a", "ﬁne ｆｉｎｅ fine", "x\x1cy\x1fz x\u0085y", "é é a", "᠎a​b"]


def expected(text):
    """White_Space as Java's pattern of the class has it."""
    space = "\t\n\x0b\f\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
    text = unicodedata.normalize("NFKC", text or "")
    return ["▁" + w for w in "".join(" " if c in space else c for c in text).split(" ") if w]


def test_split_agrees_with_the_white_space_class(spark):
    plain = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    cut = [c for c in plain if not _CHUNK.match(c)]
    assert [c for c in plain if not c.split()] == sorted({*cut, *(c for c in plain if _SEPARATOR.match(c))})
    row = spark.createDataFrame([(c,) for c in cut], "c string").filter(F.col("c").rlike(f"^[{WHITESPACE_CLASS}]$"))
    assert row.count() == len(cut) == 25


def test_pieces_and_their_counts_without_a_row_per_token(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string").repartition(2)
    tok = Tokenizer("unigram", None)
    got = {r.text: r.p for r in df.select("text", tok.pieces(F.col("text")).alias("p")).collect()}
    assert got == {t: expected(t) for t in TEXTS}
    words = [w for t in TEXTS * 3 for w in expected(t)]
    counts = tok.piece_counts(df)
    assert {r.word: r.n for r in counts.collect()} == {w: words.count(w) for w in words}
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_substring_counts_agree_with_plain_slices(spark):
    words = {"▁": 2, "▁aaa": 3, "▁a😀b": 5, "▁xé": 1, "": 4}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    plain = {}
    for w, n in words.items():
        for k in (1, 2, 3, 4):
            for i in range(len(w) - k + 1):
                plain[w[i:i + k]] = plain.get(w[i:i + k], 0) + n
    assert {r.piece: r.c for r in substring_counts(df, 4).collect()} == plain
    assert substring_counts(df.limit(0), 4).count() == 0


def test_pieces_counted_before_encode_alike(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    vocab = spark.createDataFrame([(5, "▁", "▁", False, -1.0), (6, "a", "a", False, -2.0), (7, "▁a", "▁a", False, -2.5)],
                                  "id int, piece string, text string, special boolean, score double")
    tok = Tokenizer("unigram", vocab)
    ids = lambda **o: {r.doc_id: r.input_ids for r in encode(df, tok, **o).collect()}
    got = ids()
    assert got[0] == got[1] == got[2] == [] and got[3] == [7, 5, 0, 7]
    assert got == ids(counted=tok.piece_counts(df)) == ids(broadcast_rows=1, hot_words=1)
