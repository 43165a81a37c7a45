import pytest
from pyspark.sql import functions as F

from textloom.llm import quotes as Q

THREAD = [
    (1, 0, "Hello there\nfirst question"),
    (1, 1, "> Hello there\n> first  QUESTION\nmy answer"),
    (1, 2, "On Monday, Ann wrote:\n> > first question\n> my answer\nthanks\n\nbye"),
    (1, 3, ">> first question\n> unknown line\nlost"),
    (1, 4, "a new start"),
    (1, 5, "> a new start\nyes\n>no space is a quote too"),
    (2, 1, "> Hello there\nother conversation"),
    (1, 6, "> yes\nyes"),
    (None, 1, "> x\nno conversation"), (3, None, "no turn"), (4, 0, None), (4, 1, ""), (4, 2, "> \n>\n"),
    (5, 0, "twice"), (5, 0, "twice"), (5, 1, "> twice\nok"),
]


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_links_and_threads(spark, block):
    df = spark.createDataFrame([(*r, "c", 1) for r in THREAD], "conv_id long, turn long, text string, depth string, level int")
    got = Q.link_quotes(df, block_turns=block).collect()
    assert len(got) == len(THREAD)
    by = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth, r.n_quoted, r.n_linked, r.clean_text) for r in got}
    assert by[1, 0] == (None, 0, 0, 0, 0, "Hello there\nfirst question")
    assert by[1, 1] == (0, 0, 1, 2, 2, "my answer")
    assert by[1, 2] == (1, 0, 2, 2, 2, "thanks\n\nbye")
    assert by[1, 3] == (0, 0, 1, 2, 1, "lost")  # the outermost level that links
    assert by[1, 4] == (None, 4, 0, 0, 0, "a new start")
    assert by[1, 5] == (4, 4, 1, 2, 1, "yes")
    assert by[1, 6] == (5, 4, 2, 1, 1, "yes")
    assert by[2, 1] == (None, 1, 0, 1, 0, "other conversation")
    assert by[None, 1] == (None, None, None, 0, 0, "no conversation")
    assert by[3, None][:3] == (None, None, None) and by[4, 2] == (None, 2, 0, 0, 0, "")
    assert by[4, 0][5] == by[4, 1][5] == "" and by[5, 1][:3] == (0, 0, 1)


@pytest.mark.parametrize("block", [3, 1024])
def test_a_line_that_everybody_writes(spark, block):
    rows = [(1, t, f"> same line\n> {'same line' if t % 2 else 'rare'}\nsame line\nown {t}") for t in range(40)]
    got = Q.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string"), block_turns=block).collect()
    assert {r.turn: (r.reply_to, r.depth) for r in got} == {t: (t - 1 if t else None, t) for t in range(40)}


def test_levels(spark):
    lines = ["> a", ">> a", "> > a", ">a", " > a", "a > b", ">>>x", ""]
    got = spark.createDataFrame([(x,) for x in lines], "s string").select(Q.level_of(F.col("s")), Q.bare(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, "a"), (2, "a"), (1, "a"), (1, "a"), (0, "a > b"), (3, "x"), (0, "")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, text string")
    assert Q.link_quotes(df).collect() == []


def test_own_sentences_that_look_like_attributions_stay(spark):
    rows = [("On Monday she wrote:\nI come", "On Monday she wrote:\nI come"), ("On x, y wrote:\n> q\nyes", "yes"),
            ("On x, y wrote:\r\n\n \n>> q\nyes", "\n \nyes"), ("end\nOn it he wrote:", "end\nOn it he wrote:")]
    got = spark.createDataFrame(rows, "t string, want string").withColumn("got", Q.without_quotes(F.col("t"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_own_text_keeps_what_only_looks_quoted(spark):
    rows = [(1, 0, ">>> print(1)\nis what I ran"), (1, 1, "On x, y wrote:\n> is what I ran\n> nobody said this\nI see\n> \nbye"),
            (1, 2, "On x, y wrote:\n> made up\nno"), (1, 3, None)]
    got = Q.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert {r.turn: r.own_text for r in got} == {0: ">>> print(1)\nis what I ran", 1: "> nobody said this\nI see\nbye",
                                                 2: "On x, y wrote:\n> made up\nno", 3: ""}
    assert {r.turn: (r.n_quoted, r.n_linked, r.reply_to) for r in got}[1] == (2, 1, 0)
