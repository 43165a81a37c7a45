"""Quotation linking: conversations in reply order without their quotes.

A message's lines are parsed into nested quote levels.  Quoted lines are normalised
and hashed; each is linked to the latest earlier message of its conversation that
wrote the line itself; the lines of one level vote for the message quoted there.
The outermost level names the message replied to, and pointer doubling finds each
message's thread and depth.

A line that a conversation repeats without end is no single group: turns are dealt
into blocks of ``BLOCK_TURNS``, each block's last writer is carried to later blocks by
a window over blocks, and only a block is sorted at once.  Repeats inside a turn
collapse before any shuffle that needs order, so no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed

BLOCK_TURNS = 1024

# fixed values: quote marks at a line's start, and the line that announces a quote
_MARKS = r"^((?: ?>)+) ?"
# a line that announces quoted lines: these follow it, blank lines apart
_ATTRIBUTION = r"(?md)^On [^\n]*\bwrote:\r?\n(?=(?:[ \t\r\n]*\n)? ?>)"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def unannounced(text: Column) -> Column:
    """The text without the lines that announce quoted ones."""
    return F.regexp_replace(text, _ATTRIBUTION, "")


def level_of(line: Column) -> Column:
    """Number of quote marks before a line; 0 for the author's own."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), " ", ""))


def bare(line: Column) -> Column:
    return F.regexp_replace(line, _MARKS, "")


def normalised(line: Column) -> Column:
    """Lower case, white space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def without_quotes(text: Column) -> Column:
    """The author's own lines: no quoted line, no line that announces one."""
    own = F.filter(lines_of(unannounced(text)), lambda x: ~x.rlike(_MARKS))
    return F.array_join(own, "\n")


def without_linked(text: Column, linked: Column) -> Column:
    """The text without its quoted lines that are ``linked`` (array of level and hash,
    null: none) and without lines that announce quoted ones.  A line that only looks
    quoted stays; a text without a linked line stays as it is."""
    def goes(line: Column) -> Column:
        key = F.struct(level_of(line).alias("level"), F.xxhash64(normalised(bare(line))).alias("hash"))
        return line.rlike(_MARKS) & ((normalised(bare(line)) == "") | F.array_contains(linked, key))

    own = F.array_join(F.filter(lines_of(unannounced(text)), lambda x: ~goes(x)), "\n")
    return F.when(linked.isNull(), F.coalesce(text, F.lit(""))).otherwise(own)


def parsed_lines(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """``conv, turn, level, hash, n``: each distinct non-empty line of a message
    at each level, and how often it stands there."""
    d = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.explode(lines_of(unannounced(F.col(text)))).alias("_line"))
    d = d.select(
        "conv", "turn", level_of(F.col("_line")).alias("level"), normalised(bare(F.col("_line"))).alias("_n"))
    return (d.filter("_n <> '' AND conv IS NOT NULL AND turn IS NOT NULL")
            .groupBy("conv", "turn", "level", F.xxhash64("_n").alias("hash")).agg(F.count("*").alias("n")))


def linked_lines(lines: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Quoted lines with ``source``: the latest earlier turn of the conversation
    that has the line as its own, or null."""
    d = lines.withColumn("block", F.floor(F.col("turn") / block_turns))
    d = d.withColumn("own", F.when(F.col("level") == 0, F.col("turn")))
    group = ["conv", "hash"]
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (d.groupBy(*group, "block").agg(F.max("own").alias("_last"), F.max("level").alias("_deep"))
               .withColumn("_carry", F.max("_last").over(before))
               .filter("_deep > 0").select(*group, "block", "_carry"))
    # own lines come after the quotes of the same turn: nobody quotes himself
    inside = (Window.partitionBy(*group, "block").orderBy("turn", F.col("level") == 0)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = d.withColumn("_seen", F.max("own").over(inside)).filter("level > 0")
    return seen.join(carried, [*group, "block"]).select(
        "conv", "turn", "level", "hash", "n", F.coalesce("_seen", "_carry").alias("source"))


def quoted_messages(links: DataFrame) -> DataFrame:
    """``conv, turn, level, source, votes``: the message quoted at each level, by
    most lines, then the latest."""
    votes = links.filter("source IS NOT NULL").groupBy("conv", "turn", "level", "source").agg(F.sum("n").alias("votes"))
    best = votes.groupBy("conv", "turn", "level").agg(F.max(F.struct("votes", "source")).alias("_b"))
    return best.select("conv", "turn", "level", "_b.source", "_b.votes")


def threads(replies: DataFrame) -> DataFrame:
    """``replies(conv, turn, reply_to)`` with ``thread`` (the first message
    reached by replies) and ``depth``.  Each round doubles the distance looked
    back, for the messages that have not reached their first one yet; replies
    point to earlier turns, so it ends."""
    first = F.col("reply_to").isNull()
    state = checkpointed(replies.select(
        "conv", "turn", "reply_to", F.coalesce("reply_to", "turn").alias("up"),
        F.when(first, 0).otherwise(1).cast("long").alias("depth"), first.alias("ended")))
    done, active = state.filter("ended"), state.filter("NOT ended")
    while not active.isEmpty():
        far = done.unionByName(active).select("conv", F.col("turn").alias("up"), F.col("up").alias("_up"),
                                              F.col("depth").alias("_depth"), F.col("ended").alias("_ended"))
        step = checkpointed(active.join(far, ["conv", "up"], "left").select(
            "conv", "turn", "reply_to", F.coalesce("_up", "up").alias("up"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.coalesce("_ended", F.lit(True)).alias("ended")))
        done, active = done.unionByName(step.filter("ended")), step.filter("NOT ended")
    return done.select("conv", "turn", "reply_to", F.col("up").alias("thread"), "depth")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text",
                block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per row of ``messages``: its conversation and turn, ``reply_to``,
    ``thread``, ``depth``, ``n_quoted`` (quoted lines), ``n_linked`` (those found),
    ``clean_text`` (no line with a quote mark) and ``own_text`` (only linked quotes
    are gone: lines that look quoted but link to nothing stay).  Sorting by
    ``(conversation, thread, depth, turn)`` is reply order.

    Null texts are empty; rows without a conversation or turn are threads of
    their own (null); messages that repeat a turn share its links."""
    lines = checkpointed(parsed_lines(messages, conv_col, turn_col, text_col))
    links = checkpointed(linked_lines(lines, block_turns))
    counts = links.groupBy("conv", "turn").agg(
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("source").isNotNull(), F.col("n"))).alias("n_linked"),
        # null without a linked line; no longer than the message
        F.collect_set(F.when(F.col("source").isNotNull(), F.struct("level", "hash"))).alias("_linked"))
    counts = counts.withColumn("_linked", F.when(F.size("_linked") > 0, F.col("_linked")))
    quoted = quoted_messages(links).groupBy("conv", "turn").agg(F.min_by("source", "level").alias("reply_to"))
    turns = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn")).distinct()
    turns = turns.filter("conv IS NOT NULL AND turn IS NOT NULL")
    found = threads(turns.join(quoted, ["conv", "turn"], "left")).join(counts, ["conv", "turn"], "left")
    d = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        without_quotes(F.col(text_col)).alias("clean_text"), F.col(text_col).alias("_text"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return d.join(found, ["conv", "turn"], "left").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "reply_to", "thread", "depth",
        zero("n_quoted"), zero("n_linked"), "clean_text",
        without_linked(F.col("_text"), F.col("_linked")).alias("own_text"))
