"""The three end-to-end flows, composed from the operators.

* ``packed_story_corpus``: delimiter-framed files -> routing -> trim/repair ->
  per-split exact dedup -> tokenizer trained on the train split -> encode ->
  EOS packing into ``sequence_len + 1`` chunks (or token totals) -> splits.
* ``tale_windows``: text files cut at 4+ newlines -> reflow, clean and affix
  -> encode -> windows of exactly every length in the sweep.
* ``finetune_batches``: labelled texts -> encode, specials, pad/truncate ->
  seeded shuffle and batches for train, plain batches for eval.

Each is one lazy plan apart from the tokenizer-training loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import batches as bt
from textloom.operators import bpe, dedup, order, packing
from textloom.operators import encode as enc
from textloom.operators.pretokenize import word_counts
from textloom.operators.unigram import train_unigram
from textloom.sources import files
from textloom.sources import text as src


def train_tokenizer(train_texts: DataFrame, kind: str = "bytebpe", vocab_size: int = 8000,
                    lower_case: bool = True) -> enc.Tokenizer:
    """A tokenizer of ``kind`` trained on ``train_texts.text``."""
    if kind == "bytebpe":
        vocab, merges = bpe.train_bpe(train_texts, vocab_size)
        return enc.Tokenizer("bytebpe", vocab, merges, specials=tuple(tx.SPECIAL_TOKENS[1:]))
    if kind == "wordpiece":
        vocab, merges = bpe.train_wordpiece(train_texts, vocab_size, lower_case=lower_case)
        return enc.Tokenizer("wordpiece", vocab, merges, lower_case=lower_case)
    if kind == "unigram":
        return enc.Tokenizer("unigram", train_unigram(train_texts, vocab_size))
    raise ValueError(f"unknown tokenizer kind {kind!r}")


def packed_story_corpus(spark: SparkSession, paths, data_slice: str = "combined",
                        kind: str = "bytebpe", vocab_size: int = 8000,
                        sequence_len: int | None = 256, repair_bytes: bool = True
                        ) -> tuple[DataFrame, enc.Tokenizer]:
    """Flow (a).  Returns ``(table, tokenizer)``: packed chunks per split, or
    per-split token totals when ``sequence_len`` is None.  Exact dedup runs
    per split and only for the combined slice (as in the source workflow).
    ``repair_bytes=False`` reads UTF-8 instead of windows-1252."""
    docs = src.read_delimited_docs(spark, paths, repair_bytes=repair_bytes).withColumn(
        "file_name", F.col("src_file"))
    docs = files.route_files(docs, "file_name", data_slice=data_slice)
    docs = docs.withColumn("rec", F.xxhash64("src_file", "src_block", "src_seq"))
    if data_slice == "combined":
        # keep the first copy in file order
        docs = dedup.dedup_exact(docs.select("rec", "split", "text", *src.RECORD_ORDER), "text",
                                 ["split"], list(src.RECORD_ORDER))
    # read and deduplicated once, for the training and for the encoding
    docs = docs.checkpoint(eager=True)
    train = docs.filter(F.col("split") == "train")
    if kind == "word":
        tok = enc.Tokenizer("word", enc.word_level_vocab(word_counts(train, "text")))
    else:
        tok = train_tokenizer(train.select("text"), kind, vocab_size)
    ids = enc.encode(docs.select("rec", "split", "text", *src.RECORD_ORDER), tok, "text",
                     ["rec", "split", *src.RECORD_ORDER])
    if sequence_len is None:
        return enc.token_totals(ids, ["split"]), tok
    eos = tok.special_id(tx.EOT)
    return packing.pack_eos(ids, sequence_len, eos, "input_ids", list(src.RECORD_ORDER), None,
                            ["split"]), tok


def tale_windows(spark: SparkSession, path: str, tok: enc.Tokenizer,
                 lengths=packing.TALE_LENGTHS, eos: str = tx.EOT, one_stream: bool = False) -> DataFrame:
    """Flow (b): tales between runs of newlines -> clean and affix -> one
    EOS-separated token stream per file, cut into windows of exactly each
    length (``one_stream``: a stream over all files, in the order of their names).
    Streams are packed by offsets, for all lengths in one pass."""
    tales = src.read_tales(spark, path).withColumn("text", tx.reflow_newlines("text"))
    tales = tales.withColumn("text", tx.affix(tx.collapse_blank_lines(
        tx.strip_one_leading_space("text")), "# ", ""))
    ids = enc.encode(tales, tok, "text", src.RECORD_ORDER)
    return packing.stream_windows(ids, lengths, tok.special_id(eos), "input_ids",
                                  src.RECORD_ORDER, [] if one_stream else ["src_file"])


def finetune_batches(labelled: DataFrame, tok: enc.Tokenizer, batch_size: int = 64,
                     max_length: int = 256, seed: int = 42, epoch: int = 0,
                     id_col: str = "doc_id") -> DataFrame:
    """Flow (c): encode with specials, pad/truncate, then train batches from a
    seeded shuffle (short last batch dropped) and, for every other split by
    itself, batches of twice the size in id order (last batch kept)."""
    ids = enc.encode(labelled, tok, "text", [id_col, "split", "label"]).drop("num_tokens")
    ids = enc.pad_truncate(enc.add_special_tokens(ids, tok), max_length, tok.special_id("<|pad|>"))
    ids = ids.checkpoint(eager=True)
    key = order.with_row_index(ids.filter(F.col("split") == "train").withColumn(
        "_tl_shuf", order.shuffle_key(seed, epoch, id_col)), ["_tl_shuf", id_col], size_col="_tl_total")
    train = bt.assign_batches(key, batch_size, drop_last=True, total="_tl_total").drop("_tl_shuf", "_tl_total")
    evals = order.with_row_index(ids.filter(F.col("split") != "train"), [id_col], partition_by=["split"])
    return train.unionByName(bt.assign_batches(evals, 2 * batch_size, drop_last=False))
