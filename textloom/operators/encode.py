"""Encoding and decoding with tokenizers stored as tables.

Encoding is a dictionary job, not a per-row library call:

1. explode every text into pre-tokenizer pieces;
2. ``groupBy(piece)`` -> the distinct pieces (partial aggregation);
3. encode each distinct piece once (``mapInPandas``; the vocabulary and
   merges are bounded by the vocabulary size and shipped as a broadcast
   variable);
4. look the pieces of each row up in place (``lookup``): the whole dictionary
   by broadcast when it passes a checked row bound, otherwise the most frequent
   pieces; only the rest of the pieces become rows, join the dictionary by
   shuffle and go back into their gaps.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrays import (added_specials_mask, attention_mask, truncate_pad, truncate_pad_special,
                                       with_specials)
from textloom.functions.text import (SPECIAL_TOKENS, byte_level_tokens, nfkc_chunk_counts, nfkc_chunks,
                                     normalize_text_col, word_tokens)
from textloom.operators.bounded import TooLargeToBroadcast
from textloom.operators.lookup import ROW, replace_keys
from textloom.operators.piece_encoders import build_encoder
from textloom.session import checkpoint_dir

UNK, PAD, CLS, EOS, MASK = SPECIAL_TOKENS
METASPACE = "▁"
# fixed values: spaces that a WordPiece decoder takes out again
CLEAN_UP = ((" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"), (" 'm", "'m"),
            (" do not", " don't"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"))


@dataclass
class Tokenizer:
    """A tokenizer as tables: ``vocab(id, piece, text, special[, score])`` and,
    for BPE models, ``merges(rank, left, right)``."""
    model: str  # 'bytebpe' | 'wordpiece' | 'unigram' | 'word'
    vocab: DataFrame
    merges: DataFrame | None = None
    lower_case: bool = True
    specials: tuple = tuple(SPECIAL_TOKENS)
    max_vocab: int = 1 << 20
    max_word_chars: int = 100  # WordPiece: longer words are unknown (the library's default)
    _local: dict = field(default_factory=dict, repr=False)

    # -- pre-tokenisation -------------------------------------------------
    def pieces(self, text: Column) -> Column:
        if self.model == "bytebpe":
            return byte_level_tokens(text)
        if self.model == "wordpiece":
            return word_tokens(normalize_text_col(text, self.lower_case, True))
        if self.model == "unigram":
            return nfkc_chunks(text, METASPACE)
        return word_tokens(text)

    def piece_counts(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """``(word, n)``: the distinct pieces of all texts and how often each stands there."""
        texts = df.select(F.col(text_col).alias("text"))
        if self.model == "unigram":
            return nfkc_chunk_counts(texts, METASPACE)
        return texts.select(F.explode(self.pieces(F.col("text"))).alias("word")).groupBy("word").agg(
            F.count(F.lit(1)).cast("long").alias("n"))

    # -- bounded driver-side copies (vocabulary-sized) ----------------------
    def _tables(self):
        if not self._local:
            rows = self.vocab.limit(self.max_vocab + 1).collect()
            if len(rows) > self.max_vocab:
                raise ValueError("vocabulary larger than max_vocab")
            self._local["vocab"] = rows
            if self.merges is not None:
                self._local["merges"] = [(r["left"], r["right"]) for r in
                                         sorted(self.merges.collect(), key=lambda r: r["rank"])]
        return self._local

    def special_id(self, token: str) -> int | None:
        """Special tokens always take the first ids, in ``specials`` order."""
        return self.specials.index(token) if token in self.specials else None

    def special_ids(self) -> list[int]:
        return list(range(len(self.specials)))

    def encoder_spec(self) -> tuple:
        """Plain data (vocabulary-sized) from which a task builds its encoder."""
        t = self._tables()
        if self.model == "bytebpe":
            return ("bytebpe", t["merges"], {r["piece"]: int(r["id"]) for r in t["vocab"]})
        if self.model == "wordpiece":
            return ("wordpiece", {r["text"]: int(r["id"]) for r in t["vocab"] if not r["special"]},
                    self.special_id(UNK), self.max_word_chars)
        if self.model == "unigram":
            return ("unigram", {r["piece"]: (int(r["id"]), float(r["score"])) for r in t["vocab"]
                                if not r["special"]}, self.special_id(UNK))
        raise ValueError("word-level encoding is a join, not a piece encoder")

    def piece_encoder(self):
        """Python function ``str -> list[int]`` for one distinct piece."""
        return build_encoder(self.encoder_spec())


# ---------------------------------------------------------------- the encode job
ENC_SCHEMA = T.StructType([T.StructField("word", T.StringType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n", T.LongType())])


def encode_dictionary(words: DataFrame, tok: Tokenizer) -> DataFrame:
    """(word, n) -> (word, ids, n): every distinct piece encoded once."""
    if tok.model == "word":
        unk = tok.special_id(UNK)
        v = tok.vocab.filter(~F.col("special")).select(F.col("piece").alias("word"), "id")
        return (words.join(v, "word", "left")
                .select("word", F.array(F.coalesce("id", F.lit(unk))).alias("ids"), "n"))
    spark = words.sparkSession
    bc = spark.sparkContext.broadcast(tok.encoder_spec())
    # the distinct-word table is small next to the corpus; spread it over all
    # cores before the Python encoder
    words = words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = build_encoder(bc.value)
        for pdf in it:
            yield pd.DataFrame({"word": pdf["word"],
                                "ids": [enc(w) for w in pdf["word"]],
                                "n": pdf["n"]})
    return words.mapInPandas(run, ENC_SCHEMA)


def _numbered(df: DataFrame, id_cols: list[str], *content: str) -> DataFrame:
    """Rows with a key that recomputation cannot change: a hash of the content and
    a number among the rows that are equal in id and hash."""
    h = F.xxhash64(*content)
    n = F.row_number().over(Window.partitionBy(*id_cols, h).orderBy(F.lit(0)))
    return df.withColumn(ROW, F.concat_ws("-", h.cast("string"), n.cast("string")))


def _most_frequent(dictionary: DataFrame, n: int) -> DataFrame:
    """At most ``n`` of the pieces of bounded length, the most frequent: counts in
    steps of a 16th of a doubling, so that no task sorts them."""
    some = dictionary.filter(F.length("word") <= 256).withColumn("_tl_f", F.floor(16 * F.log2("n")))
    room, least = n, None
    for f, rows in sorted(((r["_tl_f"], r["count"]) for r in some.groupBy("_tl_f").count().collect()), reverse=True):
        room -= rows
        if room < 0:
            break
        least = f
    return some.filter(F.lit(False) if least is None else F.col("_tl_f") >= least)


def encode(df: DataFrame, tok: Tokenizer, text_col: str = "text", id_cols=("doc_id",),
           out_col: str = "input_ids", hot_words: int = 200_000,
           broadcast_rows: int = 500_000, broadcast_bytes: int = 64 << 20,
           counted: DataFrame | None = None) -> DataFrame:
    """T7 + T8: ``input_ids`` and ``num_tokens`` for every row of ``df``.

    One pass over the token stream, which stays in its rows (``lookup``).  A
    dictionary (distinct pieces) within a checked bound of ``broadcast_rows``
    rows and ``broadcast_bytes`` bytes is broadcast whole.  Beyond the bound,
    about the ``hot_words`` most frequent pieces are, and only the other
    pieces of a text meet the dictionary by shuffle.

    ``counted``: ``(word, n)`` of all pieces (``piece_counts``) where the caller has it.
    Every row gives a row, also rows with the same ids; null and empty texts
    give no tokens."""
    id_cols = list(id_cols)
    if tok.model == "word":
        # the vocabulary is the dictionary; ids are frequency ranks
        body = tok.vocab.filter(~F.col("special"))
        cold = body.select(F.col("piece").alias("key"), F.array("id").alias("values"))
        hot = body.filter((F.col("id") < len(tok.specials) + hot_words) & (F.length("piece") <= 256)).select(
            F.col("piece").alias("key"), F.array("id").alias("values"))
        missing = [tok.special_id(UNK)]
    else:
        words = tok.piece_counts(df, text_col) if counted is None else counted
        checkpoint_dir(df.sparkSession)
        # distinct pieces encoded once; checkpointed so the Python encoder never reruns
        enc = encode_dictionary(words, tok).checkpoint(eager=True)
        cold = enc.select(F.col("word").alias("key"), F.col("ids").alias("values"))
        hot, missing = None, []
    probe = cold.limit(broadcast_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("key") + 4 * F.size("values") + 32).alias("b")).first()
    rows, pieces = df.select(*id_cols, text_col), tok.pieces(F.col(text_col))
    if probe["n"] <= broadcast_rows and (probe["b"] or 0) <= broadcast_bytes:
        hot, cold = cold, None
    elif hot is None:
        hot = _most_frequent(enc, hot_words).select(F.col("word").alias("key"), F.col("ids").alias("values"))
    out = replace_keys(rows, pieces, out_col, hot, cold, missing, id_cols)
    return out.select(*id_cols, out_col).withColumn("num_tokens", F.size(out_col).cast("long"))


def token_totals(df: DataFrame, group_cols=("split",), n_col: str = "num_tokens") -> DataFrame:
    """Total tokens per group."""
    return df.groupBy(*group_cols).agg(F.sum(n_col).cast("long").alias("total_tokens"),
                                       F.count(F.lit(1)).cast("long").alias("n_rows"))


def add_special_tokens(df: DataFrame, tok: Tokenizer, ids_col: str = "input_ids",
                       cls_token: str = CLS, sep_token: str = EOS) -> DataFrame:
    """``[cls] ids [sep]`` plus ``special_tokens_mask`` (1 at the two added
    positions only; an unknown-word id inside the text is not marked)."""
    cls_id, sep_id = tok.special_id(cls_token), tok.special_id(sep_token)
    out = df.withColumn(ids_col, with_specials(ids_col, cls_id, sep_id))
    return out.withColumn("special_tokens_mask", added_specials_mask(ids_col))


def pad_truncate(df: DataFrame, max_length: int, pad_id: int, ids_col: str = "input_ids",
                 keep_last: int | None = None, aligned: dict[str, int] | None = None) -> DataFrame:
    """Truncate and right-pad to ``max_length``; ``attention_mask`` marks
    the real tokens.

    ``aligned`` columns (name -> pad value) are cut and padded in step;
    ``special_tokens_mask`` (pads count as special) always is when it is there,
    and then a row that ends in a special token keeps it.  ``keep_last`` keeps
    that id at the end of every cut row instead."""
    masked = "special_tokens_mask"
    aligned = dict(aligned or {})
    if masked in df.columns:
        aligned.setdefault(masked, 1)
    out = {"attention_mask": attention_mask(F.col(ids_col), max_length)}
    for c, pad in {ids_col: pad_id, **aligned}.items():
        if keep_last is not None:
            last = keep_last if c == ids_col else 1 if c == masked else pad
            out[c] = truncate_pad(c, max_length, pad, last)
        elif masked in df.columns:
            out[c] = truncate_pad_special(c, masked, max_length, pad)
        else:
            out[c] = truncate_pad(c, max_length, pad)
    return df.withColumns(out)


def encode_pair(df: DataFrame, tok: Tokenizer, src_col: str, tgt_col: str, id_cols=("pair_id",),
                max_length: int = 768, max_target_length: int = 128) -> DataFrame:
    """Source ids padded to ``max_length`` with mask; target ids cut and
    padded to ``max_target_length`` become ``labels``; raw text columns removed."""
    pad, key = tok.special_id(PAD), [*id_cols, "_tl_pair"]
    # equal pairs have equal results, so their number among each other is a key too
    df = _numbered(df.select(*id_cols, src_col, tgt_col), list(id_cols), src_col, tgt_col).withColumnRenamed(ROW, "_tl_pair")
    src = encode(df, tok, src_col, key).drop("num_tokens")
    tgt = encode(df, tok, tgt_col, key, out_col="labels").drop("num_tokens")
    src = pad_truncate(src, max_length, pad)
    tgt = tgt.withColumn("labels", truncate_pad("labels", max_target_length, pad))
    same = [src[c].eqNullSafe(tgt[c]) for c in key]
    return src.join(tgt, same).select(*[src[c] for c in src.columns if c != "_tl_pair"], "labels")


def decode(df: DataFrame, tok: Tokenizer, ids_col: str = "input_ids", id_cols=("doc_id",),
           out_col: str = "text", skip_special: bool = True, hot_words: int = 200_000,
           broadcast_rows: int = 500_000, clean_up: bool = True) -> DataFrame:
    """Ids back to text (special tokens dropped by default).

    The vocabulary is broadcast behind a counted bound; of a larger word-level
    one the most frequent ids are, and only the others meet it by shuffle.
    Every row gives a row, also rows with the same ids."""
    id_cols = list(id_cols)
    unit = F.col("piece") if tok.model == "bytebpe" else F.col("text")
    if skip_special:  # a text of special tokens alone keeps its row
        unit = F.when(~F.coalesce(F.col("special"), F.lit(False)), unit)
    units = tok.vocab.select(F.col("id").alias("key"), F.array_compact(F.array(unit)).alias("values"))
    hot, cold = units, None
    # trained vocabularies are bounded by their size, word ids are frequency ranks
    bound = broadcast_rows if tok.model == "word" else tok.max_vocab
    if units.limit(bound + 1).count() > bound:
        if tok.model != "word":
            raise TooLargeToBroadcast(f"vocabulary: more than {bound} rows; use a shuffle join")
        hot, cold = units.filter(F.col("key") < len(tok.specials) + hot_words), units
    found = replace_keys(df.select(*id_cols, ids_col), F.col(ids_col), "_tl_units", hot, cold, keep=id_cols)
    grouped, parts = found, F.col("_tl_units")
    if tok.model == "bytebpe":
        text = F.decode(F.unhex(F.array_join(parts, "")), "UTF-8")
    elif tok.model == "wordpiece":
        text = F.replace(F.array_join(parts, " "), F.lit(" ##"), F.lit(""))
        if clean_up:
            for found, put in CLEAN_UP:
                text = F.replace(text, F.lit(found), F.lit(put))
    elif tok.model == "unigram":
        text = F.regexp_replace(F.replace(F.array_join(parts, ""), F.lit(METASPACE), F.lit(" ")),
                                "^ ", "")
    else:
        text = F.array_join(parts, " ")
    return grouped.select(*id_cols, text.alias(out_col))


# ---------------------------------------------------------------- word-level vocabulary
def word_level_vocab(counts: DataFrame, word_col: str = "word", count_col: str = "freq",
                     special_tokens=tuple(SPECIAL_TOKENS), min_count: int = 1) -> DataFrame:
    """Word-level vocabulary: specials first, then words by (count desc, word asc).

    Ids come from ``with_row_index`` (range buckets), never a global window."""
    from textloom.operators.order import with_row_index

    spark = counts.sparkSession
    words = counts.filter(F.col(count_col) >= min_count).select(
        F.col(word_col).alias("piece"), (-F.col(count_col)).alias("_neg"))
    ranked = with_row_index(words, ["_neg", "piece"], "_ri", checkpoint_input=True)  # the texts are read once
    k = len(special_tokens)
    body = ranked.select((F.col("_ri") + k).cast("int").alias("id"), "piece",
                         F.col("piece").alias("text"), F.lit(False).alias("special"))
    spec = spark.createDataFrame([(i, s, s, True) for i, s in enumerate(special_tokens)],
                                 "id int, piece string, text string, special boolean")
    # a trained artifact, read several times by encode/decode: checkpoint it
    return spec.unionByName(body).checkpoint(eager=True)
