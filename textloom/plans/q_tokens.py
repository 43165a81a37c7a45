"""Registered queries: tokenizer training, encoding, decoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from textloom.functions.text import SPECIAL_TOKENS, WHITESPACE_CLASS, normalize_text_col, word_tokens
from textloom.operators import bpe, encode as enc, order
from textloom.operators.pretokenize import word_counts
from textloom.plans.q_corpus import BYTE_PIECES
from textloom.plans.registry import query
from textloom.plans.sql import DOCS, WORD_IDS, WORD_VOCAB, WP, ids_of, ids_str
from textloom.plans.tables import documents, settled, table
from textloom.session import checkpoint_dir
from textloom.sources import artifacts


def _joined(lists: pa.Array) -> pa.Array:
    values = lists.flatten()
    if values.null_count:  # null ids are left out
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ends = np.append(0, np.cumsum(values.is_valid().to_numpy(zero_copy_only=False)))[at]
        values, valid = values.drop_null(), lists.is_valid().to_numpy(zero_copy_only=False)
    else:
        ends, valid = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.is_valid().to_numpy(zero_copy_only=False)
    words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.cast(values, pa.string()))
    return pc.if_else(pa.array(valid), pc.binary_join(words, " "), pa.scalar(None, pa.string()))


def arr_str(c):
    """The ids of a list, space-joined, whole batches at once."""
    return F.arrow_udf(_joined, "string")(F.col(c))


def word_tokenizer(spark, sf):
    train = documents(spark, sf).filter(F.col("split") == "train")
    vocab = enc.word_level_vocab(word_counts(train, "text"))
    return enc.Tokenizer("word", vocab)


def word_ids(spark, sf):
    """Every document's word-level ids (vocabulary from the train split)."""
    tok = word_tokenizer(spark, sf)
    docs = documents(spark, sf).select("doc_id", "split", "text")
    ids = enc.encode(docs, tok, "text", ["doc_id", "split"])
    return tok, ids


@query("word_vocab", f"""
WITH {WORD_IDS}
SELECT id, word AS piece FROM v
UNION ALL SELECT * FROM (VALUES (0, '<|unknown|>'), (1, '<|pad|>'), (2, '<|cls|>'),
  (3, '<|endoftext|>'), (4, '<|mask|>')) t(id, piece)
""")
def q_word_vocab(spark, sf):
    return word_tokenizer(spark, sf).vocab.select("id", "piece")


@query("encode_wordlevel", f"""
WITH {WORD_IDS}
SELECT doc_id, split, {ids_str('ids')} AS input_ids, CAST(len(ids) AS BIGINT) AS num_tokens FROM ids
""")
def q_encode_word(spark, sf):
    _, ids = word_ids(spark, sf)
    return ids.select("doc_id", "split", arr_str("input_ids").alias("input_ids"), "num_tokens")


@query("token_totals", f"""
WITH {WORD_IDS}
SELECT split, CAST(sum(len(ids)) AS BIGINT) AS total_tokens, CAST(count(*) AS BIGINT) AS n_rows
FROM ids GROUP BY split
""")
def q_token_totals(spark, sf):
    _, ids = word_ids(spark, sf)
    return enc.token_totals(ids, ["split"])


@query("add_special_tokens", f"""
WITH {WORD_IDS}
SELECT doc_id, {ids_str('list_concat([2], ids, [3])')} AS input_ids,
       {ids_str('list_concat([1], list_transform(ids, lambda x: 0), [1])')} AS special_tokens_mask
FROM ids
""")
def q_add_special(spark, sf):
    tok, ids = word_ids(spark, sf)
    out = enc.add_special_tokens(ids, tok)
    return out.select("doc_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("special_tokens_mask").alias("special_tokens_mask"))


@query("pad_truncate", f"""
WITH {WORD_IDS}
SELECT doc_id,
  {ids_str('list_concat(list_slice(ids, 1, 256), list_transform(range(greatest(256 - len(ids), 0)), lambda x: 1))')} AS input_ids,
  {ids_str('list_concat(list_transform(range(least(len(ids), 256)), lambda x: 1), list_transform(range(greatest(256 - len(ids), 0)), lambda x: 0))')} AS attention_mask
FROM ids
""")
def q_pad_truncate(spark, sf):
    tok, ids = word_ids(spark, sf)
    out = enc.pad_truncate(ids, 256, tok.special_id("<|pad|>"))
    return out.select("doc_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("attention_mask").alias("attention_mask"))


@query("decode_wordlevel", f"""
WITH {WORD_IDS}
SELECT doc_id, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE id >= 5), '') AS text
FROM tok GROUP BY doc_id
""")
def q_decode_word(spark, sf):
    tok, ids = word_ids(spark, sf)
    return enc.decode(ids, tok, "input_ids", ["doc_id"])


@query("wordpiece_pair_counts", f"""
WITH w AS (SELECT unnest(regexp_extract_all(strip_accents(lower(text)), '{WP}')) AS word
           FROM {DOCS} WHERE split = 'train'),
c AS (SELECT string_split(word, '') AS ch FROM w),
p AS (SELECT ch, unnest(range(1, len(ch))) AS i FROM c WHERE len(ch) > 1)
SELECT CASE WHEN i = 1 THEN '' ELSE '_' END || lower(hex(encode(ch[i]))) AS "left",
       '_' || lower(hex(encode(ch[i + 1]))) AS "right", CAST(count(*) AS BIGINT) AS count
FROM p GROUP BY 1, 2
""")
def q_wp_pairs(spark, sf):
    train = documents(spark, sf).filter(F.col("split") == "train")
    words = (train.select(F.explode(word_tokens(normalize_text_col(F.col("text")))).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).cast("long").alias("freq"))
             .select(bpe.char_symbols(F.col("w")).alias("syms"), "freq"))
    return bpe.pair_counts(words)


def _train_docs(spark, sf):
    return documents(spark, sf).filter(F.col("split") == "train").select("doc_id", "text")


# ---------------------------------------------------------------- first merges, stated in SQL
N_FIRST = 24


def _merges_sql(n: int) -> str:
    """CTEs ``w0 .. wn`` (words as symbols, each between two spaces) and
    ``m1 .. mn`` (the merges), from ``w0(syms, freq)``: replacing one padded pair
    works left to right without overlaps."""
    out = []
    for k in range(1, n + 1):
        out.append(f"""
q{k} AS MATERIALIZED (SELECT string_split(trim(syms), '  ') AS s, freq FROM w{k - 1}),
m{k} AS MATERIALIZED (SELECT {k - 1} AS rank, l, r, sum(freq) AS c, l || ltrim(r, '_') AS sym FROM
     (SELECT s[i] AS l, s[i + 1] AS r, freq FROM (SELECT s, freq, unnest(range(1, len(s))) AS i FROM q{k}))
     GROUP BY l, r ORDER BY c DESC, l, r LIMIT 1),
w{k} AS MATERIALIZED (SELECT replace(syms, ' ' || l || '  ' || r || ' ', ' ' || sym || ' ') AS syms, freq FROM w{k - 1}, m{k})""")
    return ",".join(out)


def _all_merges(n: int) -> str:
    return " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(1, n + 1))


_BYTES = "regexp_replace(lower(hex(encode({0}))), '(..)', ' \\1 ', 'g')"
_BPE_WORDS = f"""w0 AS (SELECT {_BYTES.format('p')} AS syms, count(*) AS freq FROM
     (SELECT unnest({BYTE_PIECES.format('text')}) AS p FROM {DOCS} WHERE split = 'train') GROUP BY p)"""


@query("train_bpe_first", f"""
WITH {_BPE_WORDS},{_merges_sql(N_FIRST)}
SELECT CAST(rank AS INTEGER) AS rank, l AS "left", r AS "right", CAST(c AS BIGINT) AS count FROM ({_all_merges(N_FIRST)})
""")
def q_train_bpe_first(spark, sf):
    return bpe.train_bpe(_train_docs(spark, sf), vocab_size=4 + 256 + N_FIRST)[1]


_CHARS = "array_to_string(list_transform(string_split(p, ''), lambda ch, i: ' ' || CASE WHEN i > 1 THEN '_' ELSE '' END || lower(hex(encode(ch))) || ' '), '')"


@query("train_wordpiece_first", f"""
WITH w0 AS (SELECT {_CHARS} AS syms, count(*) AS freq FROM
     (SELECT unnest(regexp_extract_all(strip_accents(lower(text)), '{WP}')) AS p FROM {DOCS} WHERE split = 'train') GROUP BY p),
{_merges_sql(N_FIRST)},
al AS (SELECT DISTINCT unnest(string_split(trim(syms), '  ')) AS sym FROM w0)
SELECT piece FROM (SELECT sym AS piece FROM al UNION ALL SELECT sym FROM ({_all_merges(N_FIRST)}))
UNION ALL SELECT * FROM (VALUES ('<|unknown|>'), ('<|pad|>'), ('<|cls|>'), ('<|endoftext|>'), ('<|mask|>')) t(piece)
""")
def q_train_wp_first(spark, sf):
    train = _train_docs(spark, sf)
    words = train.select(F.explode(word_tokens(normalize_text_col(F.col("text")))).alias("w"))
    alphabet = words.select(F.explode(F.split(bpe.char_symbols(F.col("w")), " ")).alias("s")).distinct().count()
    vocab, _ = bpe.train_wordpiece(train, vocab_size=len(SPECIAL_TOKENS) + alphabet + N_FIRST)
    return vocab.select("piece")


_ENCODED = "".join(f"""
x{k} AS (SELECT doc_id, split, i, replace(syms, ' ' || l || '  ' || r || ' ', ' ' || sym || ' ') AS syms FROM x{k - 1}, m{k}),"""
                   for k in range(1, N_FIRST + 1))


@query("encode_bpe_first", f"""
WITH {_BPE_WORDS},{_merges_sql(N_FIRST)},
p AS (SELECT doc_id, split, {BYTE_PIECES.format('text')} AS w FROM {DOCS}),
e AS (SELECT doc_id, split, w, unnest(range(len(w))) AS i FROM p),
x0 AS (SELECT doc_id, split, i, {_BYTES.format('w[i + 1]')} AS syms FROM e),{_ENCODED}
v AS (SELECT lower(lpad(hex(b), 2, '0')) AS sym, 4 + b AS id FROM (SELECT unnest(range(256)) AS b)
      UNION ALL SELECT sym, 260 + rank FROM ({_all_merges(N_FIRST)})),
t AS (SELECT doc_id, split, i, j, s[j] AS sym FROM (SELECT doc_id, split, i, s, unnest(range(1, len(s) + 1)) AS j FROM
      (SELECT doc_id, split, i, string_split(trim(syms), '  ') AS s FROM x{N_FIRST})))
SELECT doc_id, split, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i, j) AS input_ids, CAST(count(*) AS BIGINT) AS num_tokens
FROM t JOIN v USING (sym) GROUP BY doc_id, split
""")
def q_encode_bpe_first(spark, sf):
    vocab, merges = bpe.train_bpe(_train_docs(spark, sf), vocab_size=4 + 256 + N_FIRST)
    tok = enc.Tokenizer("bytebpe", vocab, merges, specials=tuple(SPECIAL_TOKENS[1:]))
    docs = documents(spark, sf).select("doc_id", "split", "text")
    ids = enc.encode(docs, tok, "text", ["doc_id", "split"])
    return ids.select("doc_id", "split", arr_str("input_ids").alias("input_ids"), "num_tokens")


# ---------------------------------------------------------------- longest match, stated in SQL
_WP_VOCAB = f"""w0 AS (SELECT {_CHARS} AS syms, count(*) AS freq FROM
     (SELECT unnest(regexp_extract_all(strip_accents(lower(text)), '{WP}')) AS p FROM {DOCS} WHERE split = 'train') GROUP BY p),
{_merges_sql(N_FIRST)},
al AS (SELECT sym, row_number() OVER (ORDER BY sym) AS i FROM (SELECT DISTINCT unnest(string_split(trim(syms), '  ')) AS sym FROM w0)),
v AS (SELECT sym, 4 + i AS id FROM al UNION ALL SELECT sym, 5 + (SELECT count(*) FROM al) + rank FROM ({_all_merges(N_FIRST)})),
vl AS (SELECT t, length(t) AS n, max(id) AS id FROM (SELECT CASE WHEN starts_with(sym, '_') THEN '##' ELSE '' END
       || decode(unhex(ltrim(sym, '_'))) AS t, id FROM v) GROUP BY t)"""


@query("encode_wordpiece_first", f"""
WITH RECURSIVE {_WP_VOCAB},
p AS (SELECT doc_id, split, regexp_extract_all(strip_accents(lower(text)), '{WP}') AS w FROM {DOCS}),
e AS (SELECT doc_id, split, w[i] AS w, i FROM (SELECT doc_id, split, w, unnest(range(1, len(w) + 1)) AS i FROM p)),
x AS (SELECT w, 1 AS pos, CAST([] AS BIGINT[]) AS ids FROM (SELECT DISTINCT w FROM e WHERE length(w) <= 100)
      UNION ALL
      SELECT w, pos + n, list_append(ids, id) FROM (SELECT x.w, x.pos, x.ids, vl.id,
        CASE WHEN x.pos = 1 THEN vl.n ELSE vl.n - 2 END AS n, row_number() OVER (PARTITION BY x.w ORDER BY vl.n DESC) AS r
        FROM x JOIN vl ON vl.t = CASE WHEN x.pos = 1 THEN substr(x.w, 1, vl.n) ELSE '##' || substr(x.w, x.pos, vl.n - 2) END
                      AND x.pos <= length(x.w) AND (x.pos = 1 OR vl.n > 2)) WHERE r = 1),
d AS (SELECT w, ids FROM x WHERE pos = length(w) + 1),
t AS (SELECT doc_id, split, i, unnest(coalesce(ids, [0])) AS id, generate_subscripts(coalesce(ids, [0]), 1) AS j FROM e LEFT JOIN d USING (w))
SELECT p.doc_id, p.split, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i, j), '') AS input_ids,
       CAST(count(id) AS BIGINT) AS num_tokens FROM p LEFT JOIN t ON t.doc_id = p.doc_id GROUP BY p.doc_id, p.split
""")
def q_encode_wordpiece_first(spark, sf):
    """WordPiece with the alphabet and the first merges, against longest match in SQL."""
    train = _train_docs(spark, sf)
    words = train.select(F.explode(word_tokens(normalize_text_col(F.col("text")))).alias("w"))
    alphabet = words.select(F.explode(F.split(bpe.char_symbols(F.col("w")), " ")).alias("s")).distinct().count()
    vocab, _ = bpe.train_wordpiece(train, vocab_size=len(SPECIAL_TOKENS) + alphabet + N_FIRST)
    docs = documents(spark, sf).select("doc_id", "split", "text")
    ids = enc.encode(docs, enc.Tokenizer("wordpiece", vocab), "text", ["doc_id", "split"])
    return ids.select("doc_id", "split", arr_str("input_ids").alias("input_ids"), "num_tokens")


N_PIECES = 2000
_CHUNKS = f"list_transform(regexp_extract_all(nfc_normalize(text), '[^{WHITESPACE_CLASS}]+'), lambda c: '▁' || c)"


@query("encode_unigram_table", f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT doc_id, split, {_CHUNKS} AS w FROM {DOCS}),
e AS MATERIALIZED (SELECT doc_id, split, w[i] AS w, i FROM (SELECT doc_id, split, w, unnest(range(1, len(w) + 1)) AS i FROM p)),
wc AS (SELECT w, count(*) AS f FROM e WHERE split = 'train' GROUP BY w),
s AS (SELECT substr(w, CAST(i AS INTEGER), k) AS t, sum(f) AS c FROM (SELECT w, f, k, unnest(range(1, length(w) - k + 2)) AS i
      FROM wc, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE length(w) >= k) GROUP BY t),
b AS MATERIALIZED (SELECT t, c FROM s WHERE length(t) = 1 UNION ALL
      SELECT t, c FROM (SELECT t, c FROM s WHERE length(t) > 1 ORDER BY c * length(t) DESC, t LIMIT {N_PIECES})),
v AS MATERIALIZED (SELECT t, length(t) AS n, 4 + row_number() OVER (ORDER BY c DESC, t) AS id,
      floor(1000 * ln(c / (SELECT sum(c) FROM b))) AS sc FROM b),
u AS MATERIALIZED (SELECT min(sc) - 10 AS sc FROM v),
x AS (SELECT w, 0 AS e, CAST([0] AS DOUBLE[]) AS best, CAST([] AS BIGINT[]) AS back, CAST([] AS BIGINT[]) AS ids
      FROM (SELECT DISTINCT w FROM e)
      UNION ALL
      SELECT w, e + 1, list_append(best, CASE WHEN g.sc IS NULL OR best[e + 1] + usc > g.sc THEN best[e + 1] + usc ELSE g.sc END),
             list_append(back, CASE WHEN g.sc IS NULL OR best[e + 1] + usc > g.sc THEN 1 ELSE g.n END),
             list_append(ids, CASE WHEN g.sc IS NULL OR best[e + 1] + usc > g.sc THEN 0 ELSE g.id END)
      FROM (SELECT x.*, u.sc AS usc, h.sc + x.best[x.e + 2 - h.n] AS total, h.n, h.id, row_number() OVER (
              PARTITION BY x.w ORDER BY h.sc + x.best[x.e + 2 - h.n] DESC NULLS LAST, h.n DESC) AS r,
            {{'sc': h.sc + x.best[x.e + 2 - h.n], 'n': h.n, 'id': h.id}} AS g
            FROM x JOIN u ON x.e < length(x.w)
            LEFT JOIN v h ON h.n <= x.e + 1 AND h.t = substr(x.w, CAST(x.e + 2 - h.n AS INTEGER), h.n)) WHERE r = 1),
y AS (SELECT w, length(w) AS pos, back, ids, CAST([] AS BIGINT[]) AS got FROM x WHERE e = length(w)
      UNION ALL
      SELECT w, pos - back[pos], back, ids, CASE WHEN ids[pos] = 0 AND got[1] = 0 THEN got ELSE list_prepend(ids[pos], got) END FROM y WHERE pos > 0),
d AS MATERIALIZED (SELECT w, got FROM y WHERE pos = 0),
t AS (SELECT doc_id, i, unnest(got) AS id, generate_subscripts(got, 1) AS j FROM e JOIN d USING (w))
SELECT p.doc_id, p.split, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i, j), '') AS input_ids,
       CAST(count(id) AS BIGINT) AS num_tokens FROM p LEFT JOIN t ON t.doc_id = p.doc_id GROUP BY p.doc_id, p.split
""")
def q_encode_unigram_table(spark, sf):
    """Unigram encoding with scores from substring counts, against a Viterbi search in SQL."""
    from textloom.operators.unigram import substring_counts
    docs = documents(spark, sf).select("doc_id", "split", "text")
    is_train, plain = F.coalesce(F.col("split") == "train", F.lit(False)), enc.Tokenizer("unigram", None)
    words = plain.piece_counts(docs.filter(is_train), "text").checkpoint()
    others = plain.piece_counts(docs.filter(~is_train), "text")
    counts = substring_counts(words, 4).checkpoint()
    one = F.length("piece") == 1
    kept = counts.filter(one).unionByName(counts.filter(~one).orderBy(
        F.desc(F.col("c") * F.length("piece")), "piece").limit(N_PIECES)).checkpoint()
    total = kept.agg(F.sum("c")).first()[0]
    ranked = order.with_row_index(kept.withColumn("_neg", -F.col("c")), ["_neg", "piece"], "_i")
    vocab = ranked.select((F.col("_i") + 5).cast("int").alias("id"), "piece", F.col("piece").alias("text"),
                          F.lit(False).alias("special"), F.floor(1000 * F.log(F.col("c") / total)).cast("double").alias("score"))
    counted = words.unionByName(others).groupBy("word").agg(F.sum("n").alias("n"))
    ids = enc.encode(docs, enc.Tokenizer("unigram", vocab.checkpoint()), "text", ["doc_id", "split"], counted=counted)
    return ids.select("doc_id", "split", arr_str("input_ids").alias("input_ids"), "num_tokens")


# ---------------------------------------------------------------- trained at the usual size
VOCAB = 8000  # fixed value: the usual vocabulary size


def _published(spark, sf, kind, train=None):
    """``(vocab, merges)`` of the usual size, trained once and shared as artifacts."""
    docs, made = _train_docs(spark, sf), {}

    def build(part):
        def run():
            if not made:
                made["vocab"], made["merges"] = train() if train else {
                    "bpe": bpe.train_bpe, "wordpiece": bpe.train_wordpiece}[kind](docs, vocab_size=VOCAB)
            return made[part]
        return run

    base = f"{checkpoint_dir(spark)}/artifacts"
    params = {"kind": kind, "size": VOCAB, "files": sorted(docs.inputFiles()), "rows": docs.count()}
    return tuple(artifacts.materialize(spark, base, f"{kind}-{part}", params, build(part)) for part in ("vocab", "merges"))


@query("train_bpe")
def q_train_bpe(spark, sf):
    vocab, merges = bpe.train_bpe(_train_docs(spark, sf), vocab_size=VOCAB)
    _published(spark, sf, "bpe", lambda: (vocab, merges))
    return merges


@query("train_wordpiece")
def q_train_wordpiece(spark, sf):
    vocab, merges = bpe.train_wordpiece(_train_docs(spark, sf), vocab_size=VOCAB)
    _published(spark, sf, "wordpiece", lambda: (vocab, merges))
    return vocab


@query("encode_bpe", f"SELECT doc_id, split, TRUE AS roundtrip_ok FROM {DOCS}")
def q_encode_bpe(spark, sf):
    """Every document encoded with the 8,000-entry vocabulary and decoded again."""
    vocab, merges = _published(spark, sf, "bpe")
    tok = enc.Tokenizer("bytebpe", vocab, merges, specials=tuple(SPECIAL_TOKENS[1:]))
    docs = documents(spark, sf).select("doc_id", "split", "text")
    # read twice, by the decoder and by the result
    ids = enc.encode(docs, tok, "text", ["doc_id", "split"]).checkpoint(eager=True)
    back = enc.decode(ids, tok, "input_ids", ["doc_id"], out_col="decoded")
    fewer = F.col("num_tokens") <= F.octet_length("text")
    return (ids.join(back, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
            .select("doc_id", "split", ((F.col("decoded") == F.col("text")) & fewer).alias("roundtrip_ok")))


@query("encode_wordpiece")
def q_encode_wordpiece(spark, sf):
    vocab, merges = _published(spark, sf, "wordpiece")
    tok = enc.Tokenizer("wordpiece", vocab, merges)
    docs = documents(spark, sf).select("doc_id", "split", "text")
    return enc.encode(docs, tok, "text", ["doc_id", "split"]).select("doc_id", "split",
                                                                      "num_tokens")


_PAIRS = """
pr AS (SELECT u.conv_id, u.turn, u.text AS src, a.text AS tgt FROM conversations u
       JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
       WHERE u.role = 'user' AND a.role = 'assistant')"""
_SRC = "coalesce(s.ids, CAST([] AS INTEGER[]))"
_TGT = "coalesce(t.ids, CAST([] AS INTEGER[]))"


@query("encode_pair", f"""
WITH {WORD_VOCAB}, {_PAIRS},
{ids_of('s', 'pr', 'src', 'conv_id, turn')},
{ids_of('t', 'pr', 'tgt', 'conv_id, turn')}
SELECT pr.conv_id, pr.turn,
  {ids_str(f'list_concat(list_slice({_SRC}, 1, 768), list_transform(range(greatest(768 - len({_SRC}), 0)), lambda x: 1))')} AS input_ids,
  {ids_str(f'list_concat(list_transform(range(least(len({_SRC}), 768)), lambda x: 1), list_transform(range(greatest(768 - len({_SRC}), 0)), lambda x: 0))')} AS attention_mask,
  {ids_str(f'list_concat(list_slice({_TGT}, 1, 128), list_transform(range(greatest(128 - len({_TGT}), 0)), lambda x: 1))')} AS labels
FROM pr LEFT JOIN s USING (conv_id, turn) LEFT JOIN t USING (conv_id, turn)
""")
def q_encode_pair(spark, sf):
    tok = word_tokenizer(spark, sf)
    conv = table(spark, sf, "conversations")
    pairs = _turn_pairs(conv)
    out = enc.encode_pair(pairs, tok, "src", "tgt", ["conv_id", "turn"], 768, 128)
    return out.select("conv_id", "turn", arr_str("input_ids").alias("input_ids"),
                      arr_str("attention_mask").alias("attention_mask"),
                      arr_str("labels").alias("labels"))


def _turn_pairs(conv):
    """user turn -> the next assistant turn of the same conversation."""
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return u.join(a, ["conv_id", "turn"])


@query("unigram_seeds", f"""
WITH w AS (SELECT w, count(*) AS f FROM (SELECT unnest({_CHUNKS}) AS w FROM {DOCS} WHERE split = 'train') GROUP BY w),
s AS (SELECT f, substr(w, CAST(i AS INTEGER), k) AS piece, CASE WHEN i > 1 THEN substr(w, CAST(i - 1 AS INTEGER), 1) ELSE '' END AS l,
        substr(w, CAST(i + k AS INTEGER), 1) AS r
      FROM (SELECT w, f, k, unnest(range(1, length(w) - k + 2)) AS i FROM w, (SELECT unnest(range(2, 17)) AS k) WHERE length(w) >= k))
SELECT piece, CAST(sum(f) AS BIGINT) AS c FROM s GROUP BY piece
HAVING (count(DISTINCT l) > 1 OR sum(CASE WHEN l = '' THEN f ELSE 0 END) > 1)
   AND (count(DISTINCT r) > 1 OR sum(CASE WHEN r = '' THEN f ELSE 0 END) > 1)
""")
def q_unigram_seeds(spark, sf):
    from textloom.operators.unigram import substring_seeds
    words = enc.Tokenizer("unigram", None).piece_counts(_train_docs(spark, sf), "text").withColumnRenamed("n", "freq")
    return substring_seeds(words, 16)


@query("train_unigram")
def q_train_unigram(spark, sf):
    from textloom.operators.unigram import train_unigram
    return train_unigram(_train_docs(spark, sf), vocab_size=VOCAB)


@query("encode_unigram")
def q_encode_unigram(spark, sf):
    from textloom.operators.unigram import train_unigram
    vocab = train_unigram(_train_docs(spark, sf), vocab_size=VOCAB)
    tok = enc.Tokenizer("unigram", vocab)
    docs = documents(spark, sf).select("doc_id", "split", "text")
    # read twice, by the decoder and by the result
    ids = enc.encode(docs, tok, "text", ["doc_id", "split"]).checkpoint(eager=True)
    back = enc.decode(ids, tok, "input_ids", ["doc_id"], out_col="decoded")
    return (ids.join(back, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
            .select("doc_id", "split", "num_tokens", "decoded"))


@query("story_flow_totals")
def q_story_flow(spark, sf):
    """The whole story flow over ``documents``: each split written as
    delimiter-framed text files (validation under a ``valid`` folder), then
    routing, per-split exact dedup, BPE training on train, encoding, totals."""
    from textloom.plans.flows import packed_story_corpus
    from textloom.session import scratch_path
    from textloom.sources.text import write_delimited

    base = scratch_path(spark, "stories")
    docs = documents(spark, sf)
    write_delimited(docs.filter(F.col("split") == "train"), f"{base}/train")
    write_delimited(docs.filter(F.col("split") == "validation"), f"{base}/valid")
    totals, _ = packed_story_corpus(spark, [f"{base}/train", f"{base}/valid"], vocab_size=VOCAB,
                                    sequence_len=None)
    return settled(totals, base)
