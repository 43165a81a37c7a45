"""Registered queries: packing and label shaping over word-level ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import encode as enc
from textloom.operators import packing as pk
from textloom.plans.q_tokens import arr_str, word_ids
from textloom.plans.registry import query
from textloom.plans.sql import DOCS, TRIM, WORD_IDS, WP, ids_str


def _chunks_sql(src: str, L: int, batch: int | None, with_mask: bool) -> str:
    stream = f"(row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // {batch}" if batch \
        else "0"
    mask = (", string_agg(CAST(m AS VARCHAR), ' ' ORDER BY gpos) AS special_tokens_mask"
            if with_mask else "")
    return f"""
r AS (SELECT doc_id, split, ids, len(ids) AS n, {stream} AS b FROM {src}),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY split, b ORDER BY doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
        sum(n) OVER (PARTITION BY split, b) AS t FROM r),
e AS (SELECT split, b, s, t, n, ids, unnest(range(n)) AS k FROM o),
c AS (SELECT split, b, (s + k) // {L} AS chunk, s + k AS gpos, ids[k + 1] AS id,
        CASE WHEN k = 0 OR k = n - 1 THEN 1 ELSE 0 END AS m,
        CASE WHEN t >= {L} THEN t // {L} ELSE 1 END AS nch FROM e),
packed AS (SELECT split, CAST(b AS BIGINT) AS stream_id, CAST(chunk AS BIGINT) AS chunk_id,
        list(id ORDER BY gpos) AS ids{mask}
        FROM c WHERE chunk < nch GROUP BY split, b, chunk)"""


@query("group_texts", f"""
WITH {WORD_IDS},
x AS (SELECT doc_id, split, list_concat([2], ids, [3]) AS ids FROM ids),
{_chunks_sql('x', 64, 50, True)}
SELECT split, stream_id, chunk_id, {ids_str('ids')} AS input_ids, special_tokens_mask FROM packed
""")
def q_group_texts(spark, sf):
    tok, ids = word_ids(spark, sf)
    withs = enc.add_special_tokens(ids, tok)
    out = pk.group_texts(withs, 64, 50, ["input_ids", "special_tokens_mask"], "doc_id", ["split"])
    return out.select("split", "stream_id", "chunk_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("special_tokens_mask").alias("special_tokens_mask"))


_EOS = f"""
x AS (SELECT doc_id, split, list_concat(ids, [3]) AS ids FROM ids),
{_chunks_sql('x', 128, None, False)}"""


def _packed(spark, sf):
    tok, ids = word_ids(spark, sf)
    return pk.pack_eos(ids, 127, tok.special_id("<|endoftext|>"), "input_ids", "doc_id",
                       None, ["split"])


@query("pack_eos", f"""
WITH {WORD_IDS}, {_EOS}
SELECT split, stream_id, chunk_id, {ids_str('ids')} AS input_ids FROM packed
""")
def q_pack_eos(spark, sf):
    return _packed(spark, sf).select("split", "stream_id", "chunk_id",
                                     arr_str("input_ids").alias("input_ids"))


@query("pack_eos_batched", f"""
WITH {WORD_IDS},
x AS (SELECT doc_id, split, list_concat(ids, [3]) AS ids FROM ids),
{_chunks_sql('x', 257, 3, False)}
SELECT split, stream_id, chunk_id, {ids_str('ids')} AS input_ids FROM packed
""")
def q_pack_eos_batched(spark, sf):
    tok, ids = word_ids(spark, sf)
    out = pk.pack_eos(ids, 256, 3, "input_ids", "doc_id", 3, ["split"])
    return out.select("split", "stream_id", "chunk_id", arr_str("input_ids").alias("input_ids"))


@query("overflow_windows", f"""
WITH {WORD_IDS},
e AS (SELECT doc_id, ids, len(ids) AS n, unnest(range(len(ids))) AS k FROM ids)
SELECT doc_id, CAST(k // 128 AS BIGINT) AS window_id,
       string_agg(CAST(ids[k + 1] AS VARCHAR), ' ' ORDER BY k) AS input_ids
FROM e WHERE k // 128 < n // 128 GROUP BY doc_id, k // 128
""")
def q_overflow(spark, sf):
    _, ids = word_ids(spark, sf)
    out = pk.overflow_windows(ids.select("doc_id", "input_ids"), 128)
    return out.select("doc_id", "window_id", arr_str("input_ids").alias("input_ids"))


@query("pack_sweep", f"""
WITH {WORD_IDS},
e AS (SELECT doc_id, ids, len(ids) AS n, unnest(range(len(ids))) AS k FROM ids),
L AS (SELECT CAST(unnest(range(128, 1281, 128)) AS INTEGER) AS seq_len)
SELECT seq_len, doc_id, CAST(k // seq_len AS BIGINT) AS window_id,
       string_agg(CAST(ids[k + 1] AS VARCHAR), ' ' ORDER BY k) AS input_ids
FROM e, L WHERE k // seq_len < n // seq_len GROUP BY seq_len, doc_id, k // seq_len
""")
def q_sweep(spark, sf):
    _, ids = word_ids(spark, sf)
    out = pk.pack_sweep(ids.select("doc_id", "input_ids"))
    return out.select("seq_len", "doc_id", "window_id", arr_str("input_ids").alias("input_ids"))


@query("causal_shift", f"""
WITH {WORD_IDS}, {_EOS}
SELECT split, stream_id, chunk_id, {ids_str('list_slice(ids, 1, len(ids) - 1)')} AS input_ids,
       {ids_str('list_slice(ids, 2, len(ids))')} AS labels FROM packed
""")
def q_causal_shift(spark, sf):
    out = pk.causal_shift(_packed(spark, sf))
    return out.select("split", "stream_id", "chunk_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("labels").alias("labels"))


@query("causal_labels_masked", f"""
WITH {WORD_IDS}, {_EOS}
SELECT split, stream_id, chunk_id,
       {ids_str('list_transform(ids, lambda x: CASE WHEN x = 3 THEN -100 ELSE x END)')} AS labels
FROM packed
""")
def q_causal_masked(spark, sf):
    out = pk.causal_labels_masked(_packed(spark, sf), 3)
    return out.select("split", "stream_id", "chunk_id", arr_str("labels").alias("labels"))


_LAB = ("list_concat(list_slice(ids, 1, 128), "
        "list_transform(range(greatest(128 - len(ids), 0)), lambda x: -100))")


@query("seq2seq_labels", f"""
WITH {WORD_IDS}, l AS (SELECT doc_id, {_LAB} AS lab FROM ids)
SELECT doc_id, {ids_str('lab')} AS labels,
  {ids_str('list_transform(list_concat([1], list_slice(lab, 1, len(lab) - 1)), lambda x: CASE WHEN x = -100 THEN 1 ELSE x END)')} AS decoder_input_ids
FROM l
""")
def q_seq2seq(spark, sf):
    _, ids = word_ids(spark, sf)
    out = pk.seq2seq_labels(ids.select("doc_id", F.col("input_ids").alias("labels")), 1, 1,
                            "labels", 128)
    return out.select("doc_id", arr_str("labels").alias("labels"),
                      arr_str("decoder_input_ids").alias("decoder_input_ids"))


def _u(salt: int) -> str:
    return (f"CAST('0x' || substr(md5('42:0:' || CAST(doc_id AS VARCHAR) || ':' || CAST(i - 1 AS "
            f"VARCHAR) || ':{salt}'), 1, 15) AS BIGINT)")


def _mlm_sql(rows: str) -> str:
    return f"""
WITH {WORD_IDS},
{rows},
z AS (SELECT doc_id, list_transform(ids, lambda v, i: struct_pack(
        x := v, s := sp[i],
        c := sp[i] = 0 AND {_u(0)} / 1152921504606846976.0 < 0.15,
        v1 := {_u(1)} / 1152921504606846976.0,
        r := CAST({_u(2)} % vs AS INTEGER))) AS e FROM x, (SELECT count(*) + 5 AS vs FROM v))
SELECT doc_id,
  {ids_str("list_transform(e, lambda t: CASE WHEN NOT t.c THEN t.x WHEN t.v1 < 0.8 THEN 4 WHEN t.v1 < 0.9 THEN t.r ELSE t.x END)")} AS input_ids,
  {ids_str("list_transform(e, lambda t: CASE WHEN t.c THEN t.x ELSE -100 END)")} AS labels
FROM z
"""


_WITH_SPECIALS = """x AS (SELECT doc_id, list_concat([2], ids, [3]) AS ids,
        list_concat([1], list_transform(ids, lambda v: 0), [1]) AS sp FROM ids)"""


@query("mlm_mask", _mlm_sql(_WITH_SPECIALS))
def q_mlm(spark, sf):
    tok, ids = word_ids(spark, sf)
    withs = enc.add_special_tokens(ids, tok)
    out = pk.mlm_mask(withs, tok.special_id("<|mask|>"), tok.vocab.count(), seed=42, epoch=0)
    return out.select("doc_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("labels").alias("labels"))


def _cut(col: str, pad: int) -> str:
    """An aligned list cut to 128 with its last value kept, or padded."""
    return (f"CASE WHEN len({col}) > 128 THEN list_concat(list_slice({col}, 1, 127), list_slice({col}, len({col}), len({col}))) "
            f"ELSE list_concat({col}, list_transform(range(128 - len({col})), lambda q: {pad})) END")


@query("mlm_mask_padded", _mlm_sql(f"""{_WITH_SPECIALS.replace('x AS', 'x0 AS')},
x AS (SELECT doc_id, {_cut('ids', 1)} AS ids, {_cut('sp', 1)} AS sp FROM x0)"""))
def q_mlm_padded(spark, sf):
    """Specials, then cut and padded to 128, then masked."""
    tok, ids = word_ids(spark, sf)
    padded = enc.pad_truncate(enc.add_special_tokens(ids, tok), 128, tok.special_id("<|pad|>"))
    out = pk.mlm_mask(padded, tok.special_id("<|mask|>"), tok.vocab.count(), seed=42, epoch=0)
    return out.select("doc_id", arr_str("input_ids").alias("input_ids"),
                      arr_str("labels").alias("labels"))


# ---------------------------------------------------------------- flows with word-level ids
@query("story_flow_wordlevel", f"""
WITH dd AS (SELECT split, {TRIM} AS text FROM {DOCS}),
one AS (SELECT DISTINCT split, text FROM dd WHERE length(text) > 0)
SELECT split, CAST(sum(len(regexp_extract_all(text, '{WP}'))) AS BIGINT) AS total_tokens,
       CAST(count(*) AS BIGINT) AS n_rows FROM one GROUP BY split
""")
def q_story_word(spark, sf):
    """The story flow end to end, read as UTF-8, with word-level ids."""
    from textloom.plans.flows import packed_story_corpus
    from textloom.plans.tables import documents
    from textloom.session import scratch_path
    from textloom.sources.text import write_delimited

    base = scratch_path(spark, "stories")
    docs = documents(spark, sf)
    write_delimited(docs.filter(F.col("split") == "train"), f"{base}/train")
    write_delimited(docs.filter(F.col("split") == "validation"), f"{base}/valid")
    totals, _ = packed_story_corpus(spark, [f"{base}/train", f"{base}/valid"], kind="word",
                                    sequence_len=None, repair_bytes=False)
    return totals


@query("tale_windows", f"""
WITH d AS {DOCS},
wc AS (SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '{WP}')) AS word
       FROM d WHERE split = 'train') GROUP BY word),
v AS (SELECT word, row_number() OVER (ORDER BY freq DESC, word) - 1 + 5 AS id FROM wc),
r AS (SELECT doc_id, regexp_extract_all('# ' || replace(text, chr(10), ' '), '{WP}') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM r),
t AS (SELECT doc_id, i, coalesce(v.id, 0) AS id FROM (SELECT doc_id, i, w[i + 1] AS word FROM e) LEFT JOIN v USING (word)
      UNION ALL SELECT doc_id, len(w), 3 FROM r),
s AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS p, id, count(*) OVER () AS n FROM t),
L AS (SELECT CAST(unnest(range(128, 1281, 128)) AS INTEGER) AS seq_len)
SELECT seq_len, CAST(p // seq_len AS BIGINT) AS chunk_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY p) AS input_ids
FROM s, L WHERE p // seq_len < n // seq_len GROUP BY seq_len, p // seq_len
""")
def q_tale_windows(spark, sf):
    """All documents as the tales of a folder of files, in id order."""
    from textloom.plans.flows import tale_windows
    from textloom.plans.q_tokens import word_tokenizer
    from textloom.plans.tables import documents
    from textloom.session import scratch_path

    path = scratch_path(spark, "tale-file")
    docs = documents(spark, sf).select("doc_id", F.concat("text", F.lit("\n\n\n\n")).alias("value"))
    # files are named in the order of their id ranges, and the flow packs in that order
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    out = tale_windows(spark, path, word_tokenizer(spark, sf), one_stream=True)
    return out.select("seq_len", "chunk_id", arr_str("input_ids").alias("input_ids"))


@query("finetune_batches", f"""
WITH {WORD_IDS},
x0 AS (SELECT doc_id, split, list_concat([2], ids, [3]) AS ids FROM ids),
x AS (SELECT doc_id, split, {_cut('ids', 1)} AS ids FROM x0 JOIN labels USING (doc_id)),
k AS (SELECT *, CAST('0x' || substr(md5('42:0:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM x),
b AS (SELECT doc_id, split, ids, CASE WHEN split = 'train' THEN row_number() OVER (PARTITION BY split ORDER BY h, doc_id)
      ELSE row_number() OVER (PARTITION BY split ORDER BY doc_id) END - 1 AS ri, count(*) OVER (PARTITION BY split) AS n FROM k)
SELECT doc_id, split, CAST(CASE WHEN split = 'train' THEN ri // 16 ELSE ri // 32 END AS BIGINT) AS batch_id,
       {ids_str('ids')} AS input_ids FROM b WHERE split <> 'train' OR ri // 16 < n // 16
""")
def q_finetune(spark, sf):
    from textloom.plans.flows import finetune_batches
    from textloom.plans.q_tokens import word_tokenizer
    from textloom.plans.tables import documents, table

    labelled = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "split", "text", F.col("quality").alias("label"))
    out = finetune_batches(labelled, word_tokenizer(spark, sf), batch_size=16, max_length=128)
    return out.select("doc_id", "split", "batch_id", arr_str("input_ids").alias("input_ids"))
