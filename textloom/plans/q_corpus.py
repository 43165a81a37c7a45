"""Registered queries: sources, cleaning, dedup, pre-tokenisation, ordering."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import batches as bt
from textloom.operators import clean, dedup, order, pretokenize
from textloom.plans.corpus import unique_tokens_by_lang
from textloom.plans.registry import query
from textloom.plans.sql import DOCS, TRIM, WP
from textloom.plans.tables import documents, settled, table
from textloom.session import scratch_path
from textloom.sources import artifacts, files, splits
from textloom.sources import text as src

# ---------------------------------------------------------------- flagship
query("flagship_unique_tokens", f"""
WITH d AS (SELECT doc_id, lang, {TRIM} AS text FROM documents),
k AS (SELECT min(doc_id) AS doc_id FROM d GROUP BY lang, md5(text))
SELECT d.lang, CAST(count(*) AS BIGINT) AS docs_kept,
       CAST(sum(len(regexp_extract_all(d.text, '{WP}'))) AS BIGINT) AS n_tokens
FROM d JOIN k USING (doc_id) GROUP BY d.lang
""")(unique_tokens_by_lang)


# ---------------------------------------------------------------- sources
@query("read_delimited_docs", f"""
SELECT {TRIM} AS text, CAST(length({TRIM}) AS BIGINT) AS n_chars
FROM documents WHERE length({TRIM}) > 0
""")
def q_read_delimited(spark, sf):
    path = scratch_path(spark, "framed")
    docs = table(spark, sf, "documents")
    # frame every document as " text\n<|endoftext|>" (leading space, trailing newline)
    src.write_delimited(docs.select(F.concat(F.lit(" "), "text", F.lit("\n")).alias("text")), path)
    out = src.read_delimited_docs(spark, path, repair_bytes=False)
    return out.select("text", F.length("text").cast("long").alias("n_chars"))


def _cp1252_sql() -> str:
    src_chars, dst_chars = tx._CP1252_FROM, tx._CP1252_TO
    frm = " || ".join(f"chr({ord(c)})" for c in src_chars)
    to = " || ".join(f"chr({ord(c)})" for c in dst_chars)
    return f"""
SELECT doc_id, translate(array_to_string(list_transform(range(length(h) // 2),
         lambda i: chr(CAST('0x' || substr(h, 2 * i + 1, 2) AS INTEGER))), ''), {frm}, {to}) AS text
FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents)"""


@query("decode_repair", _cp1252_sql())
def q_decode_repair(spark, sf):
    # UTF-8 bytes read back as windows-1252: the repairing decoder never fails
    docs = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return src.decode_repair(docs, "raw", "text").select("doc_id", "text")


@query("read_whole_docs", """
SELECT text, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) > 0
""")
def q_read_whole(spark, sf):
    path = scratch_path(spark, "whole")
    docs = table(spark, sf, "documents")
    docs.select(F.concat("text", F.lit("\n\n\n\n")).alias("value")).write.text(path)
    whole = src.read_whole_docs(spark, path)
    out = clean.split_docs(whole, "text")
    return out.select("text", F.length("text").cast("long").alias("n_chars"))


PAGE_RULES = (files.Rule("split", "page=2", "validation", "train"),
              files.Rule("version", ".org", "version2", "original"))


@query("read_tales", """
SELECT text FROM documents WHERE length(text) > 0
UNION ALL SELECT 'second of ' || doc_id FROM documents
""")
def q_read_tales(spark, sf):
    path = scratch_path(spark, "tales")
    docs = table(spark, sf, "documents")
    docs.select(F.concat("text", F.lit("\n\n\n\n\nsecond of "), F.col("doc_id").cast("string"),
                         F.lit("\n\n\n")).alias("value")).write.text(path)
    return src.read_tales(spark, path).select("text")


@query("route_files", """
SELECT page_id,
       CASE WHEN contains(lower(url), 'page=2') THEN 'validation' ELSE 'train' END AS split,
       CASE WHEN contains(lower(url), '.org') THEN 'version2' ELSE 'original' END AS version
FROM pages
""")
def q_route_files(spark, sf):
    pages = table(spark, sf, "pages")
    out = files.route_files(pages, "url", PAGE_RULES, suffix=None, data_slice="combined")
    return out.select("page_id", "split", "version")


@query("route_files_v2", """
SELECT page_id, CASE WHEN contains(lower(url), 'page=2') THEN 'validation' ELSE 'train' END AS split
FROM pages WHERE contains(lower(url), '.org')
""")
def q_route_files_v2(spark, sf):
    pages = table(spark, sf, "pages")
    out = files.route_files(pages, "url", PAGE_RULES, suffix=None, data_slice="version2")
    return out.select("page_id", "split")


@query("read_labelled", f"""
SELECT d.doc_id, d.split, l.quality AS label, d.n_chars
FROM {DOCS} d JOIN labels l USING (doc_id)
""")
def q_read_labelled(spark, sf):
    docs = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    out = splits.read_labelled(spark, docs, splits=["train", "validation"])
    return out.select("doc_id", "split", F.col("quality").alias("label"), "n_chars")


@query("save_load_splits", f"""
SELECT doc_id, lang, split FROM {DOCS}
""")
def q_save_load(spark, sf):
    path = scratch_path(spark, "splits")
    splits.save_splits(documents(spark, sf).select("doc_id", "lang", "split"), path)
    parts = [splits.load_splits(spark, path, x).select("doc_id", "lang", "split") for x in ("validation", "train")]
    return settled(parts[0].unionByName(parts[1]), path)


@query("materialize", """
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs FROM documents GROUP BY lang
""")
def q_materialize(spark, sf):
    base = scratch_path(spark, "artifacts")
    params = {"table": "documents", "sf_dir": sf, "agg": "count_by_lang"}

    def build():
        return table(spark, sf, "documents").groupBy("lang").agg(
            F.count(F.lit(1)).cast("long").alias("n_docs"))

    artifacts.materialize(spark, base, "lang_counts", params, build)
    # the second call finds the pointer and loads instead of rebuilding
    return settled(artifacts.materialize(spark, base, "lang_counts", params, None), base)


# ---------------------------------------------------------------- map surface
def _lengths(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"],
                         "n_chars": pdf["text"].str.len().astype("int64"),
                         "n_lines": (pdf["text"].str.count("\n") + 1).astype("int64")})


@query("map_batches", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
       CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM documents
""")
def q_map_batches(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return clean.map_batches(docs, _lengths, "doc_id long, n_chars long, n_lines long")


def _batch_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"first_id": [pdf["doc_id"].iloc[0]], "last_id": [pdf["doc_id"].iloc[-1]], "n_docs": [len(pdf)],
                         "n_chars": [int(pdf["text"].str.len().sum())]})


@query("map_batches_exact", """
SELECT min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS b FROM documents) GROUP BY b
""")
def q_map_batches_exact(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").repartition(7, "doc_id")
    return clean.map_batches(docs, _batch_summary, "first_id long, last_id long, n_docs long, n_chars long", 200, "doc_id")


@query("select_drop_columns", "SELECT doc_id, lang FROM documents")
def q_select_drop(spark, sf):
    docs = clean.select_columns(table(spark, sf, "documents"), ["doc_id", "lang", "source"])
    return clean.drop_columns(docs, ["source"])


@query("reshard", """
SELECT doc_id, lang, 7 AS n_shards, 0 AS outside FROM documents
""")
def q_reshard(spark, sf):
    out = clean.reshard(table(spark, sf, "documents").select("doc_id", "lang"), 7, "doc_id")
    return out.select("doc_id", "lang", F.lit(out.rdd.getNumPartitions()).alias("n_shards"),
                      F.floor(F.spark_partition_id() / 7).cast("int").alias("outside"))


# ---------------------------------------------------------------- cleaning
_R1 = r"'([^\n])\n([^\n])', '\1 \2', 'g'"
_R2 = r"'([^\n])\n\n([^\n])', '\1' || chr(10) || '\2', 'g'"
_REFLOW = f"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, {_R1}), {_R1}),
 '^\\n$', ' '), '^\\n([^\\n])', ' \\1'), '([^\\n])\\n$', '\\1 '),
 {_R2}), {_R2}), '^\\n\\n$', chr(10)), '^\\n\\n([^\\n])', chr(10) || '\\1'),
 '([^\\n])\\n\\n$', '\\1' || chr(10))"""


# every rule has something to do in every row: double newlines inside, single ones at the end
@query("reflow_newlines", f"""
WITH documents AS (SELECT doc_id, replace(text, '. ', '.' || chr(10) || chr(10)) || chr(10) AS text FROM documents)
SELECT doc_id, {_REFLOW} AS text FROM documents
""")
def q_reflow(spark, sf):
    raw = F.concat(F.replace("text", F.lit(". "), F.lit(".\n\n")), F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", raw.alias("text")).select(
        "doc_id", tx.reflow_newlines("text").alias("text"))


@query("collapse_blank_lines",
       r"SELECT doc_id, regexp_replace(replace(text, ' ', repeat(chr(10), 3)), '\n{2,}', chr(10), 'g') AS text FROM documents")
def q_collapse(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit(" "), F.lit("\n\n\n")).alias("text")).select(
        "doc_id", tx.collapse_blank_lines("text").alias("text"))


@query("trim_chars", f"""
WITH documents AS (SELECT doc_id, '  ' || chr(10) || text || chr(10) || ' ' AS text FROM documents)
SELECT doc_id, {TRIM} AS text, regexp_replace(text, '^ ', '') AS text_lstrip1 FROM documents
""")
def q_trim(spark, sf):
    raw = F.concat(F.lit("  \n"), "text", F.lit("\n "))
    return table(spark, sf, "documents").select("doc_id", raw.alias("text")).select(
        "doc_id", tx.trim_chars("text").alias("text"),
        tx.strip_one_leading_space("text").alias("text_lstrip1"))


@query("drop_cr", "SELECT doc_id, text || chr(10) AS text FROM documents")
def q_drop_cr(spark, sf):
    raw = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r\n"))
    return table(spark, sf, "documents").select("doc_id", raw.alias("text")).select(
        "doc_id", tx.drop_cr("text").alias("text"))


@query("affix", """
SELECT doc_id, '# ' || text || '<|endoftext|>' AS text,
       'Summarize the following text:' || chr(10) || text AS prompt FROM documents
""")
def q_affix(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.affix("text", "# ", tx.EOT).alias("text"),
        tx.affix("text", tx.SUMMARIZE_PREFIX).alias("prompt"))


@query("split_docs", r"""
WITH p AS (SELECT doc_id, string_split_regex(text, '\n') AS parts FROM documents),
e AS (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM p)
SELECT doc_id, CAST(i AS BIGINT) AS piece_idx, parts[i + 1] AS text FROM e
WHERE length(parts[i + 1]) > 0
""")
def q_split_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return clean.split_docs(docs, "text", pattern="\n")


@query("split_tales", """
SELECT doc_id, CAST(0 AS BIGINT) AS piece_idx, text FROM documents
UNION ALL SELECT doc_id, CAST(1 AS BIGINT), 'second of ' || doc_id FROM documents
UNION ALL SELECT doc_id, CAST(2 AS BIGINT), 'end' FROM documents
""")
def q_split_tales(spark, sf):
    raw = F.concat("text", F.lit("\n\n\n\nsecond of "), F.col("doc_id").cast("string"), F.lit("\n\n\n\n\n\nend\n\n\n\n"))
    docs = table(spark, sf, "documents").select("doc_id", raw.alias("text"))
    return clean.split_docs(docs, "text")


@query("concat_turns", """
SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id
""")
def q_concat_turns(spark, sf):
    return clean.concat_docs(table(spark, sf, "conversations"), "conv_id", "turn", "text", "\n")


@query("normalize_text", "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents")
def q_normalize(spark, sf):
    return clean.normalize_text(table(spark, sf, "documents").select("doc_id", "text"))


@query("preview_lines", r"""
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
e AS (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM p)
SELECT doc_id, CAST(i AS BIGINT) AS line_no, parts[i + 1] AS line FROM e
WHERE i BETWEEN 0 AND 20 OR i BETWEEN 150 AND 165
""")
def q_preview_lines(spark, sf):
    return clean.preview_lines(table(spark, sf, "documents"))


@query("preview_edges", """
SELECT doc_id, substr(text, 1, 300) AS head,
       CASE WHEN length(text) <= 300 THEN text ELSE substr(text, length(text) - 299, 300) END AS tail
FROM documents
""")
def q_preview_edges(spark, sf):
    return clean.preview_edges(table(spark, sf, "documents")).select("doc_id", "head", "tail")


# ---------------------------------------------------------------- dedup
@query("dedup_exact", f"""
WITH d AS (SELECT doc_id, split, lang, {TRIM} AS text FROM {DOCS})
SELECT d.doc_id, d.split, d.lang FROM d
JOIN (SELECT min(doc_id) AS doc_id FROM d GROUP BY split, md5(text)) k USING (doc_id)
""")
def q_dedup_exact(spark, sf):
    docs = documents(spark, sf).select("doc_id", "split", "lang", tx.trim_chars("text").alias("text"))
    return dedup.dedup_exact(docs, "text", ["split"], "doc_id").select("doc_id", "split", "lang")


@query("dedup_report", f"""
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT md5(text)) AS BIGINT) AS n_unique,
       CAST(count(*) - count(DISTINCT md5(text)) AS BIGINT) AS n_removed
FROM (SELECT split, {TRIM} AS text FROM {DOCS}) GROUP BY split
""")
def q_dedup_report(spark, sf):
    docs = documents(spark, sf).select("split", tx.trim_chars("text").alias("text"))
    return dedup.dedup_report(docs, "text", ["split"])


# ---------------------------------------------------------------- pre-tokenisation
@query("pretokenize_words", f"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, '{WP}') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM p)
SELECT doc_id, CAST(i AS BIGINT) AS pos, w[i + 1] AS word FROM e
""")
def q_pretok_words(spark, sf):
    return pretokenize.pretokenize_words(table(spark, sf, "documents"))


# RE2 has no look-ahead: a private-use mark before the last white space that a
# non-space follows says where the piece before it ends
BYTE_PIECES = (r"""list_transform(regexp_extract_all(regexp_replace({0}, '(\s\S)', chr(57344) || '\1', 'g'),
  '''s|''t|''re|''ve|''m|''ll|''d|(?:\x{{E000}} )?\p{{L}}+|(?:\x{{E000}} )?\p{{N}}+|(?:\x{{E000}} )?[^\s\p{{L}}\p{{N}}\x{{E000}}]+|\x{{E000}}\s|\s+'),
  lambda q: replace(q, chr(57344), ''))""")


@query("pretokenize_bytes", f"""
WITH p AS (SELECT doc_id, {BYTE_PIECES.format('text')} AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM p)
SELECT doc_id, CAST(i AS BIGINT) AS pos, w[i + 1] AS piece, lower(hex(encode(w[i + 1]))) AS hex FROM e
""")
def q_pretok_bytes(spark, sf):
    return pretokenize.pretokenize_bytes(table(spark, sf, "documents"))


@query("word_counts", f"""
SELECT word, CAST(count(*) AS BIGINT) AS freq
FROM (SELECT unnest(regexp_extract_all(text, '{WP}')) AS word FROM {DOCS} WHERE split = 'train')
GROUP BY word
""")
def q_word_counts(spark, sf):
    train = documents(spark, sf).filter(F.col("split") == "train")
    return pretokenize.word_counts(train, "text")


# ---------------------------------------------------------------- order / batches
@query("row_index", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index,
       CAST(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0) AS BIGINT) AS char_start
FROM documents
""")
def q_row_index(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    out = order.with_row_index(docs, ["doc_id"], "row_index", {"char_start": "n_chars"})
    return out.select("doc_id", "row_index", "char_start")


@query("row_index_by_split", f"""
SELECT doc_id, split,
       CAST(row_number() OVER (PARTITION BY split ORDER BY lang, doc_id) - 1 AS BIGINT) AS row_index
FROM {DOCS}
""")
def q_row_index_split(spark, sf):
    docs = documents(spark, sf).select("doc_id", "split", "lang")
    out = order.with_row_index(docs, ["lang", "doc_id"], "row_index", partition_by=["split"])
    return out.select("doc_id", "split", "row_index")


@query("seeded_shuffle", f"""
SELECT doc_id, split,
       CAST(row_number() OVER (PARTITION BY split ORDER BY k, doc_id) - 1 AS BIGINT) AS row_index
FROM (SELECT doc_id, split,
        CAST('0x' || substr(md5('42:0:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS k
      FROM {DOCS})
""")
def q_seeded_shuffle(spark, sf):
    docs = documents(spark, sf).select("doc_id", "split")
    return order.seeded_shuffle(docs, seed=42, epoch=0, partition_by=["split"])


def _train_eval_index(spark, sf):
    docs = documents(spark, sf).select("doc_id", "split")
    return order.with_row_index(docs, ["doc_id"], "row_index", partition_by=["split"], size_col="n_rows")


_ROWS = f"""(SELECT doc_id, split,
  row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS ri,
  count(*) OVER (PARTITION BY split) AS n FROM {DOCS})"""


@query("assign_batches", f"""
SELECT doc_id, split, CAST(ri // 56 AS BIGINT) AS batch_id FROM {_ROWS}
WHERE split = 'train' AND ri // 56 < n // 56
UNION ALL
SELECT doc_id, split, CAST(ri // 112 AS BIGINT) AS batch_id FROM {_ROWS} WHERE split = 'validation'
""")
def q_assign_batches(spark, sf):
    idx = _train_eval_index(spark, sf)
    tr = idx.filter(F.col("split") == "train")
    ev = idx.filter(F.col("split") == "validation")
    a = bt.assign_batches(tr, 56, drop_last=True, total="n_rows")
    b = bt.assign_batches(ev, 112, drop_last=False)
    return a.unionByName(b).select("doc_id", "split", "batch_id")


@query("take_batches", f"""
SELECT doc_id, split, CAST(ri // 8 AS BIGINT) AS batch_id FROM {_ROWS}
WHERE split = 'train' AND ri // 8 < n // 8 AND ri // 8 < 10
UNION ALL
SELECT doc_id, split, CAST(ri // 16 AS BIGINT) AS batch_id FROM {_ROWS}
WHERE split = 'validation' AND ri // 16 < 5
""")
def q_take_batches(spark, sf):
    n_train, n_eval = bt.budget(2, 40, 8)  # -> 10 train batches, 5 eval batches
    idx = _train_eval_index(spark, sf)
    tr = bt.take_batches(bt.assign_batches(idx.filter(F.col("split") == "train"), 8, True, total="n_rows"), n_train)
    ev = bt.take_batches(bt.assign_batches(idx.filter(F.col("split") == "validation"), 16), n_eval)
    return tr.unionByName(ev).select("doc_id", "split", "batch_id")


@query("micro_batches", f"""
SELECT doc_id, split, CAST(ri // 56 AS BIGINT) AS batch_id,
       CAST((ri - (ri // 56) * 56) // 8 AS BIGINT) AS micro_id FROM {_ROWS}
""")
def q_micro_batches(spark, sf):
    idx = _train_eval_index(spark, sf)
    return bt.micro_batches(bt.assign_batches(idx, 56), 56, 8).select(
        "doc_id", "split", "batch_id", "micro_id")


# ---------------------------------------------------------------- streaming dedup
@query("dedup_stream", f"SELECT DISTINCT {TRIM} AS text FROM documents WHERE length({TRIM}) > 0")
def q_dedup_stream(spark, sf):
    from textloom import streaming

    src_dir = scratch_path(spark, "stream-in")
    docs = table(spark, sf, "documents")
    src.write_delimited(docs.select(F.concat(F.lit(" "), "text", F.lit("\n")).alias("text")), src_dir)
    stream = streaming.read_delimited_stream(spark, src_dir, repair_bytes=False,
                                             max_files_per_trigger=1000)
    out = streaming.dedup_stream(stream, "text")
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    streaming.run_available_now(out.select("text", "text_md5"), sink, ckpt)
    for path in (src_dir, ckpt):  # only the sink is read again
        artifacts.delete_path(spark, path)
    return spark.read.parquet(sink).select("text")


@query("dedup_stream_table", f"SELECT DISTINCT {TRIM} AS text FROM documents WHERE length({TRIM}) > 0")
def q_dedup_stream_table(spark, sf):
    """Several micro-batches against the table of seen hashes, compacted on the way."""
    from textloom import streaming

    base = scratch_path(spark, "seen")
    docs = table(spark, sf, "documents").repartition(9)
    src.write_delimited(docs.select(F.concat(F.lit(" "), "text", F.lit("\n")).alias("text")), f"{base}/in")
    stream = streaming.read_delimited_stream(spark, f"{base}/in", repair_bytes=False, max_files_per_trigger=2)
    streaming.run_dedup(stream.select("text"), f"{base}/out", f"{base}/state", f"{base}/ckpt", buckets=8, compact_every=3)
    for name in ("in", "state", "ckpt"):  # only the sink is read again
        artifacts.delete_path(spark, f"{base}/{name}")
    return streaming.read_deduped(spark, f"{base}/out").select("text")


@query("dedup_near", f"""
WITH RECURSIVE d AS (SELECT doc_id, split, regexp_extract_all(lower(text), '{WP}') AS w FROM {DOCS}),
e AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM e),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE m >= 0.8 * (na.n + nb.n - m)),
u AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT DISTINCT a AS id, a AS seen FROM u UNION SELECT r.id, u.b FROM r JOIN u ON r.seen = u.a),
c AS (SELECT id, min(seen) AS cluster FROM r GROUP BY id)
SELECT d.doc_id, d.split, coalesce(c.cluster, d.doc_id) AS cluster, coalesce(c.cluster, d.doc_id) <> d.doc_id AS duplicate
FROM d LEFT JOIN c ON c.id = d.doc_id
""")
def q_dedup_near(spark, sf):
    docs = documents(spark, sf).select("doc_id", "split", "text")
    out = dedup.dedup_near(docs, "doc_id", "text", threshold=0.8, keep_all=True)
    return out.select("doc_id", "split", "cluster", "duplicate")
