"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (decontam, fim, langid, license, lmscore, minhash, packing, quality, quotes, search, simhash,
                          urlfilter, warc)
from textloom.llm.common import checkpointed, read_table
from textloom.operators.bounded import skew_safe_lookup
from textloom.session import scratch_path
from textloom.sources.artifacts import delete_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return register


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'"


# ---------------------------------------------------------------- 5: decontamination
def _contract_words(table: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({table}, ''), {_AZ}), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@_query("op5_benchmark_decontamination", rf"""
WITH d AS (SELECT doc_id, {_contract_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_contract_words('text')} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS k, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS i
       FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS g FROM bw),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, w, unnest(range(greatest(len(w) - k + 1, 0))) AS i FROM d, ks),
dg AS (SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS g FROM dw),
hits AS (SELECT doc_id, dg.k, i, item_id FROM dg JOIN win ON dg.k = win.k AND dg.g = win.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM
       (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM
       (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "benchmark"))
    n_hit = F.size(decontam.hit_words(F.col("spans")))
    return found.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


# ---------------------------------------------------------------- 10: SimHash near-duplicates
@_query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return g.select(F.col("id").alias("doc_id"),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- 8: best-fit packing
def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


# ---------------------------------------------------------------- 9: quality rules
@_query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.model(docs, read_table(spark, sf_dir, "labels")))


# ---------------------------------------------------------------- 1: language identification
def held_out(id_col: str = "doc_id"):
    """The fold that training never sees; a null id is held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.filter(~held_out()))


@_query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


# ---------------------------------------------------------------- 3: WARC
_B32 = "".join(f"to_base(('0x' || substr(h, {1 + 5 * i}, 5))::INTEGER, 32, 4){' || ' if i < 7 else ''}"
               for i in range(8))


@_query("op3_warc", f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT page_id, octet_length(b) AS n, max(page_id) OVER (PARTITION BY h) AS keep,
      translate({_B32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS d FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to FROM k
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), path)
    summary = warc_summary(warc.read_warc(spark, path))
    delete_path(spark, path)  # the summary is checkpointed
    return summary


def warc_summary(found: DataFrame) -> DataFrame:
    """What the archives say of every page; a revisit has the full payload's
    length from the response that it refers to."""
    s = checkpointed(found.select(
        warc.page_of(F.col("record_id")).cast("long").alias("page_id"), F.col("type").alias("record_type"),
        warc.page_of(F.col("refers_to")).cast("long").alias("refers_to"),
        F.regexp_replace("digest", "^sha1:", "").alias("claimed"),
        F.length("payload").cast("long").alias("payload_bytes"),
        warc.base32_sha1(F.col("payload")).alias("payload_digest"), "ok"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    broken = F.when(~F.col("ok") | (F.col("payload_digest") != F.col("claimed")),
                    F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id").cast("string"))))
    whole = s.filter("record_type = 'response'").withColumn("page_id", F.coalesce(broken.cast("long"), "page_id"))
    again = s.filter("record_type = 'revisit'")
    of = whole.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    linked = skew_safe_lookup(
        again.select("page_id", "record_type", "refers_to", F.col("claimed").alias("payload_digest")),
        of, ["refers_to", "payload_digest"],
        again.groupBy("refers_to", F.col("claimed").alias("payload_digest")).agg(F.count("*").alias("w")))
    return whole.select(*names).unionByName(linked.select(*names))


# ---------------------------------------------------------------- 6: URL filters
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: a page's path names the document that it shows
_DOC_PATH = r"^/[a-z]+/([0-9]+)"


@_query("op6_url_filters", rf"""
WITH p AS (SELECT page_id, url, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {_AZ}), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, h, pre) AS (VALUES {', '.join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
m AS (SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(verdict, length(h || pre)) AS verdict
      FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id),
listed AS (SELECT DISTINCT host || path AS k FROM p JOIN labels
           ON toxic = 1 AND doc_id = TRY_CAST(regexp_extract(path, '{_DOC_PATH}', 1) AS BIGINT))
SELECT p.page_id, host, path, m.rule, coalesce(m.verdict,
       CASE WHEN host || path IN (SELECT k FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    found = urlfilter.filter_urls(pages, toxic_pages(pages, read_table(spark, sf_dir, "labels")), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def toxic_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The block list: keys of pages whose document is labelled toxic."""
    path = urlfilter.url_path(F.col("url"))
    at = pages.select(F.concat(urlfilter.url_host(F.col("url")), path).alias("key"),
                      F.regexp_extract(path, _DOC_PATH, 1).try_cast("bigint").alias("doc_id")).distinct()
    return at.join(labels.filter("toxic = 1").select("doc_id").distinct(), "doc_id").select("key")


# ---------------------------------------------------------------- 2: LM scoring
@_query("op2_lm_scoring", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
t AS (SELECT doc_id, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT count(*) AS n FROM t),
c1 AS (SELECT b AS g, count(*) AS c FROM t GROUP BY b),
d1 AS (SELECT doc_id, b AS g, count(*) AS c FROM t GROUP BY doc_id, b),
c2 AS (SELECT a, b, count(*) AS c FROM t WHERE a IS NOT NULL GROUP BY a, b),
d2 AS (SELECT doc_id, a, b, count(*) AS c FROM t WHERE a IS NOT NULL GROUP BY doc_id, a, b),
s1 AS (SELECT d1.doc_id, d1.g, c1.c - d1.c AS c FROM d1 JOIN c1 USING (g)),
s2 AS (SELECT d2.doc_id, d2.a, d2.b, c2.c - d2.c AS c FROM d2 JOIN c2 USING (a, b)),
tok AS (SELECT t.doc_id, t.i, s2.c AS pair, x.c AS word, y.c AS before,
        greatest((SELECT n FROM n) - len(d.w), 1) AS rest
        FROM t JOIN d USING (doc_id) JOIN s1 x ON x.doc_id = t.doc_id AND x.g = t.b
        LEFT JOIN s1 y ON y.doc_id = t.doc_id AND y.g = t.a
        LEFT JOIN s2 ON s2.doc_id = t.doc_id AND s2.a = t.a AND s2.b = t.b),
s AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE pair > 0) AS seen, avg(CASE
      WHEN pair > 0 THEN ln(pair / before)
      WHEN i = 1 THEN ln(CASE WHEN word > 0 THEN word ELSE {lmscore.UNSEEN} END / rest)
      ELSE ln({lmscore.BACKOFF}) + ln(CASE WHEN word > 0 THEN word ELSE {lmscore.UNSEEN} END / rest) END) AS m
      FROM tok GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_tokens, CAST(coalesce(s.seen, 0) AS BIGINT) AS n_pairs_seen,
       round(s.m, 6) AS log_score FROM d LEFT JOIN s USING (doc_id)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lmscore.backoff_scores(read_table(spark, sf_dir, "documents"))
    return s.withColumn("log_score", F.round("log_score", 6))


# ---------------------------------------------------------------- 4: licence scans
def document_path():
    """A file path for every document: source, language and a folder of 512
    ids; some documents are their folder's, language's or source's LICENSE."""
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))
    folder = F.floor(F.col("doc_id") / 512).cast("string")
    return (F.when(F.col("doc_id") % 960 == 0, F.concat_ws("/", source, F.lit("LICENSE")))
            .when(F.col("doc_id") % 320 == 0, F.concat_ws("/", source, lang, F.lit("LICENSE")))
            .when(F.col("doc_id") % 64 == 0, F.concat_ws("/", source, lang, folder, F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", source, lang, folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))))


_TEMPLATE_ROWS = ", ".join(f"('{n}', {i}, '{t}')" for n, xs in sorted(license.TEMPLATES.items())
                           for i, t in enumerate(xs))


@_query("op4_license_scan", rf"""
WITH tpl(name, i, t) AS (VALUES {_TEMPLATE_ROWS}),
tt AS (SELECT name, i, w, count(*) AS tf FROM (SELECT name, i,
       unnest(regexp_extract_all(lower(t), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS w FROM tpl) GROUP BY ALL),
ln AS (SELECT doc_id, l, p FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS p,
       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS l FROM documents)),
ps AS (SELECT * FROM ln UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
pt AS (SELECT doc_id, l, w, count(*) AS tf FROM (SELECT doc_id, l,
       unnest(regexp_extract_all(lower(p), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS w FROM ps) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, l FROM pt WHERE l > 0)),
voc AS (SELECT w, count(doc_id) AS df FROM (SELECT DISTINCT w FROM tt) LEFT JOIN (SELECT doc_id, w FROM pt WHERE l > 0) USING (w)
        GROUP BY w),
idf AS (SELECT w, floor(1000 * (ln((1 + n) / (1 + df)) + 1))::BIGINT AS x FROM voc, n),
rare AS (SELECT floor(1000 * (ln((1 + n) / 1) + 1))::BIGINT AS x FROM n),
nt AS (SELECT name, i, sum((tf * x) * (tf * x)) AS s FROM tt JOIN idf USING (w) GROUP BY ALL),
np AS (SELECT doc_id, l, sum((tf * coalesce(idf.x, rare.x)) * (tf * coalesce(idf.x, rare.x))) AS s
       FROM pt LEFT JOIN idf USING (w), rare GROUP BY ALL),
dot AS (SELECT doc_id, l, name, i, sum(pt.tf * x * tt.tf * x) AS s FROM pt JOIN tt USING (w) JOIN idf USING (w) GROUP BY ALL),
sc AS (SELECT doc_id, name, dot.s::DOUBLE / (sqrt(np.s::DOUBLE) * sqrt(nt.s::DOUBLE)) AS c
       FROM dot JOIN np USING (doc_id, l) JOIN nt USING (name, i)),
own AS (SELECT doc_id, c, name FROM sc WHERE c >= {license.THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, name) = 1),
f AS (SELECT doc_id, coalesce(source, 'none') AS a, coalesce(lang, 'none') AS b, CAST(doc_id // 512 AS VARCHAR) AS c FROM documents),
pth AS (SELECT doc_id, CASE WHEN doc_id % 960 = 0 THEN a || '/LICENSE' WHEN doc_id % 320 = 0 THEN a || '/' || b || '/LICENSE'
        WHEN doc_id % 64 = 0 THEN a || '/' || b || '/' || c || '/LICENSE'
        ELSE a || '/' || b || '/' || c || '/' || doc_id || '.txt' END AS path FROM f),
x AS (SELECT doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, name, own.c FROM pth LEFT JOIN own USING (doc_id)),
held AS (SELECT dir, arg_min(name, (-round(c, 9), name)) AS name FROM x WHERE name IS NOT NULL AND ends_with(path, '/LICENSE') GROUP BY dir),
near AS (SELECT x.doc_id, arg_max(held.dir, length(held.dir)) AS from_dir, arg_max(held.name, length(held.dir)) AS name
         FROM x JOIN held ON x.dir = held.dir OR starts_with(x.dir, held.dir || '/') WHERE x.name IS NULL GROUP BY x.doc_id)
SELECT x.doc_id, path, coalesce(x.name, near.name) AS license, round(x.c, 6) AS score,
       CASE WHEN x.name IS NOT NULL THEN 'own' WHEN near.name IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       near.from_dir FROM x LEFT JOIN near USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.license_scan(read_table(spark, sf_dir, "documents"), document_path())
    return found.withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------- 7: chat formatting
def as_mail(conversations: DataFrame) -> DataFrame:
    """The messages as mail writes them: what the turn before said is quoted
    once, what the one before that said twice."""
    c = conversations.select("conv_id", "turn", "text")
    said = c.groupBy("conv_id", "turn").agg(F.min("text").alias("_text"))
    back = lambda k: said.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("_text").alias(f"_b{k}"))
    quoted = lambda k, mark: F.concat(F.lit(mark), F.replace(F.col(f"_b{k}"), F.lit("\n"), F.lit("\n" + mark)))
    d = c.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    return d.select("conv_id", "turn", F.concat_ws(
        "\n", F.when(F.col("_b1").isNotNull(), F.lit("On the list, someone wrote:")), quoted(2, ">> "),
        quoted(1, "> "), F.coalesce("text", F.lit(""))).alias("text"))


@_query("op7_quotation_linking", r"""
WITH RECURSIVE said AS (SELECT conv_id, turn, min(text) AS t FROM conversations GROUP BY ALL),
q AS (SELECT a.conv_id, a.turn, 1 AS level, b.t FROM said a JOIN said b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
      UNION ALL SELECT a.conv_id, a.turn, 2, b.t FROM said a JOIN said b ON a.conv_id = b.conv_id AND a.turn = b.turn + 2
      UNION ALL SELECT conv_id, turn, 0, text FROM conversations),
l AS (SELECT conv_id, turn, level, trim(regexp_replace(lower(x), '\s+', ' ', 'g')) AS s
      FROM (SELECT conv_id, turn, level, unnest(string_split(t, chr(10))) AS x FROM q)),
n AS (SELECT conv_id, turn, level, s, count(*) AS n FROM l WHERE s <> '' GROUP BY ALL),
k AS (SELECT a.conv_id, a.turn, a.level, a.n, max(b.turn) AS source FROM n a LEFT JOIN n b
      ON a.conv_id = b.conv_id AND a.s = b.s AND b.level = 0 AND b.turn < a.turn WHERE a.level > 0
      GROUP BY a.conv_id, a.turn, a.level, a.s, a.n),
v AS (SELECT conv_id, turn, level, source, sum(n) AS votes FROM k WHERE source IS NOT NULL GROUP BY ALL),
best AS (SELECT conv_id, turn, level, source FROM v QUALIFY row_number() OVER (
         PARTITION BY conv_id, turn, level ORDER BY votes DESC, source DESC) = 1),
r AS (SELECT s.conv_id, s.turn, arg_min(source, level) AS reply_to FROM said s LEFT JOIN best b USING (conv_id, turn)
      GROUP BY s.conv_id, s.turn),
th AS (SELECT conv_id, turn, turn AS thread, CAST(0 AS BIGINT) AS depth FROM r WHERE reply_to IS NULL
       UNION ALL SELECT r.conv_id, r.turn, th.thread, th.depth + 1 FROM r JOIN th
       ON r.conv_id = th.conv_id AND r.reply_to = th.turn),
c AS (SELECT conv_id, turn, sum(n) AS n_quoted, sum(n) FILTER (WHERE source IS NOT NULL) AS n_linked FROM k GROUP BY ALL)
SELECT m.conv_id, m.turn, r.reply_to, th.thread, th.depth, CAST(coalesce(n_quoted, 0) AS BIGINT) AS n_quoted,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, md5(coalesce(m.text, '')) AS clean_md5
FROM conversations m LEFT JOIN r USING (conv_id, turn) LEFT JOIN th USING (conv_id, turn) LEFT JOIN c USING (conv_id, turn)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quotes.link_quotes(as_mail(read_table(spark, sf_dir, "conversations")))
    return found.select("conv_id", "turn", "reply_to", "thread", "depth", "n_quoted", "n_linked",
                        F.md5(F.col("clean_text")).alias("clean_md5"))


# ---------------------------------------------------------------- 11: fill in the middle
_DRAW = "CAST('0x' || substr(sha256('1:' || doc_id), {}, 8) AS BIGINT)"


@_query("op11_fill_in_middle", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           {', '.join(f"{_DRAW.format(8 * i + 1)} AS h{i + 1}" for i in range(4))} FROM documents),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {fim.PLAIN_FROM}
      THEN 'plain' WHEN h4 % 100 < {fim.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM d),
x AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM x
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "frames")
    found = fim.restore(fim.infill(fim.write_store(read_table(spark, sf_dir, "documents"), path)), keep_text=False)
    found = checkpointed(found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                                      "output_sha256", "restored_sha256"))
    delete_path(spark, path)  # the digests are checkpointed
    return found


# ---------------------------------------------------------------- 12: ranked lexical search
def _terms(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query("op12_ranked_search", rf"""
WITH t AS (SELECT rowid_ AS r, doc_id, unnest({_terms('text')}) AS w FROM (SELECT row_number() OVER () AS rowid_, * FROM documents)),
tf AS (SELECT r, doc_id, w, count(*) AS tf FROM t GROUP BY ALL),
len AS (SELECT r, sum(tf) AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS nd, sum(n) AS l FROM len),
q AS (SELECT DISTINCT qr, item_id, w FROM (SELECT qr, item_id, unnest({_terms('text')}) AS w
      FROM (SELECT row_number() OVER () AS qr, * FROM benchmark))),
df AS (SELECT w, count(*) AS df FROM tf WHERE w IN (SELECT w FROM q) GROUP BY w),
wt AS (SELECT w, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS wt FROM df, c),
s AS (SELECT qr, item_id, r, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + CAST((50 * n * nd) // l AS BIGINT))))) AS BIGINT) AS score
      FROM q JOIN wt USING (w) JOIN tf USING (w) JOIN len USING (r), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# ---------------------------------------------------------------- 13: MinHash near-duplicates
@_query("op13_minhash_near_dedup", rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM e),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * m >= {minhash.THRESHOLD} * (na.n + nb.n - m)),
u AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT DISTINCT a AS id, a AS seen FROM u UNION SELECT r.id, u.b FROM r JOIN u ON r.seen = u.a),
c AS (SELECT id, min(seen) AS least FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id,
       coalesce(c.least, d.doc_id) = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.id = d.doc_id
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.minhash_groups(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
