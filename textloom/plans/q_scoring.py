"""Registered queries: scoring (M1-M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.text import WHITESPACE_CLASS
from textloom.operators import scoring as sc
from textloom.plans.registry import query
from textloom.plans.tables import table

WS = f"[^{WHITESPACE_CLASS}]+"


@query("accuracy_quality", """
SELECT d.lang, avg(CAST((CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END) = l.quality AS INTEGER))
       AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM documents d JOIN labels l USING (doc_id) GROUP BY d.lang
""")
def q_acc_quality(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    pred = F.when(F.col("n_chars") > 500, 1).otherwise(0)
    return sc.accuracy(j, pred, "quality", ["lang"])


_LOGITS = "CAST(list_slice(embedding, 1, 10) AS DOUBLE[])"


@query("accuracy_argmax", f"""
SELECT label, avg(CAST(list_position({_LOGITS}, list_max({_LOGITS})) - 1 = label AS INTEGER))
       AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM embeddings GROUP BY label
""")
def q_acc_argmax(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("logits", F.slice("embedding", 1, 10))
    return sc.accuracy(e, sc.predicted_class("logits"), "label", ["label"])


_CE = f"""
l AS (SELECT label, {_LOGITS} AS x FROM embeddings),
m AS (SELECT label, x, list_max(x) AS mx FROM l),
s AS (SELECT label, x, mx + ln(list_sum(list_transform(x, lambda v: exp(v - mx)))) AS lse FROM m),
t AS (SELECT lse - x[label + 1] AS nll, lse - list_avg(x) AS smooth FROM s)"""


@query("cross_entropy", f"""
WITH {_CE}
SELECT CAST(0.1 AS DOUBLE) AS label_smoothing, round(avg(0.9 * nll + 0.1 * smooth), 9) AS loss,
       CAST(count(*) AS BIGINT) AS n_tokens FROM t
UNION ALL
SELECT CAST(0.0 AS DOUBLE), round(avg(nll), 9), CAST(count(*) AS BIGINT) FROM t
""")
def q_cross_entropy(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("logits", F.slice("embedding", 1, 10))
    a = sc.cross_entropy(e, "logits", "label", 0.1).withColumn("label_smoothing", F.lit(0.1))
    b = sc.cross_entropy(e, "logits", "label", 0.0).withColumn("label_smoothing", F.lit(0.0))
    return a.unionByName(b).withColumn("loss", F.round("loss", 9))


@query("perplexity", f"""
WITH {_CE}
SELECT round(exp(sum(nll) / count(nll)), 9) AS perplexity, CAST(count(*) AS BIGINT) AS n_tokens FROM t
""")
def q_perplexity(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("logits", F.slice("embedding", 1, 10))
    return sc.perplexity(e, "logits", "label").withColumn("perplexity",
                                                          F.round("perplexity", 9))


def scored_pairs(spark, sf):
    """Each conversation turn as reference; the prediction drops every 5th word."""
    c = table(spark, sf, "conversations")
    toks = sc.whitespace_tokens("text")
    pred = F.array_join(F.filter(toks, lambda x, i: (i + 1) % 5 != 0), " ")
    return c.select("conv_id", "turn", pred.alias("pred"), F.col("text").alias("ref"))


_PAIRS = f"""
t AS (SELECT conv_id, turn, text, regexp_extract_all(text, '{WS}') AS r FROM conversations),
pr AS (SELECT conv_id, turn, text AS ref_text,
        array_to_string(list_filter(r, lambda x, i: i % 5 <> 0), ' ') AS pred_text FROM t)"""


def _ngram_sql(tok_p: str, tok_r: str, orders: str) -> str:
    return f"""
tk AS (SELECT conv_id, turn, {tok_p} AS p, {tok_r} AS r FROM pr),
ns AS (SELECT unnest({orders}) AS n),
base AS (SELECT conv_id, turn, n, p, r FROM tk, ns),
gp AS (SELECT conv_id, turn, n, unnest(list_transform(range(greatest(len(p) - n + 1, 0)),
        lambda i: array_to_string(list_slice(p, i + 1, i + n), ' '))) AS g FROM base),
gr AS (SELECT conv_id, turn, n, unnest(list_transform(range(greatest(len(r) - n + 1, 0)),
        lambda i: array_to_string(list_slice(r, i + 1, i + n), ' '))) AS g FROM base),
cp AS (SELECT conv_id, turn, n, g, count(*) AS c FROM gp GROUP BY ALL),
cr AS (SELECT conv_id, turn, n, g, count(*) AS c FROM gr GROUP BY ALL),
mt AS (SELECT conv_id, turn, n, sum(least(cp.c, cr.c)) AS m FROM cp JOIN cr USING (conv_id, turn, n, g)
       GROUP BY ALL),
ov AS (SELECT b.conv_id, b.turn, b.n, greatest(len(b.p) - b.n + 1, 0) AS tp,
        greatest(len(b.r) - b.n + 1, 0) AS tr, coalesce(mt.m, 0) AS m
       FROM base b LEFT JOIN mt USING (conv_id, turn, n))"""


@query("bleu", f"""
WITH {_PAIRS},
{_ngram_sql(f"regexp_extract_all(pred_text, '{WS}')", f"regexp_extract_all(ref_text, '{WS}')",
            '[1, 2, 3, 4]')},
pn AS (SELECT n, sum(m) AS m, sum(tp) AS t, sum(tr) AS tr FROM ov GROUP BY n),
agg AS (SELECT max(CASE WHEN n = 1 THEN m / t END) AS p1, max(CASE WHEN n = 2 THEN m / t END) AS p2,
        max(CASE WHEN n = 3 THEN m / t END) AS p3, max(CASE WHEN n = 4 THEN m / t END) AS p4,
        min(m) AS min_m, avg(ln(m / t)) AS log_mean,
        max(CASE WHEN n = 1 THEN t END) AS c, max(CASE WHEN n = 1 THEN tr END) AS r FROM pn),
b AS (SELECT *, CASE WHEN c > r THEN 1.0 ELSE exp(1 - r / c) END AS bp FROM agg)
SELECT round(CASE WHEN min_m > 0 THEN bp * exp(log_mean) ELSE 0.0 END, 9) AS bleu,
       round(bp, 9) AS brevity_penalty, round(p1, 9) AS p1, round(p2, 9) AS p2,
       round(p3, 9) AS p3, round(p4, 9) AS p4 FROM b
""")
def q_bleu(spark, sf):
    out = sc.bleu(scored_pairs(spark, sf), ["conv_id", "turn"], "pred", "ref")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


_RT = "list_filter(string_split_regex(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


@query("rouge_n", f"""
WITH {_PAIRS},
{_ngram_sql(_RT.format(x='pred_text'), _RT.format(x='ref_text'), '[1, 2]')},
s AS (SELECT n, CASE WHEN tp > 0 THEN m / tp ELSE 0.0 END AS p,
             CASE WHEN tr > 0 THEN m / tr ELSE 0.0 END AS r FROM ov)
SELECT n, round(avg(p), 9) AS precision, round(avg(r), 9) AS recall,
       round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END), 9) AS fmeasure,
       CAST(count(*) AS BIGINT) AS n_rows FROM s GROUP BY n
""")
def q_rouge_n(spark, sf):
    out = sc.rouge_n(scored_pairs(spark, sf), ["conv_id", "turn"], "pred", "ref", (1, 2))
    return out.select("n", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "fmeasure")],
                      "n_rows")


# one row per (pair, reference sentence, predicted sentence): tokens r and p
_SENTENCES = "list_filter(list_transform(string_split({x}, chr(10)), lambda s: " + _RT.format(x="s") + "), lambda t: len(t) > 0)"


def _lcs_sql(pairs: str) -> str:
    """CTEs ``l(k, j, i, v)``: the LCS of the first i tokens of r and the first j of p,
    a row of the table per step, from ``pairs(k, r, p)``."""
    return f"""
lt AS MATERIALIZED (SELECT k, r, p FROM {pairs} WHERE len(r) > 0 AND len(p) > 0),
a AS MATERIALIZED (SELECT k, CAST(i AS INTEGER) AS i, r[i] AS tok FROM (SELECT k, r, unnest(range(1, len(r) + 1)) AS i FROM lt)),
l AS (SELECT k, 0 AS j, i, 0 AS v FROM a
      UNION ALL
      SELECT k, j + 1, i, max(c) OVER (PARTITION BY k ORDER BY i) FROM (
        SELECT l.k, l.j, l.i, greatest(l.v, CASE WHEN a.tok = lt.p[l.j + 1]
               THEN coalesce(lag(l.v) OVER (PARTITION BY l.k ORDER BY l.i), 0) + 1 ELSE 0 END) AS c
        FROM l JOIN lt ON l.k = lt.k AND l.j < len(lt.p) JOIN a ON a.k = l.k AND a.i = l.i))"""


_PRF_SQL = """
SELECT round(avg(pr), 9) AS precision, round(avg(re), 9) AS recall,
       round(avg(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END), 9) AS fmeasure, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT CASE WHEN np > 0 THEN m / np ELSE 0.0 END AS pr, CASE WHEN nr > 0 THEN m / nr ELSE 0.0 END AS re FROM s)"""


@query("rouge_l", f"""
WITH RECURSIVE {_PAIRS},
q AS MATERIALIZED (SELECT row_number() OVER () AS k, {_RT.format(x='ref_text')} AS r, {_RT.format(x='pred_text')} AS p FROM pr),
{_lcs_sql('q')},
m AS (SELECT l.k, max(v) AS m FROM l JOIN lt ON l.k = lt.k AND l.j = len(lt.p) GROUP BY l.k),
s AS (SELECT coalesce(m, 0) AS m, len(p) AS np, len(r) AS nr FROM q LEFT JOIN m USING (k)){_PRF_SQL}
""")
def q_rouge_l(spark, sf):
    out = sc.rouge_l(scored_pairs(spark, sf), ["conv_id", "turn"], "pred", "ref")
    return out.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "fmeasure")], "n_rows")


@query("rouge_lsum", f"""
WITH RECURSIVE {_PAIRS},
x AS MATERIALIZED (SELECT row_number() OVER () AS id, {_SENTENCES.format(x='ref_text')} AS rs, {_SENTENCES.format(x='pred_text')} AS ps FROM pr),
q AS MATERIALIZED (SELECT row_number() OVER () AS k, id, ri, r, p FROM (
      SELECT id, ri, rs[ri] AS r, unnest(ps) AS p FROM (SELECT id, rs, ps, unnest(range(1, len(rs) + 1)) AS ri FROM x))),
{_lcs_sql('q')},
g AS MATERIALIZED (SELECT lt.k, lt.r, lt.p, vs FROM lt JOIN (SELECT k, list(vr ORDER BY j) AS vs FROM
      (SELECT k, j, list_prepend(0, list(v ORDER BY i)) AS vr FROM l GROUP BY k, j) GROUP BY k) USING (k)),
-- back from the end: a match is a hit; else one token less of the reference if that costs nothing or losing the other's costs more
w AS (SELECT k, CAST(len(r) AS INTEGER) AS i, CAST(len(p) AS INTEGER) AS j, NULL::INTEGER AS hit FROM g
      UNION ALL
      SELECT k, CASE WHEN same OR back THEN i - 1 ELSE i END, CASE WHEN same OR NOT back THEN j - 1 ELSE j END, CASE WHEN same THEN i END
      FROM (SELECT w.k, w.i, w.j, g.r[w.i] = g.p[w.j] AS same,
              vs[w.j + 1][w.i + 1] = vs[w.j + 1][w.i] OR vs[w.j + 1][w.i + 1] > vs[w.j][w.i + 1] AS back
            FROM w JOIN g ON g.k = w.k AND w.i > 0 AND w.j > 0)),
h AS (SELECT DISTINCT q.id, q.ri, w.hit, q.r[w.hit] AS tok FROM w JOIN q USING (k) WHERE w.hit IS NOT NULL),
hc AS (SELECT id, tok, count(*) AS n FROM h GROUP BY ALL),
pc AS (SELECT id, tok, count(*) AS n FROM (SELECT id, unnest(flatten(ps)) AS tok FROM x) GROUP BY ALL),
m AS (SELECT id, sum(least(hc.n, pc.n)) AS m FROM hc JOIN pc USING (id, tok) GROUP BY id),
s AS (SELECT coalesce(m, 0) AS m, len(flatten(ps)) AS np, len(flatten(rs)) AS nr FROM x LEFT JOIN m USING (id)){_PRF_SQL}
""")
def q_rouge_lsum(spark, sf):
    out = sc.rouge_lsum(scored_pairs(spark, sf), ["conv_id", "turn"], "pred", "ref")
    return out.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "fmeasure")], "n_rows")
