"""M1-M6: corpus-level scores over tables of predictions.

Counts are exploded and joined per row key, never collected: BLEU and
ROUGE-N are n-gram count joins plus aggregates; ROUGE-L needs an LCS, which
runs as an Arrow-batched pandas UDF using a bit-parallel LCS (Python big
integers), so long texts stay near-linear per word.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrays import IGNORE_INDEX, argmax, log_softmax_at, mean_neg_log_softmax
from textloom.functions.text import WHITESPACE_CLASS, col_of


def accuracy(df: DataFrame, pred, label, by=()) -> DataFrame:
    """M1: micro accuracy (optionally per group)."""
    hit = (col_of(pred) == col_of(label)).cast("int")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"),
                               F.count(F.lit(1)).cast("long").alias("n"))


def predicted_class(logits) -> Column:
    """Arg-max of a logits array (0-based)."""
    return argmax(logits)


def token_losses(df: DataFrame, logits: str, label: str, smoothing: float = 0.0) -> DataFrame:
    """Per-row loss terms: ``nll = -log p[label]`` and the smoothed loss
    ``(1-e)*nll + e*mean_k(-log p_k)``; rows labelled -100 are dropped."""
    lg = F.col(logits)
    kept = df.filter(F.col(label) != IGNORE_INDEX)
    nll = -log_softmax_at(lg, F.col(label))
    loss = nll if smoothing == 0 else (1 - smoothing) * nll + smoothing * mean_neg_log_softmax(lg)
    return kept.withColumn("nll", nll).withColumn("loss", loss)


def cross_entropy(df: DataFrame, logits: str, label: str, smoothing: float = 0.0, by=()
                  ) -> DataFrame:
    """M2: mean label-smoothed softmax cross-entropy."""
    return token_losses(df, logits, label, smoothing).groupBy(*by).agg(
        F.avg("loss").alias("loss"), F.count(F.lit(1)).cast("long").alias("n_tokens"))


def perplexity(df: DataFrame, logits: str, label: str, by=()) -> DataFrame:
    """M3: ``exp(total nll / counted tokens)``."""
    return token_losses(df, logits, label).groupBy(*by).agg(
        F.exp(F.sum("nll") / F.count("nll")).alias("perplexity"),
        F.count(F.lit(1)).cast("long").alias("n_tokens"))


def whitespace_tokens(c) -> Column:
    return F.regexp_extract_all(col_of(c), F.lit(f"[^{WHITESPACE_CLASS}]+"), F.lit(0))


def rouge_tokens(c) -> Column:
    """Lower-case, anything but ``[a-z0-9]`` is a separator."""
    return F.filter(F.split(F.regexp_replace(F.lower(col_of(c)), "[^a-z0-9]+", " "), " "),
                    lambda t: t != "")


def _ngrams(tokens: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    cnt = F.size(tokens) - n + 1
    starts = F.sequence(F.lit(1), F.greatest(cnt, F.lit(1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.slice(grams, 1, F.greatest(cnt, F.lit(0)))


def ngram_overlap(df: DataFrame, key, pred_tokens: str, ref_tokens: str, orders=(1, 2, 3, 4)
                  ) -> DataFrame:
    """Per (key, n): clipped matches and the n-gram totals of both sides."""
    key = [key] if isinstance(key, str) else list(key)
    ns = F.array(*[F.lit(int(n)) for n in orders])
    base = df.select(*key, pred_tokens, ref_tokens, F.explode(ns).alias("n"))

    def grams(tok, side):
        return base.select(*key, "n", F.explode(_ngrams(F.col(tok), F.col("n"))).alias("g"), F.lit(side).alias("p"))

    # both sides in one grouping, not joined: the size of a table says little about that of its
    # n-grams, and a side that is taken for small would go through the driver
    known = F.lit(True)
    for k in key:  # null keys meet nothing
        known = known & F.col(k).isNotNull()
    both = grams(pred_tokens, 1).unionByName(grams(ref_tokens, 0)).filter(known)
    matches = (both.groupBy(*key, "n", "g").agg(F.sum("p").alias("c_p"), F.count(F.lit(1)).alias("c"))
               .groupBy(*key, "n").agg(F.sum(F.least(F.col("c_p"), F.col("c") - F.col("c_p"))).cast("long").alias("m")))
    totals = base.select(*key, "n",
                         F.greatest(F.size(pred_tokens) - F.col("n") + 1, F.lit(0)).alias("tp"),
                         F.greatest(F.size(ref_tokens) - F.col("n") + 1, F.lit(0)).alias("tr"))
    return (totals.join(matches.hint("merge"), [*key, "n"], "left")
            .withColumn("m", F.coalesce("m", F.lit(0)).cast("long")))


def bleu(df: DataFrame, key, pred: str, ref: str, max_order: int = 4) -> DataFrame:
    """M4: corpus BLEU with whitespace tokens, clipped counts summed over the
    corpus, brevity penalty; 0 when some order has no match."""
    toks = df.select(*([key] if isinstance(key, str) else key),
                     whitespace_tokens(pred).alias("_p"), whitespace_tokens(ref).alias("_r"))
    ov = ngram_overlap(toks, key, "_p", "_r", tuple(range(1, max_order + 1)))
    per_n = ov.groupBy("n").agg(F.sum("m").alias("m"), F.sum("tp").alias("t"),
                                F.sum("tr").alias("tr"))
    # unigram totals are the corpus lengths
    out = per_n.agg(*[F.max(F.when(F.col("n") == n, F.try_divide(F.col("m"), F.col("t")))).alias(f"p{n}")
                      for n in range(1, max_order + 1)],
                    F.min("m").alias("min_m"),
                    F.avg(F.log(F.try_divide(F.col("m"), F.col("t")))).alias("log_mean"),
                    F.max(F.when(F.col("n") == 1, F.col("t"))).alias("c"),
                    F.max(F.when(F.col("n") == 1, F.col("tr"))).alias("r"))
    bp = F.when(F.col("c") > F.col("r"), F.lit(1.0)).otherwise(
        F.exp(1 - F.try_divide(F.col("r"), F.col("c"))))
    score = F.when(F.col("min_m") > 0, bp * F.exp("log_mean")).otherwise(F.lit(0.0))
    return out.select(score.alias("bleu"), bp.alias("brevity_penalty"),
                      *[f"p{n}" for n in range(1, max_order + 1)])


def _prf(m: Column, tp: Column, tr: Column):
    p = F.when(tp > 0, m / tp).otherwise(F.lit(0.0))
    r = F.when(tr > 0, m / tr).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f


def rouge_n(df: DataFrame, key, pred: str, ref: str, orders=(1, 2)) -> DataFrame:
    """M5: ROUGE-N P/R/F1 per row from clipped overlap, averaged over rows."""
    toks = df.select(*([key] if isinstance(key, str) else key),
                     rouge_tokens(pred).alias("_p"), rouge_tokens(ref).alias("_r"))
    ov = ngram_overlap(toks, key, "_p", "_r", orders)
    p, r, f = _prf(F.col("m"), F.col("tp"), F.col("tr"))
    return ov.groupBy("n").agg(F.avg(p).alias("precision"), F.avg(r).alias("recall"),
                               F.avg(f).alias("fmeasure"), F.count(F.lit(1)).cast("long")
                               .alias("n_rows"))


def lcs_length(a: list, b: list) -> int:
    """Bit-parallel LCS length (Hyyro): one big-int step per token of ``b``."""
    if not a or not b:
        return 0
    masks: dict = {}
    for i, t in enumerate(a):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def _lcs_positions(a: list, b: list) -> set[int]:
    """Positions of ``a`` in one longest common subsequence.

    Keeps one bit row per token of ``b`` (a zero bit: the LCS grows at that
    token of ``a``), a 64th of the cells of a table of numbers."""
    if not a or not b:
        return set()
    masks: dict = {}
    for i, t in enumerate(a):
        masks[t] = masks.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    rows = [full]
    for t in b:
        u = rows[-1] & masks.get(t, 0)
        rows.append(((rows[-1] + u) | (rows[-1] - u)) & full)
    length = lambda i, j: i - (rows[j] & ((1 << i) - 1)).bit_count()
    i, j, hits = len(a), len(b), set()
    while i > 0 and j > 0:
        if a[i - 1] == b[j - 1]:
            hits.add(i - 1)
            i, j = i - 1, j - 1
        # one shorter in `a` is as good, or losing either costs the same
        elif rows[j] >> (i - 1) & 1 or length(i, j) > length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return hits


def union_lcs_hits(ref_sents: list[list], pred_sents: list[list]) -> int:
    """ROUGE-Lsum numerator: per reference sentence, the union of LCS hits
    against every predicted sentence, clipped by remaining token counts."""
    from collections import Counter

    ref_cnt = Counter(t for s in ref_sents for t in s)
    pred_cnt = Counter(t for s in pred_sents for t in s)
    hits = 0
    for r in ref_sents:
        union: set[int] = set()
        for p in pred_sents:
            union |= _lcs_positions(r, p)
        for i in sorted(union):
            t = r[i]
            if ref_cnt[t] > 0 and pred_cnt[t] > 0:
                hits += 1
                ref_cnt[t] -= 1
                pred_cnt[t] -= 1
    return hits


@F.pandas_udf(T.LongType())
def lcs_udf(pred: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(r), list(p)) for p, r in zip(pred, ref)], dtype="int64")


@F.pandas_udf(T.LongType())
def union_lcs_udf(pred: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([union_lcs_hits([list(s) for s in r], [list(s) for s in p])
                      for p, r in zip(pred, ref)], dtype="int64")


def rouge_l(df: DataFrame, key, pred: str, ref: str) -> DataFrame:
    """M6: ROUGE-L (whole text LCS) P/R/F1 averaged over rows."""
    toks = df.select(*([key] if isinstance(key, str) else key),
                     rouge_tokens(pred).alias("_p"), rouge_tokens(ref).alias("_r"))
    scored = toks.withColumn("m", lcs_udf("_p", "_r"))
    p, r, f = _prf(F.col("m"), F.size("_p"), F.size("_r"))
    return scored.agg(F.avg(p).alias("precision"), F.avg(r).alias("recall"),
                      F.avg(f).alias("fmeasure"), F.count(F.lit(1)).cast("long").alias("n_rows"))


def rouge_lsum(df: DataFrame, key, pred: str, ref: str) -> DataFrame:
    """M6: ROUGE-Lsum: sentences split at newlines, union LCS per reference sentence."""
    def sents(c):
        return F.filter(F.transform(F.split(F.col(c), "\n"), lambda s: rouge_tokens(s)),
                        lambda a: F.size(a) > 0)
    toks = df.select(*([key] if isinstance(key, str) else key),
                     sents(pred).alias("_p"), sents(ref).alias("_r"))
    scored = toks.withColumn("m", union_lcs_udf("_p", "_r"))
    n_p = F.aggregate("_p", F.lit(0), lambda acc, s: acc + F.size(s))
    n_r = F.aggregate("_r", F.lit(0), lambda acc, s: acc + F.size(s))
    p, r, f = _prf(F.col("m"), n_p, n_r)
    return scored.agg(F.avg(p).alias("precision"), F.avg(r).alias("recall"),
                      F.avg(f).alias("fmeasure"), F.count(F.lit(1)).cast("long").alias("n_rows"))
