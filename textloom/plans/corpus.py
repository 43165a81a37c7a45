"""Corpus flow: clean -> exact dedup -> pre-tokenise -> counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import trim_chars, word_tokens
from textloom.operators.dedup import dedup_exact
from textloom.plans.tables import documents


def unique_tokens_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents survive exact dedup per language, and how many
    pre-tokenizer tokens they hold."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", trim_chars("text").alias("text"))
    kept = dedup_exact(docs, "text", partition_by=["lang"], order_by="doc_id")
    return (kept.groupBy("lang").agg(
        F.count(F.lit(1)).cast("long").alias("docs_kept"),
        F.sum(F.size(word_tokens("text"))).cast("long").alias("n_tokens")))
