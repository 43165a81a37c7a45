"""Registered queries: one per inventory operator, each over whole driver
tables, each (where SQL can state it) paired with a DuckDB oracle."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from textloom.plans import q_corpus, q_tokens, q_packing, q_scoring, q_runs  # noqa: F401
