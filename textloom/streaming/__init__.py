"""Structured Streaming operators."""

from textloom.streaming.dedup import (SeenTable, dedup_stream, read_deduped,  # noqa: F401
                                      read_delimited_stream, run_available_now, run_dedup)
