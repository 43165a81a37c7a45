"""Scans, sources and sinks."""

from textloom.sources.text import (read_delimited_docs, decode_repair, read_whole_docs,  # noqa: F401
                                   from_records, write_delimited)
from textloom.sources.files import route_files, DEFAULT_RULES, Rule  # noqa: F401
from textloom.sources.splits import with_split, read_labelled, save_splits, load_splits  # noqa: F401
from textloom.sources.artifacts import materialize, artifact_path, path_exists  # noqa: F401
