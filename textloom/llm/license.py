"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates,
then inheritance from the nearest ancestor directory.

Every line of every text, every block (a run of lines that are not blank or
of comment lines, comment marks removed), and every text as a whole, is a candidate
passage; an SPDX tag names its licence itself.  A passage's TF-IDF vector is compared with each template's.  Document frequencies of the
template words (a fixed vocabulary) are counted over all lines of the corpus; words
outside it weigh as much as a word never seen, so prose around a few common words
scores low.  Weights are whole numbers, so that sums do not depend on order.

Texts are scored where they are read.  Only paths move: directories that need a
licence are exploded to their ancestors, joined to directories that have one, and
the deepest wins; files then look up their directory, hot directories salted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed
from textloom.operators.bounded import skew_safe_lookup

THRESHOLD = 0.7
LICENSE_NAMES = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
# comment marks around a line: // # ; -- % * /* */ <!-- --> and """
_OPEN = re.compile(r"\s*(?://+!?|#+!?|;+|--+|%+|/\*+!?|\*+(?!/)|<!--+|\"{3}|'{3}|(?i:rem|dnl)(?=\s|$))\s?")
_CLOSE = re.compile(r"\s*(?:\*+/|--+>|\"{3}|'{3})\s*$")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)", re.I)
_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

# fixed values: notices by which projects name these licences
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                   "except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met.",
                     "Use of this source code is governed by a BSD-style license."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either version 3."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def terms(passage: str) -> list[str]:
    return _TERM.findall(passage.lower())


def weight(df: int, lines: int) -> int:
    """Inverse document frequency in thousandths."""
    return math.floor(1000 * (math.log((1 + lines) / (1 + df)) + 1))


def line_frequencies(docs: DataFrame, text_col: str = "text",
                     templates: dict[str, list[str]] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of lines with a term, and of each template word the lines that hold it."""
    vocabulary = frozenset(t for texts in templates.values() for x in texts for t in terms(x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, Counter()
        for b in batches:
            for t in b.column(0):
                for line in (t.as_py() or "").split("\n"):
                    if found := terms(line):
                        n += 1
                        df.update(vocabulary.intersection(found))
        yield pa.RecordBatch.from_arrays([pa.array([None, *df], pa.string()), pa.array([n, *df.values()], pa.int64())],
                                         ["term", "n"])

    rows = (docs.select(text_col).mapInArrow(run, "term string, n long").groupBy("term")
            .agg(F.sum("n").alias("n")).collect())  # one row per template word
    found = {r.term: r.n for r in rows}
    return found.pop(None, 0), found


def blocks(lines: list[str]) -> Iterator[str]:
    """Runs of two or more lines that are not blank without their comment
    marks, and runs of comment lines within or across them.  Words cut at a
    hyphen are joined."""
    bare, marked, inside = [], [], False
    for line in lines:
        x = _OPEN.sub("", line, count=1) if _OPEN.match(line) else line
        opened = re.search(r"/\*|<!--", line)
        marked.append(inside or x is not line)
        shut = _CLOSE.search(line)
        inside = (inside or bool(opened)) and not shut
        bare.append(_CLOSE.sub("", x))
    for kind in ([bool(x.strip()) for x in bare], [m and bool(x.strip()) for m, x in zip(marked, bare)], marked):
        start = None
        for i, on in enumerate([*kind, False]):
            if on and start is None:
                start = i
            elif not on and start is not None:
                if i - start > 1:
                    yield re.sub(r"-\n\s*", "-", "\n".join(bare[start:i]))
                start = None


class Matcher:
    """Best template of a passage by cosine."""

    def __init__(self, lines: int, df: dict[str, int], templates: dict[str, list[str]] = TEMPLATES,
                 threshold: float = THRESHOLD):
        self.idf = {t: weight(df.get(t, 0), lines) for x in templates.values() for y in x for t in terms(y)}
        self.rare = weight(0, lines)
        self.threshold = threshold
        self.templates = []
        for name in sorted(templates):
            for text in templates[name]:
                tf = Counter(terms(text))
                self.templates.append((name, {t: n * self.idf[t] for t, n in tf.items()},
                                       sum((n * self.idf[t]) ** 2 for t, n in tf.items())))
        self.vocabulary = frozenset(self.idf)
        self.names = sorted(templates)

    def best(self, passage: str) -> tuple[str, float] | None:
        """Licence and cosine if at least the threshold; of equal cosines the
        first name."""
        found = terms(passage)
        known = self.vocabulary.intersection(found)
        if not known:
            return None
        tf = Counter(found)
        inside = sum((tf[t] * self.idf[t]) ** 2 for t in known)
        norm = inside + self.rare ** 2 * sum(n * n for t, n in tf.items() if t not in known)
        if inside < self.threshold ** 2 * norm * 0.999:  # no cosine can reach the threshold
            return None
        top = None
        for name, vec, size in self.templates:
            dot = sum(tf[t] * self.idf[t] * vec[t] for t in known if t in vec)
            cos = float(dot) / (math.sqrt(float(norm)) * math.sqrt(float(size)))
            if cos >= self.threshold and (top is None or cos > top[1]):
                top = (name, cos)
        return top

    def tagged(self, text: str) -> Iterator[tuple[str, float]]:
        """Licences with templates that SPDX tags name."""
        for m in _SPDX.finditer(text):
            tag = re.sub(r"(?i)(-only|-or-later|\+)$", "", m[1].rstrip(".")).lower()
            yield from ((name, 1.0) for name in self.names if name.lower() == tag)

    def scan(self, text: str | None) -> tuple[str, float] | None:
        """Best over all SPDX tags, lines, blocks and the text as a whole."""
        text = text or ""
        lines = text.split("\n")
        passages = [*lines, *blocks(lines), text] if len(lines) > 1 else lines
        found = [m for x in dict.fromkeys(passages) if (m := self.best(x))]
        found += self.tagged(text)
        return min(found, key=lambda m: (-m[1], m[0])) if found else None


def directory(path: Column) -> Column:
    """Path without its last part; the top directory is empty."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def inherit(files: DataFrame) -> DataFrame:
    """``files(id, path, license, score)`` with ``origin`` (``own``,
    ``inherited`` or ``none``) and ``from_dir``.

    A directory's licence is that of the licence files in it: the best score
    (to nine digits), then the first name.  Files without a licence take that of the nearest
    directory at or above theirs that has one.  Null paths inherit nothing."""
    d = files.withColumn("dir", directory(F.col("path")))
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    held = d.filter(F.col("license").isNotNull() & name.rlike(LICENSE_NAMES)).groupBy("dir").agg(
        F.min(F.struct((-F.round("score", 9)).alias("s"), "license")).alias("_best"))
    held = checkpointed(held.select(F.col("dir").alias("from_dir"), F.col("_best.license").alias("_license")))
    dirs = checkpointed(d.filter("license IS NULL AND path IS NOT NULL").groupBy("dir").agg(F.count("*").alias("w")))
    parts = F.split("dir", "/")
    depths = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    above = dirs.select("dir", F.explode(depths).alias("depth"))
    above = above.withColumn("from_dir", F.concat_ws("/", F.slice(F.split("dir", "/"), 1, F.col("depth"))))
    weights = above.groupBy("from_dir").agg(F.count("*").alias("w"))
    near = skew_safe_lookup(above, held, ["from_dir"], weights, how="inner")
    near = near.groupBy("dir").agg(F.max_by(F.struct("from_dir", "_license"), "depth").alias("_near"))
    near = checkpointed(near.select("dir", "_near"))
    j = skew_safe_lookup(d, near, ["dir"], dirs, salt_by=["id", "path"])
    own = F.col("license").isNotNull()
    got = ~own & F.col("_near").isNotNull()
    return j.select("id", "path", F.coalesce("license", F.col("_near._license")).alias("license"), "score",
                    F.when(own, "own").when(got, "inherited").otherwise("none").alias("origin"),
                    F.when(got, F.col("_near.from_dir")).alias("from_dir"))


def license_scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, path, ``license``, ``score`` (cosine of
    its own notice, or null), ``origin`` and ``from_dir``.

    Null and empty texts have no notice of their own; repeated rows each give a
    row; an empty table gives none."""
    lines, df = line_frequencies(docs, text_col, templates)
    matcher = Matcher(lines, df, templates, threshold)
    d = docs.select(F.col(id_col).alias("id"), path.cast("string").alias("path"), F.col(text_col).alias("_text"))
    kind = dict(d.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [matcher.scan(t.as_py()) or (None, None) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], ["id", "path", "license", "score"])

    files = checkpointed(d.mapInArrow(run, f"id {kind}, path string, license string, score double"))
    return inherit(files).withColumnRenamed("id", id_col)
