import textwrap

import pytest
from pyspark.sql import functions as F

from textloom.llm import license as L

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


@pytest.mark.parametrize("text,name", [
    (MIT, "MIT"), ("  released UNDER the mit license\nother words", "MIT"), ("prose first\n" + GPL + "\nprose after", "GPL-3.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under the\nApache License,\nVersion 2.0.", "Apache-2.0"),  # only the whole text tells
    ("the house under the tree of the garden", None), (None, None), ("", None), ("\n\n", None), ("license", None)])
def test_notices(text, name):
    df = {t: 5 for t in ("the", "of", "under", "this", "work", "is")}
    found = L.Matcher(100, df).scan(text)
    assert (found and found[0]) == name
    if found:
        assert 0.7 <= found[1] <= 1.0000001


CODE = "\n".join(f"int f{i}(int a) {{\n  return a + {i};\n}}" for i in range(60))


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
@pytest.mark.parametrize("width", [30, 50, 60, 72])
@pytest.mark.parametrize("mark,gap", [("", "\n"), ("// ", ""), ("# ", "\n"), (" * ", "")])
def test_wrapped_headers_before_code(name, width, mark, gap):
    header = textwrap.fill(L.TEMPLATES[name][-1], width, initial_indent=mark, subsequent_indent=mark)
    if mark == " * ":
        header = "/*\n" + header + "\n */"
    found = L.Matcher(1000, {"the": 400, "of": 300, "a": 300, "and": 300, "in": 200}).scan(f"{header}\n{gap}{CODE}")
    assert found and found[0] == name


@pytest.mark.parametrize("tag,name", [("MIT", "MIT"), ("GPL-3.0-or-later", "GPL-3.0"), ("GPL-3.0-only", "GPL-3.0"), ("GPL-3.0+", "GPL-3.0"),
                                      ("apache-2.0", "Apache-2.0"), ("LGPL-3.0", None), ("MIT-0", None)])
def test_spdx_tags(tag, name):
    found = L.Matcher(1000, {"the": 400}).scan(f"// SPDX-License-Identifier: {tag}\n{CODE}")
    assert (found and found[0]) == name


def test_pruning_changes_nothing():
    m = L.Matcher(50, {"the": 40, "license": 3})
    plain = L.Matcher(50, {"the": 40, "license": 3}, threshold=0.0)
    for text in (MIT, GPL, "the the license", "under the hat", MIT + " extra words follow here", "apache license tree"):
        best = plain.best(text)
        assert m.best(text) == (best if best and best[1] >= 0.7 else None)


def rows():
    prose = "some words without any notice"
    return [(1, "a/LICENSE", MIT), (2, "a/b/x.txt", prose), (3, "a/b/c/LICENSE", GPL), (4, "a/b/c/d/y.txt", prose),
            (5, "a/b/c/z.txt", "Licensed under CC BY 4.0."), (6, "q/x.txt", prose), (7, None, prose), (8, "top.txt", None),
            (9, "a2/x.txt", prose), (10, "a/b/LICENSE", prose), (11, "a/license.md", GPL), (None, "a/n.txt", ""), (2, "a/b/x.txt", prose),
            (12, "a/MIT.txt", MIT)] + [(100 + i, "a/hot/x%d" % i, prose) for i in range(30)]


def test_nearest_directory_wins(spark):
    df = spark.createDataFrame([(i, p, t, "x", 1) for i, p, t in rows()], "doc_id long, p string, text string, license string, dir int")
    got = L.license_scan(df, F.col("p")).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: (r.license, r.origin, r.from_dir) for r in got}
    # two licence files in "a" with equal scores: the first name
    assert by[2] == ("GPL-3.0", "inherited", "a") and by[10] == ("GPL-3.0", "inherited", "a") and by[None] == ("GPL-3.0", "inherited", "a")
    assert by[4] == ("GPL-3.0", "inherited", "a/b/c") and by[3] == ("GPL-3.0", "own", None)
    assert by[5] == ("CC-BY-4.0", "own", None) and by[12] == ("MIT", "own", None)
    for i in (6, 7, 8, 9):
        assert by[i] == (None, "none", None)
    assert by[105] == ("GPL-3.0", "inherited", "a")


def test_top_level_and_empty(spark):
    df = spark.createDataFrame([(1, "COPYING", GPL), (2, "x/y/z", "words"), (3, "w", "words")], "doc_id long, p string, text string")
    by = {r.doc_id: (r.license, r.from_dir) for r in L.license_scan(df, F.col("p")).collect()}
    assert by == {1: ("GPL-3.0", None), 2: ("GPL-3.0", ""), 3: ("GPL-3.0", "")}
    assert L.license_scan(df.limit(0), F.col("p")).collect() == []
