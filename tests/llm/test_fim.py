"""Fill in the middle against plain strings."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.llm import fim
from textloom.llm.queries import QUERIES

rng = random.Random(11)
TEXTS = [None, "", "a", "abc", " ", "one two", "Ä b\nç d\t1", "x" * 5000, "a<P>b", "<S", "no <M> here", "<<S> <P",
         "S>P>M>", "<", "日本語 text ünïcode é", "z" * 300 + "é" * 300 + " <" * 40]
TEXTS += ["".join(rng.choice("ab <>PSM\né日") for _ in range(rng.randrange(400))) for _ in range(60)]


def brute(row_id, text):
    """(n, form, prefix chars, middle chars, output)"""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if row_id is None else row_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [4, 5, 16, 1 << 16])
def test_places_and_streams_at_every_unit(size):
    for text in TEXTS:
        data = (text or "").encode()
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
        f = fim.Frames.of(data, size)
        assert len(f) == len(units) and f.chars[-1] == len(text or "")
        assert all(len(f.part(i)) <= size for i in range(len(f.frames)))
        for u in range(0, len(units) + 1, max(1, len(units) // 20)):
            at = f.place(u)
            assert at[2] == len("".join(units[:u]))
            assert b"".join(f.stream((0, 0, 0), at)).decode() == "".join(units[:u])
            assert b"".join(f.stream(at, f.place(len(f)))).decode() == "".join(units[u:])


def test_one_frame_is_opened_for_a_cut(monkeypatch):
    f, opened = fim.Frames.of(b"ab cd " * 5000, 64), []
    part = fim.Frames.part
    monkeypatch.setattr(fim.Frames, "part", lambda self, i: opened.append(i) or part(self, i))
    f.place(9_999)
    assert len(opened) == 1


def test_marks_are_found_over_every_chunk_border():
    out = b"<P>" + b"a<" * 9 + b"<S>" + b"S><P" * 3 + b"<M>" + b"<<M" * 5
    for size in range(1, 40):
        chunks = [out[i:i + size] for i in range(0, len(out), size)]
        assert b"".join(fim.restored(chunks, "psm")) == b"a<" * 9 + b"<<M" * 5 + b"S><P" * 3


@pytest.mark.parametrize("size", [7, 1 << 16])
def test_operator_matches_strings(spark, size):
    rows = [(i, t, "other", 5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None), (None, "a b c", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")  # names of results
    found = fim.restore(fim.infill(fim.frame_store(docs, frame_bytes=size), frame_bytes=size))
    got = found.withColumn("o", fim.frames_text("output")).withColumn("r", fim.frames_text("restored")).collect()
    assert len(got) == len(rows)
    want = {(r[0], *brute(*r[:2]), r[1] or "") for r in rows}
    assert {(g.id, g.n, g.form, g.prefix_chars, g.middle_chars, g.o, g.r) for g in got} == want
    for g in got:
        assert g.output_sha256 == hashlib.sha256(g.o.encode()).hexdigest()
        assert g.restored_sha256 == hashlib.sha256(g.r.encode()).hexdigest()
    assert {g.form for g in got} == {"plain", "psm", "spm"}


def test_bytes_that_are_no_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, bytearray(b"\x80" * 50))], "doc_id long, text binary")
    found = fim.restore(fim.infill(fim.frame_store(docs, frame_bytes=8))).first()
    assert b"".join(fim.opened(bytes(f) for f in found.restored)) == b"\x80" * 50
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.infill(fim.frame_store(none))).count() == 0


def test_written_store_and_query(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    path = str(tmp_path / "store")
    fim.write_store(docs, path, frame_bytes=64)
    texts = fim.fill_in_middle(spark, path).select("id", "output", "restored").collect()
    assert {(r.id, r.output, r.restored) for r in texts} == {(i, brute(i, t)[4], t or "") for i, t in enumerate(TEXTS)}

    base = tmp_path / "sf"
    docs.write.parquet(str(base / "documents.parquet"))
    got = QUERIES["op11_fill_in_middle"](spark, str(base)).orderBy("doc_id").collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for r, (i, t) in zip(got, enumerate(TEXTS)):
        n, form, p, m, out = brute(i, t)
        assert tuple(r) == (i, n, form, p, m, sha(out), sha(t))
    again = QUERIES["op11_fill_in_middle"](spark, str(base)).agg(F.sum("n")).first()[0]
    assert again == sum(r.n for r in got)
