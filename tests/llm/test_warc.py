import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.llm import warc
from textloom.llm.queries import warc_summary
from textloom.session import scratch_path


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 50))
def test_framing_round_trip(data, chunk):
    assert warc.dechunk(warc.chunked(data, chunk)) == (data, True)


@pytest.mark.parametrize("data", [b"WARC/1.1", b"x\r\n\r\nWARC/1.1\r\ny", b"\r\n\r\nWARC/1.1\r\n" * 3, b"WARC/1.1WARC/1.1"])
@pytest.mark.parametrize("chunk", [1, 8, 1000])
def test_no_block_holds_the_version(data, chunk):
    framed = warc.chunked(data, chunk)
    assert warc.VERSION not in framed and warc.dechunk(framed) == (data, True)


@pytest.mark.parametrize("body,ok", [(b"3\r\nabc\r\n0\r\n\r\n", True), (b"3;x=1\r\nabc\r\n0\r\nA: b\r\n\r\n", True),
                                     (b"3\r\nabc\r\n", False), (b"5\r\nabc\r\n0\r\n\r\n", False), (b"zz\r\n", False)])
def test_broken_framing_is_told(body, ok):
    got = warc.dechunk(body)
    assert got[1] == ok and (not ok or got[0] == b"abc")


def test_reassembly_checks_order_and_length():
    s = lambda n, b, t=None, ok=True: {"segment": n, "block": b, "total": t, "ok": ok}
    assert warc.reassemble([s(1, b"ab"), s(2, b"c", 3)]) == (b"abc", True)
    for bad in ([s(1, b"ab"), s(3, b"c", 3)], [s(1, b"ab"), s(2, b"c", 4)], [s(1, b"ab"), s(2, b"c")],
                [s(2, b"c", 1)], [s(1, b"ab"), s(2, b"c", 3, False)]):
        assert not warc.reassemble(bad)[1]


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages():
    big = "<p>é" * 30_000
    rows = [(1, "http://a/", "x"), (5, "http://b/", "x"), (3, None, "x"), (2, "http://c/\r\nd", None), (9, "http://e/", ""),
            (7, "http://f/", big), (8, "http://g/", big), (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n\r\n" * 5000), (4, "u", "z" * 200_000),
            (None, "u", "x"), (None, "u", "only null ids"), (6, "u", "same row"), (6, "u", "same row")]
    return rows + [(100 + i, "hot", "hot page") for i in range(40)]


def expected(rows):
    top = {}
    for i, _, h in rows:
        h = (h or "").encode()
        top[h] = max(top.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        main = top[h] == (-1 if i is None else i)
        out.append((i, len(h), digest(h), "response" if main else "revisit", None if main else top[h]))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,chunk", [(32_768, 8_192), (1_000, 100)])
def test_archives_come_back(spark, segment, chunk):
    rows = pages()
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], "page_id long, url string, html string, payload string, w int")
    path = scratch_path(spark, "warc-test")
    warc.write_warc(df.repartition(3), path, segment_bytes=segment, chunk_bytes=chunk)
    back = warc.read_warc(spark, path)
    assert back.filter("NOT ok").count() == 0
    assert sorted((tuple(r) for r in warc_summary(back).collect()), key=str) == expected(rows)
    urls = {r.url for r in back.select("url").collect()}
    assert "http://c/%0D%0Ad" in urls and None in urls


def test_damage_is_seen(spark, tmp_path):
    def rec(rid, block, length=None, **f):
        head = {"WARC-Type": "response", "WARC-Record-ID": f"<{rid}>", **f, "Content-Length": len(block) if length is None else length}
        return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"

    plain = b"HTTP/1.1 200 OK\r\n\r\nbody"
    inner = b"HTTP/1.1 200 OK\r\n\r\nabc\r\n\r\nWARC/1.1\r\nnot a record"  # holds the separator
    seg = {"WARC-Segment-Number": 2, "WARC-Segment-Origin-ID": "<o>", "WARC-Segment-Total-Length": 99}
    data = (rec("p", plain) + rec("i", inner) + rec("o", b"HTTP/1.1 200 OK\r\n\r\nx", **{"WARC-Segment-Number": 1})
            + rec("o:2", b"y", **seg) + rec("t", plain, 500))
    (tmp_path / "a.warc").write_bytes(data)
    got = {r.record_id: (bytes(r.payload), r.ok) for r in warc.read_warc(spark, f"file://{tmp_path}").collect()}
    assert got["p"] == (b"body", True)
    assert got["i"] == (b"abc\r\n\r\nWARC/1.1\r\nnot a record", True)
    assert got["o"] == (b"xy", False)
    assert not got["t"][1] and len(got) == 4


def _plain(rid, block, length=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{rid}>\r\nContent-Length: "
    return f"{head}{len(block) if length is None else length}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_separators_at_every_offset_of_the_line_readers_buffer(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    want = {}
    for at in range(65_536 - 24, 65_536 + 8):  # where the first record's separator starts
        size = at - (len(_plain(f"{at}:0", http + warc.chunked(b"x" * 65_000, 100_000))) - 4) + 65_000
        for k, payload in enumerate([b"x" * size, b"second", b"third"]):
            want[f"{at}:{k}"] = payload
        data = b"".join(_plain(f"{at}:{k}", http + warc.chunked(want[f"{at}:{k}"], 100_000)) for k in range(3))
        assert data.index(warc.MARK) == at
        (tmp_path / f"{at}.warc").write_bytes(data)
    got = warc.read_warc(spark, f"file://{tmp_path}").collect()
    assert len(got) == len(want) and all(r.ok for r in got)
    assert {r.record_id: bytes(r.payload) for r in got} == want


def test_bytes_behind_a_block_are_told(spark, tmp_path):
    data = _plain("a", b"HTTP/1.1 200 OK\r\n\r\nbody", 20) + _plain("b", b"HTTP/1.1 200 OK\r\n\r\nbody")
    (tmp_path / "a.warc").write_bytes(data)
    got = {r.record_id: (bytes(r.payload), r.ok) for r in warc.read_warc(spark, f"file://{tmp_path}").collect()}
    assert not got["a"][1] and got["b"] == (b"body", True)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-empty")
    warc.write_warc(df, path)
    assert warc_summary(warc.read_warc(spark, path)).collect() == []


def test_base32(spark):
    got = spark.createDataFrame([("",), ("abc",), ("é",)], "s string").select(warc.base32_sha1(F.col("s").cast("binary"))).collect()
    assert [r[0] for r in got] == [digest(x.encode()) for x in ("", "abc", "é")]
