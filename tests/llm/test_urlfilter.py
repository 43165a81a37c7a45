import random

import numpy as np
import pytest

from textloom.llm import urlfilter as U

rng = random.Random(8)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def verdict(url, listed):
    host, path = parts(url)
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, v = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, v
    return host, path, None, "block" if host + path in listed else "allow"


URLS = [None, "", "no scheme", "http://", "https://A.example.ORG/es/1?x#y", "http://example.org", "http://example.org/en/12",
        "http://example.org/en/2", "http://notexample.org/es/", "ftp://x.com/fr/a", "x://com/de/", "http://b.com/de", "http://É.com/de/1",
        "http://q?http://a.org/", "http://u\n.net/a\nb#c", "://z.net/p", "a://b://c/d"] + [
    f"http://h{rng.randrange(40)}.net/p{rng.randrange(40)}" for _ in range(400)]


@pytest.mark.parametrize("shard,broadcast", [(500_000, 1 << 26), (30, 1 << 26), (30, 0)])
def test_verdicts_are_exact(spark, shard, broadcast):
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, _listed int")
    listed = [h + p for u in URLS[::3] for h, p in [parts(u)]] + ["never/seen", None]
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    got = U.filter_urls(pages, keys, RULES, shard_keys=shard, rate=0.3, max_broadcast=broadcast)
    assert [c for c in got.columns if c in ("host", "path", "rule", "verdict")] == ["host", "path", "rule", "verdict"]
    want = {i: verdict(u, set(listed)) for i, u in enumerate(URLS)}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == want


@pytest.mark.parametrize("n,m,rate", [(0, 50, 0.1), (50, 0, 0.1), (1, 1, 0.5), (3000, 5000, 0.3), (20, 20_000, 0.01)])
def test_cascade_has_no_wrong_answer(n, m, rate):
    r = np.random.default_rng(n + m)
    a, b = (r.integers(0, 2**63, n + m, np.uint64) for _ in range(2))
    listed = np.arange(n + m) < n
    levels = U.build_cascade(a, b, listed, rate)
    again = [U.Bloom.from_bytes(f.level, f.to_bytes()) for f in levels]
    assert np.array_equal(U.in_cascade(again, a, b), listed)
    if n > 1000:
        assert len(levels) > 2  # more than one level was needed


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert [r.verdict for r in U.filter_urls(pages, none, RULES).collect()] == ["allow"]
    assert U.filter_urls(pages.limit(0), none, RULES).collect() == []
