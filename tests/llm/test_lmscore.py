import math
import random
from collections import Counter

import pytest

from textloom.llm import lmscore as M

rng = random.Random(6)


def brute(rows):
    words = [(t or "").encode().lower().split() for _, t in rows]
    one, two = Counter(w for d in words for w in d), Counter(p for d in words for p in zip(d, d[1:]))
    n, out = sum(one.values()), []
    for (i, _), d in zip(rows, words):
        o, t = Counter(d), Counter(zip(d, d[1:]))
        rest, total, seen = max(n - len(d), 1), 0.0, 0
        for k, w in enumerate(d):
            c = one[w] - o[w]
            s = (c if c else M.UNSEEN) / rest
            if k:
                p = (d[k - 1], w)
                c = two[p] - t[p]
                seen += c > 0
                s = c / (one[d[k - 1]] - o[d[k - 1]]) if c else M.BACKOFF * s
            total += math.log(s)
        out.append((i, len(d), seen, round(total / len(d), 9) if d else None))
    return sorted(out, key=str)


def rows():
    v = ["the", "The", "of", "é", "x1", "tree,"]
    out = [(i, " ".join(rng.choice(v) for _ in range(rng.randrange(0, 50)))) for i in range(50)]
    return out + [(60, None), (61, ""), (62, " \n"), (63, "single"), (64, "alone unheard words"), (None, "the of"), (5, out[5][1]),
                  (5, out[5][1]), (70, "the of " * 2000)]


@pytest.mark.parametrize("block,part", [(10**7, 10**7), (300, 200), (40, 10)])
def test_scores_match_brute_force(spark, block, part):
    data = rows()
    df = spark.createDataFrame([(i, t, 1, "g") for i, t in data], "doc_id long, text string, block int, grams string")
    got = M.backoff_scores(df, block_chars=block, range_chars=part).collect()
    assert sorted(((r[0], r[1], r[2], r[3] if r[3] is None else round(r[3], 9)) for r in got), key=str) == brute(data)


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(1, "a b a")], "doc_id long, text string")
    assert [tuple(r[:3]) for r in M.backoff_scores(one).collect()] == [(1, 3, 0)]
    assert M.backoff_scores(one.limit(0)).collect() == []
