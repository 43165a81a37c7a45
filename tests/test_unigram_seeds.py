import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import unigram


@pytest.mark.parametrize("n", [0, 7, 60, 1000])
def test_best_seeds_equal_a_sort_with_a_limit(spark, n):
    r = random.Random(3)
    rows = {"".join(r.choice("abcdeé") for _ in range(r.randrange(2, 7))): r.choice([1, 2, 3, 3, 3, 10, 10 ** 6]) for _ in range(160)}
    seeds = spark.createDataFrame(sorted(rows.items()), "piece string, c long").repartition(5)
    got = unigram.best_seeds(seeds, n)
    want = sorted(rows.items(), key=lambda x: (-x[1] * len(x[0]), x[0]))[:n]
    assert list(zip(got["piece"].to_pylist(), got["c"].to_pylist())) == want
    assert len(unigram.best_seeds(seeds.limit(0), n)) == 0


def test_equal_scores_are_cut_by_piece_and_few_rows_reach_the_driver(spark, monkeypatch):
    taken = []
    frame = type(spark.range(0))
    for name in ("toArrow", "collect"):
        monkeypatch.setattr(frame, name, lambda self, f=getattr(frame, name): taken.append(len(got := f(self))) or got)
    seeds = spark.range(0, 20_000, 1, 20).select(F.format_string("%06d", F.col("id")).alias("piece"), F.lit(3).cast("long").alias("c"))
    assert unigram.best_seeds(seeds, 500)["piece"].to_pylist() == [f"{i:06d}" for i in range(500)]
    assert 500 <= sum(taken) < 5000


def test_training_collects_no_sort_with_a_limit(spark, monkeypatch):
    """Its tasks send as many rows each as the limit allows, all of them to the driver."""
    plans = []
    frame = type(spark.range(0))
    for name in ("toArrow", "collect"):
        monkeypatch.setattr(frame, name, lambda self, f=getattr(frame, name): plans.append(
            self._jdf.queryExecution().executedPlan().toString()) or f(self))
    texts = spark.createDataFrame([("aba abab babab cab",)] * 3, "text string")
    assert unigram.train_unigram(texts, vocab_size=12).filter("NOT special").count() == 7
    assert plans and not any("TakeOrderedAndProject" in p for p in plans)


def test_pieces_find_the_edges_of_the_lattice():
    r = random.Random(5)
    for _ in range(30):
        names = {"".join(r.choice("ab𝒳é") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 25))}
        logp = {p: -r.random() for p in names}
        pieces = unigram.Pieces(logp, 5)
        pieces = pieces.scored(pieces.scores(logp))
        words = ["".join(r.choice("ab𝒳é") for _ in range(r.randrange(1, 9))) for _ in range(6)]
        word, start, end, piece, _ = pieces.edges(words)
        got = sorted((int(w), int(s), int(e), pieces.names[p]) for w, s, e, p in zip(word, start, end, piece))
        assert got == sorted((w, s, e, p) for w in range(6) for s, e, p, _ in unigram.lattice(words[w], logp, 5))
