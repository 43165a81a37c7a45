"""Each stage against plain code on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from textloom.llm import quality
from textloom.llm.queries import language_model
from textloom.llm.langid import identify, keep_identified, least_score

from test_decontam import brute as brute_hits
from test_simhash import expected as brute_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, state = docs.columns, docs
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    assert [n for n, _ in P.STAGES] == ["quality_rules", "language_id", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]

    def go(k):
        out = P.STAGES[k][1](spark, state, SF)
        if k < 4:
            assert out.columns == columns
        return out.checkpoint()

    before = rows(state)
    after = go(0)
    verdicts = quality.quality(state, quality.model(state, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert set(rows(after)) == {r.doc_id for r in verdicts if r.kept}
    assert all(before[i] == t for i, t in rows(after).items())

    state = after
    after = go(1)
    model = language_model(state)
    least = least_score(len(model.langs))
    found = identify(state, model).collect()
    assert set(rows(after)) == {r.doc_id for r in found if r.score >= least and r.lang_pred != "und"}
    assert len(rows(after)) > 0.99 * len(found)
    unsure = [r for r in found if r.score < least]
    other = {1: "123 456 " * 30, 2: None, 3: "", 4: "日本 " * 3}
    df = spark.createDataFrame(list(other.items()), "doc_id long, text string")
    assert {r.doc_id for r in keep_identified(df, model).collect()} <= {4}
    assert 1 / len(model.langs) < least < 1 and all(r.doc_id not in rows(after) for r in unsure)

    state = after
    after = go(2)
    data = list(rows(state).items())
    _, _, least = brute_groups(data)
    assert set(rows(after)) == set(least.values())

    state = after
    after = go(3)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(rows(after)) == {r[0] for r in brute_hits(list(rows(state).items()), items, 10) if not r[2]}

    state = after
    pieces = go(4).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in rows(state).values())
    assert sum(r.length for r in pieces) == want
    assert {r.doc_id for r in pieces} == set(rows(state))


def test_run_gives_the_last_stage(spark):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
