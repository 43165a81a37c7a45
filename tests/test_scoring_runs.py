import math

from pyspark.sql import functions as F

from textloom.operators import runs as rn
from textloom.operators import scoring as sc


def test_label_smoothing_zero_is_plain_ce(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5], 1), ([0.1, 0.2, 3.0], 0)],
                               "logits array<double>, label int")
    a = sc.cross_entropy(df, "logits", "label", 0.0).first().loss
    exp = 0.0
    for lg, y in ([1.0, 2.0, 0.5], 1), ([0.1, 0.2, 3.0], 0):
        lse = math.log(sum(math.exp(x) for x in lg))
        exp += lse - lg[y]
    assert abs(a - exp / 2) < 1e-12
    ppl = sc.perplexity(df, "logits", "label").first().perplexity
    assert abs(ppl - math.exp(exp / 2)) < 1e-9
    ign = spark.createDataFrame([([1.0, 2.0], -100)], "logits array<double>, label int")
    assert sc.cross_entropy(ign, "logits", "label").first().n_tokens == 0


def test_bleu_identity_and_rouge(spark):
    df = spark.createDataFrame([(0, "a b c d e", "a b c d e"), (1, "x y z w", "x y z w")],
                               "k long, p string, r string")
    assert abs(sc.bleu(df, "k", "p", "r").first().bleu - 1.0) < 1e-12
    rl = sc.rouge_l(df, "k", "p", "r").first()
    assert rl.fmeasure == 1.0
    assert sc.lcs_length(list("ABCBDAB"), list("BDCABA")) == 4
    zero = spark.createDataFrame([(0, "a b c d", "e f g h")], "k long, p string, r string")
    assert sc.bleu(zero, "k", "p", "r").first().bleu == 0.0
    r1 = {r.n: r for r in sc.rouge_n(spark.createDataFrame(
        [(0, "the cat", "the cat sat")], "k long, p string, r string"), "k", "p", "r").collect()}
    assert abs(r1[1].precision - 1.0) < 1e-12 and abs(r1[1].recall - 2 / 3) < 1e-12
    assert sc.union_lcs_hits([["a", "b", "c"]], [["a", "b"], ["c"]]) == 3


def test_rolling_mean_24_25(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(25)],
                               "run string, step long, value double")
    got = {r.step: r.value_smooth for r in rn.rolling_mean(df, ["run"], "value", 25,
                                                           bucket_rows=30).collect()}
    assert got[23] is None and abs(got[24] - 12.0) < 1e-12


def test_rolling_mean_across_blocks(spark):
    df = spark.createDataFrame([("r", i, float(i % 11)) for i in range(300)],
                               "run string, step long, value double")
    got = {r.step: r.value_smooth for r in rn.rolling_mean(df, ["run"], "value", 5,
                                                           bucket_rows=7).collect()}
    for s in range(4, 300):
        assert abs(got[s] - sum(float(i % 11) for i in range(s - 4, s + 1)) / 5) < 1e-9


def test_early_stop(spark):
    df = spark.createDataFrame([("r", 1, .80), ("r", 2, .85), ("r", 3, .84), ("r", 4, .83)],
                               "run string, epoch int, metric double")
    r = rn.early_stop(df, ["run"], patience=1).first()
    assert (r.best_epoch, r.stop_epoch) == (2, 4)
    never = spark.createDataFrame([("r", 1, .8), ("r", 2, .9)], "run string, epoch int, metric double")
    r2 = rn.early_stop(never, ["run"], 1).first()
    assert (r2.best_epoch, r2.stop_epoch) == (2, None)


def test_grid_parse_warmup_lr(spark):
    g = rn.sweep_grid(spark, {"lr": [1e-4, 8e-5], "opt": ["adamw"]}, seeds=[42, 314, 1618])
    assert g.count() == 6 and g.select("group").distinct().count() == 2
    p = rn.parse_runs(spark.createDataFrame([("python train.py --epochs 2 --lr 8e-5 --group x",)],
                                            "line string"), "line",
                      {"epochs": "int", "lr": "double"}).first()
    assert p.epochs == 2 and abs(p.lr - 8e-5) < 1e-18 and p.options["group"] == "x"
    assert rn.parse_warmup("1", epochs=2, total_steps=100) == 50
    assert rn.parse_warmup("0.06", total_steps=100) == 6
    assert rn.parse_warmup("500ba") == "500ba"
    lr = spark.range(0, 11).select(rn.lr_at(F.col("id"), 10, 1.0, 2).alias("lr")).collect()
    vals = [r.lr for r in lr]
    assert vals[0] == 0 and vals[1] == 0.5 and abs(vals[2] - 1.0) < 1e-12 and abs(vals[10]) < 1e-12


def test_zero_denominators_give_null_not_errors(spark):
    one = spark.createDataFrame([("r", 0)], "run string, step long")
    assert rn.train_pct(one, ["run"]).first().train_pct is None
    short = spark.createDataFrame([(0, "a b", "a b")], "k long, p string, r string")
    assert sc.bleu(short, "k", "p", "r").first().bleu == 0.0
