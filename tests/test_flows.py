import os
import tempfile

from pyspark.sql import functions as F

from textloom.plans import flows


def _corpus_dir():
    d = tempfile.mkdtemp(prefix="tl-flow-")
    train = "".join(f"story {i} the cat sat on the mat <|endoftext|>\n" for i in range(30))
    train += "story 1 the cat sat on the mat <|endoftext|>"  # exact duplicate
    with open(os.path.join(d, "TinyStoriesV2-train.txt"), "w") as f:
        f.write(train)
    with open(os.path.join(d, "TinyStories-valid.txt"), "w") as f:
        f.write("".join(f"tale {i} of a dog <|endoftext|>" for i in range(5)))
    return d


def test_packed_story_corpus(spark):
    d = _corpus_dir()
    totals, tok = flows.packed_story_corpus(spark, d, vocab_size=280, sequence_len=None)
    got = {r.split: r.n_rows for r in totals.collect()}
    assert got == {"train": 30, "validation": 5}
    packed, _ = flows.packed_story_corpus(spark, d, vocab_size=280, sequence_len=15)
    rows = packed.collect()
    assert rows and all(len(r.input_ids) == 16 for r in rows if r.split == "train")


def test_tales_and_finetune(spark):
    d = tempfile.mkdtemp(prefix="tl-tales-")
    with open(os.path.join(d, "tales.txt"), "w") as f:
        f.write("\n\n\n\n".join(f"Once\nupon a time {i}.\n\nThe end." for i in range(20)) + "\n\n\n\n")
    texts = spark.read.text(d, wholetext=True).select(F.col("value").alias("text"))
    tok = flows.train_tokenizer(texts, "bytebpe", 270)
    win = flows.tale_windows(spark, d, tok, lengths=(8, 16))
    by_len = {}
    for r in win.collect():
        by_len.setdefault(r.seq_len, []).append(len(r.input_ids))
    assert set(by_len) == {8, 16} and all(n == 8 for n in by_len[8])
    lab = spark.createDataFrame([(i, f"review {i} good" if i % 2 else f"review {i} bad",
                                  i % 2, "train" if i % 5 else "validation") for i in range(40)],
                                "doc_id long, text string, label int, split string")
    b = flows.finetune_batches(lab, tok, batch_size=4, max_length=12)
    rows = b.collect()
    assert all(len(r.input_ids) == 12 and len(r.attention_mask) == 12 for r in rows)
    assert len([r for r in rows if r.split == "train"]) == 32
    assert len([r for r in rows if r.split == "validation"]) == 8
