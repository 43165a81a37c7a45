"""Quality rules: countable rules plus a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams (words and runs of punctuation, single and
in pairs) are counted: one over every document, one over the trusted documents.
A document's score is the mean of ``log(p_trusted / p_raw)`` over all of its
n-grams, so long and short documents compare; every document is held against the
same fixed threshold.

The bucket number is fixed, so the tables that reach the driver and the tasks
have a fixed size whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import row_slices

BUCKETS = 1 << 16
#: labelled documents that make the trusted target, picked by hash of their id
TRUSTED_ROWS = 20_000
#: mean log ratio (nats) below which a document is rejected
THRESHOLD = -0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# fixed values: white space and symbols of the rules
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\r\x0b\x0c]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes]) -> int:
    """Words inside any 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    size = len(seen)
    pair = ids[:-1] * size + ids[1:]
    if size >= 1 << 21:  # three such numbers do not fit in 64 bits: number the pairs
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * size + ids[2:]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    often = count[place] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= often
    return int(inside.sum())


def rules(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null: none."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(data.count(bytes([c])) for c in SPACES),
            sum(data.count(bytes([c])) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def ngram_buckets(text: str | None, buckets: int = BUCKETS, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, in blocks that end at white space:
    where they end changes nothing."""
    if not text:
        return
    before, at = np.empty(0, np.uint64), 0
    while at < len(text):
        space = _SPACE.search(text, at + block)
        end = space.start() if space else len(text)
        found = _TOKEN.findall(text[at:end].encode("utf-8", "surrogatepass"))
        at = end
        h = np.fromiter(map(zlib.crc32, found), np.uint64, len(found))
        yield (h * _MIX >> np.uint64(32)) % np.uint64(buckets)
        chain = np.concatenate([before, h])
        if len(chain) > 1:
            yield ((chain[:-1] * np.uint64(31) + chain[1:] + np.uint64(1)) * _MIX >> np.uint64(32)) % np.uint64(buckets)
        before = chain[-1:]


def ngram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all of ``docs`` and over those whose id is in
    ``trusted`` (a bounded table of one id column)."""
    ids = F.broadcast(trusted.toDF("_id").filter("_id IS NOT NULL").distinct())
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    d = d.join(ids.withColumn("_in", F.lit(True)), "_id", "left").select("_text", F.col("_in").isNotNull().alias("_in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            for t, inside in zip(b.column(0), b.column(1)):
                for g in ngram_buckets(t.as_py(), buckets):
                    n = np.bincount(g.view(np.int64), minlength=buckets) if len(g) > buckets // 8 else None
                    if n is None:
                        np.add.at(raw, g, 1)
                        if inside.as_py():
                            np.add.at(target, g, 1)
                    else:
                        raw += n
                        if inside.as_py():
                            target += n
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                         ["bucket", "raw", "target"])

    rows = (d.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # at most `buckets` rows
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in rows:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Add-one smoothed ``log(p_target / p_raw)`` per bucket; zero without a target."""
    if not target.sum():
        return np.zeros(len(raw))
    p = lambda c: np.log((c + 1) / (c.sum() + len(c)))
    return p(target) - p(raw)


def score(text: str | None, ratios: np.ndarray) -> float:
    """Mean log ratio of a text's n-grams; 0 without any."""
    total, n = 0.0, 0
    for g in ngram_buckets(text, len(ratios)):
        total += float(ratios[g].sum())
        n += len(g)
    return total / n if n else 0.0


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS, id_col: str = "doc_id") -> DataFrame:
    """Ids of at most ``rows`` documents labelled good and not toxic."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    good = good.filter(F.col(id_col).isNotNull()).select(id_col).distinct()
    return good.orderBy(F.xxhash64(id_col), id_col).limit(rows)


def model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          trusted_rows: int = TRUSTED_ROWS, buckets: int = BUCKETS) -> np.ndarray:
    return log_ratios(*ngram_counts(docs, trusted_ids(labels, trusted_rows), id_col, text_col, buckets))


def quality(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: the id, the rules' counts, ``base_failed``,
    ``kept`` and ``score``.

    Null and empty texts have no words and fail the rules; repeated rows each
    give a row; null ids stay null; only the named columns are read."""
    d = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            counts = [rules(t.as_py()) for t in texts]
            scores = [score(t.as_py(), ratios) for t in texts]
            failed = [base_failed(c[0], c[4]) for c in counts]
            cols = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            kept = [not f and s >= threshold for f, s in zip(failed, scores)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *cols, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()),
                 pa.array(scores, pa.float64())], [id_col, *names, "base_failed", "kept", "score"])

    kind = dict(docs.dtypes)[id_col]
    return d.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names)
                        + ", base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, ratios: np.ndarray, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; nothing moves."""
    def passes(text: str | None) -> bool:
        c = rules(text)
        return not base_failed(c[0], c[4]) and score(text, ratios) >= threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                yield b.filter(pa.array([passes(t.as_py()) for t in b.column(text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
