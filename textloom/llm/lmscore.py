"""Stupid-backoff scores of every document under the rest of the corpus.

Relational plan (``documents -> n-grams -> counts -> back``), with n-grams moved
in packed columns instead of a row each:

1. Documents are dealt by hash into blocks of about ``BLOCK_CHARS``.
2. A block's distinct words and bigrams (64-bit hashes, sorted, with the block's
   counts) are cut into hash ranges: one row per block and range.  A frequent
   n-gram costs one entry per block, however often it occurs.
3. Rows meet by hash range: that is the count table's partition.  Counts are summed
   over blocks and looked up for the same entries; totals go back by block.
4. Each block joins its totals with its documents' n-grams, and the logs are
   summed per document.

A document's own counts are taken out first, so a text is scored by what the rest
of the corpus says: S(w2 | w1) = c(w1 w2) / c(w1) if the pair occurs elsewhere, else
``BACKOFF`` * c(w2) / N; words that occur nowhere else count ``UNSEEN``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BACKOFF = 0.4
UNSEEN = 0.5
BLOCK_CHARS = 10_000_000
#: text behind one hash range of the count table
RANGE_CHARS = 8_000_000


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def planes(a: np.ndarray) -> bytes:
    """All first bytes, then all second bytes, ...: what Spark's compression
    then makes of sorted gaps and small counts is about their information."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Block:
    """N-grams of a block of texts: ``grams[k]`` are the sorted distinct hashes
    of order ``k + 1``, ``places[k]`` the entry of every occurrence, ``docs[k]``
    its document, ``counts[k]`` the occurrences of every entry."""

    def __init__(self, texts: Iterator[str | None]):
        number: dict[bytes, int] = {}
        parts, lengths = [np.empty(0, np.int32)], []
        for t in texts:
            w = words_of(t)
            parts.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int32, len(w)))
            lengths.append(len(w))
        self.lengths = np.array(lengths, np.int64)
        doc = np.repeat(np.arange(len(lengths), dtype=np.int32), self.lengths)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        del number
        word = hashes[np.concatenate(parts)] if len(hashes) else np.empty(0, np.uint64)
        del parts
        same = doc[1:] == doc[:-1]
        with np.errstate(over="ignore"):
            pair = word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:]
            pair = (pair ^ pair >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
            pair = (pair ^ pair >> np.uint64(29))[same]
        self.starts = np.concatenate([[True], ~same])[:len(word)]
        self.docs = [doc, doc[1:][same]]
        self.grams, self.places, self.counts = [], [], []
        for h in (word, pair):
            g, p, c = np.unique(h, return_inverse=True, return_counts=True)
            self.grams.append(g)
            self.places.append(p.astype(np.int32))
            self.counts.append(c.astype(np.uint32))
            del p, h

    def own_counts(self, k: int) -> np.ndarray:
        """For every occurrence, how often its n-gram occurs in its document."""
        key = self.places[k].astype(np.int64) * (len(self.lengths) + 1) + self.docs[k]
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        return count[place]


def _ranges(grams: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """``(range, from, to)`` of the hash ranges that hold entries."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    cuts = [0, *np.searchsorted(grams, edges).tolist(), len(grams)]
    for i in range(ranges):
        if cuts[i] < cuts[i + 1]:
            yield i, cuts[i], cuts[i + 1]


def score_block(block: Block, totals: list[np.ndarray], n_tokens: int, backoff: float = BACKOFF,
                unseen: float = UNSEEN) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log S and number of pairs found elsewhere, per document."""
    n_docs = len(block.lengths)
    if not len(block.docs[0]):
        return np.zeros(n_docs), np.zeros(n_docs, np.int64)
    one = totals[0][block.places[0]] - block.own_counts(0)  # c(w) in the other documents
    rest = np.maximum(n_tokens - block.lengths, 1)[block.docs[0]]
    log_s = np.log(np.where(one > 0, one, unseen) / rest)
    later = np.flatnonzero(~block.starts)  # tokens with a word before them, in the order of the pairs
    two = totals[1][block.places[1]] - block.own_counts(1)
    seen = two > 0
    log_s[later] = np.where(seen, np.log(np.where(seen, two, 1) / np.where(seen, one[later - 1], 1)),
                            np.log(backoff) + log_s[later])
    return (np.bincount(block.docs[0], log_s, n_docs),
            np.bincount(block.docs[1][seen], minlength=n_docs))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Characters and words of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = words = 0
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                chars += len(text)
                words += len(words_of(text))
        yield pa.RecordBatch.from_arrays([pa.array([chars]), pa.array([words])], ["chars", "words"])

    r = docs.select(text_col).mapInArrow(run, "chars long, words long").agg(F.sum("chars"), F.sum("words")).first()
    return r[0] or 0, r[1] or 0


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = BACKOFF,
                   unseen: float = UNSEEN, block_chars: int = BLOCK_CHARS,
                   range_chars: int = RANGE_CHARS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens``, ``n_pairs_seen`` (word
    pairs that occur in other documents) and ``log_score`` (mean log S per word).

    Null, empty and wordless texts have 0 tokens and a null score; repeated rows
    are documents of their own and see each other; null ids stay null."""
    chars, n_tokens = corpus_size(docs, text_col)
    blocks, ranges = max(1, -(-chars // block_chars)), max(1, -(-chars // range_chars))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    d = d.withColumn("block", F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(blocks)))
    packed = "block long, part int, k int, grams binary, counts binary"

    def count(t: pa.Table) -> pa.Table:
        block, rows = Block(_texts(t)), []
        at = t.column("block")[0].as_py()
        for k in (0, 1):
            for i, a, b in _ranges(block.grams[k], ranges):
                gaps = np.diff(block.grams[k][a:b], prepend=np.uint64(0))
                rows.append({"block": at, "part": i, "k": k, "grams": planes(gaps),
                             "counts": planes(block.counts[k][a:b])})
        return _table(rows, "grams", "counts")

    def total(t: pa.Table) -> pa.Table:
        rows = t.select(["block", "part", "k"]).to_pylist()
        grams = [np.cumsum(from_planes(x.as_py(), "u8"), dtype=np.uint64) for x in t.column("grams")]
        counts = [from_planes(x.as_py(), "u4") for x in t.column("counts")]
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        sums = np.bincount(place, np.concatenate(counts)).astype(np.int64)[place]  # exact below 2**53
        ends = np.cumsum([len(g) for g in grams])
        for r, a, b in zip(rows, [0, *ends[:-1].tolist()], ends.tolist()):
            r["totals"] = planes(sums[a:b])
        return _table(rows, "totals")

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        block = Block(_texts(texts))
        found: list[list] = [[], []]
        for r in sorted(totals.to_pylist(), key=lambda r: r["part"]):
            found[r["k"]].append(from_planes(r["totals"], "i8"))
        arrays = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
        logs, seen = score_block(block, arrays, n_tokens, backoff, unseen)
        n = block.lengths
        mean = [float(s) / int(m) if m else None for s, m in zip(logs, n)]
        return pa.table({id_col: texts.column("id"), "n_tokens": pa.array(n), "n_pairs_seen": pa.array(seen.astype(np.int64)),
                         "log_score": pa.array(mean, pa.float64())})

    grams = d.groupBy("block").applyInArrow(count, packed)
    sums = grams.groupBy("part", "k").applyInArrow(total, "block long, part int, k int, totals binary")
    kind = dict(d.dtypes)["id"]
    return d.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        score, f"`{id_col}` {kind}, n_tokens long, n_pairs_seen long, log_score double")


def _texts(t: pa.Table) -> Iterator[str | None]:
    return (x.as_py() for x in t.column("text"))


def _table(rows: list[dict], *binary: str) -> pa.Table:
    kinds = {"block": pa.int64(), "part": pa.int32(), "k": pa.int32(), **{c: pa.binary() for c in binary}}
    return pa.table({c: pa.array([r[c] for r in rows], t) for c, t in kinds.items()})
