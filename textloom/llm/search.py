"""Ranked lexical search with hashed max-sketches and exact rescoring.

1. ``sketches``: one pass over the texts.  A document's terms are hashed to
   ``COORDINATES`` coordinates and its impacts are folded into the maximum of each.
   An impact grows with the term's frequency in the document, so the sketch keeps the
   largest frequency per coordinate (one byte, 255 standing for any larger one); it
   depends on no query and on no count of the corpus.
2. Exact document frequencies of the query terms, N and L over all documents.
3. Queries are looked up in blocks.  For a batch of sketches, the sum of weight times
   maximal impact over a query's coordinates is an upper bound of its score: a
   coordinate holds at least the term's own frequency.
4. Descending bounds: the ``k`` documents of highest bound are scored on their whole
   texts, which gives every query a threshold, its k-th best exact score so far.  Where
   terms share coordinates these may be the wrong ones, so the ``WIDER * k`` highest
   bounds that reach the threshold raise it once more.  Then all documents whose bound
   reaches the threshold are scored the same way.  A document
   that is left out has a bound below ``k`` exact scores, so the result is exact.
   Copies of one text score the same; only the ``k`` smallest ids of each are scored.

Texts are never shuffled as long as the documents to score are within the broadcast
bound; each task and each merge keeps only ``k`` rows a query.

Score (integers): sum over a query's distinct terms of
``w * ((10**9 * tf) // (1000 * tf + 20 * m))``, ``m = 50 + (50 * n * N) // L``,
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``.

Defined results.  Null and wordless texts: no term, never found, not counted in N; as
queries they find nothing.  Very long texts: whole, frequencies of any size are exact
when scored.  Ties: the smaller id, null ids last.  Repeated rows: each document row
and each query row counts for itself.  Empty tables: no row.  Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed, free_names, maybe_broadcast, row_slices
from textloom.session import scratch_path
from textloom.sources.artifacts import delete_path

K = 50
WIDER = 8
COORDINATES = 1 << 20
#: queries and query terms that are looked up at once
BLOCK_QUERIES = 1024
BLOCK_TERMS = 200_000
#: sketches whose bounds are held at once
_ROWS = 64
_MORE = 255  # a frequency of 255 or any larger one

# fixed values: a term's characters are 0-9, A-Z (lower-cased), a-z and all from U+0080
_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c in _TERM or c >= 0x80 else 0x20 for c in range(256)).lower()


def terms_of(data: bytes | None) -> list[bytes]:
    return data.translate(_TABLE).split() if data else []


def coordinate(term: bytes, coordinates: int = COORDINATES) -> int:
    return xxhash.xxh3_64_intdigest(term) % coordinates


def impact(tf, m):
    """Of integers or integer arrays."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norm(n, docs: int, total: int):
    return 50 + (50 * n * docs) // max(total, 1)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def sketch(data: bytes | None, coordinates: int = COORDINATES) -> tuple[int, np.ndarray]:
    """``(terms, sorted coordinate << 8 | largest frequency)``."""
    words = terms_of(data)
    tf = Counter(words)
    at = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tf), np.uint64, len(tf)) % np.uint64(coordinates)
    top = np.minimum(np.fromiter(tf.values(), np.int64, len(tf)), _MORE).astype(np.uint32)
    packed = np.sort(at.astype(np.uint32) << np.uint32(8) | top)
    last = np.ones(len(packed), bool)  # the largest of every coordinate comes last
    last[:-1] = packed[1:] >> 8 != packed[:-1] >> 8
    return len(words), packed[last]


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             coordinates: int = COORDINATES) -> DataFrame:
    """``id``, ``text_key``, ``n`` (terms) and ``sketch`` of every row with a term."""
    if coordinates > 1 << 24:
        raise ValueError("at most 2**24 coordinates")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                    F.col(text_col).cast("binary").alias("_text"))
    kind = dict(d.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                found = [sketch(x.as_py(), coordinates) for x in b.column("_text")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("text_key"), pa.array([n for n, _ in found], pa.int64()),
                     pa.array([s.tobytes() for _, s in found], pa.binary())], ["id", "text_key", "n", "sketch"])

    return d.mapInArrow(run, f"id {kind}, text_key long, n long, sketch binary").filter("n > 0")


# ---------------------------------------------------------------- queries
@dataclass
class Block:
    """A bounded block of queries; plain data that every task reads."""
    items: list = field(default_factory=list)  # row numbers
    terms: list = field(default_factory=list)  # per item: sorted distinct terms
    weights: dict = field(default_factory=dict)
    docs: int = 0
    total: int = 0

    def postings(self, coordinates: int):
        """Per coordinate the queries that ask for it and the summed weight."""
        asked: dict[int, Counter] = {}
        for q, terms in enumerate(self.terms):
            for t in terms:
                asked.setdefault(coordinate(t, coordinates), Counter())[q] += self.weights[t]
        where = np.full(coordinates, -1, np.int32)
        starts, query, w = [0], [], []
        for i, (c, qs) in enumerate(sorted(asked.items())):
            where[c] = i
            query.extend(qs.keys())
            w.extend(qs.values())
            starts.append(len(query))
        return where, np.array(starts, np.int64), np.array(query, np.int64), np.array(w, np.float64)


def _blocks(queries: DataFrame, max_queries: int, max_terms: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Query rows read one after the other, a block at a time."""
    held, n = [], 0
    for r in queries.orderBy("_row").toLocalIterator():
        terms = sorted(set(terms_of(r["_text"])))
        if held and (len(held) >= max_queries or n + len(terms) > max_terms):
            yield held
            held, n = [], 0
        if terms:
            held.append((r["_row"], terms))
            n += len(terms)
    if held:
        yield held


def document_frequencies(docs: DataFrame, terms: list[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How many documents hold each of ``terms`` (a bounded list)."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, number = np.zeros(len(wanted.value), np.int64), wanted.value
        for b in batches:
            for x in b.column(0):
                hit = [number[t] for t in number.keys() & set(terms_of(x.as_py()))]
                n[hit] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], ["term", "df"])

    rows = docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "term int, df long")
    return {terms[r["term"]]: r["df"] for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


# ---------------------------------------------------------------- bounds
def _bounded(block, coordinates: int):
    """Sketch batch -> matrix (row, query) of upper bounds, exact integers in doubles."""
    where, starts, query, w = block.postings(coordinates)
    q = len(block.items)

    def bounds(n: np.ndarray, sketch_column) -> np.ndarray:
        parts = [np.frombuffer(s.as_buffer(), np.uint32) for s in sketch_column]
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        packed = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        at = where[packed >> np.uint32(8)]
        hit = at >= 0
        row, at, tf = row[hit], at[hit], (packed[hit] & np.uint32(255)).astype(np.int64)
        m = length_norm(n, block.docs, block.total)[row]
        top = np.where(tf == _MORE, 1_000_000, impact(tf, m)).astype(np.float64)
        each = starts[at + 1] - starts[at]
        k = np.repeat(starts[at] - np.cumsum(each) + each, each) + np.arange(each.sum())
        return np.bincount(np.repeat(row, each) * q + query[k], np.repeat(top, each) * w[k],
                           len(parts) * q).reshape(len(parts), q)
    return bounds


def _highest(index: DataFrame, shared, least: list[int], coordinates: int, k: int) -> DataFrame:
    """``(q, id, text_key, bound)``: per task and query the ``k`` highest bounds of
    at least ``least``."""
    kind = dict(index.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        bounds, best, above = _bounded(block, coordinates), {}, np.array(least, np.float64) - 1
        for batch in batches:
            for b in row_slices(batch, _ROWS):
                x = bounds(b.column("n").to_numpy(), b.column("sketch"))
                floor = np.array([best[q][0][-1] if q in best and len(best[q][0]) == k else f for q, f in enumerate(above)])
                for q in np.flatnonzero((x > floor).any(0)):
                    at = np.flatnonzero(x[:, q] > floor[q])
                    some = b.take(pa.array(at)).select(["id", "text_key"])
                    value, kept = x[at, q], pa.Table.from_batches([some])
                    if q in best:
                        value = np.concatenate([best[q][0], value])
                        kept = pa.concat_tables([best[q][1], kept])
                    top = np.argsort(-value, kind="stable")[:k]
                    best[q] = value[top], kept.take(pa.array(top)).combine_chunks()
        for q, (value, kept) in best.items():
            kept = kept.append_column("bound", pa.array(value.astype(np.int64)))
            yield from kept.add_column(0, "q", pa.array(np.full(len(value), q, np.int32))).to_batches()

    return index.select("id", "text_key", "n", "sketch").mapInArrow(
        run, f"q int, id {kind}, text_key long, bound long")


def _reaching(index: DataFrame, shared, thresholds: list[int], coordinates: int) -> DataFrame:
    """``(id, text_key, qs)``: the queries whose threshold a row's bound reaches."""
    kind = dict(index.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, least = _bounded(shared.value, coordinates), np.array(thresholds, np.float64)
        for batch in batches:
            for b in row_slices(batch, _ROWS):
                x = bounds(b.column("n").to_numpy(), b.column("sketch")) >= least
                at = np.flatnonzero(x.any(1))
                some = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("text_key"),
                     pa.array([np.flatnonzero(x[i]).astype(np.int32) for i in at], pa.list_(pa.int32()))],
                    ["id", "text_key", "qs"])

    return index.select("id", "text_key", "n", "sketch").mapInArrow(run, f"id {kind}, text_key long, qs array<int>")


# ---------------------------------------------------------------- exact scores
def score(data: bytes | None, queries: list[int], block: Block) -> list[int]:
    words = terms_of(data)
    tf, m = Counter(words), length_norm(len(words), block.docs, block.total)
    return [sum(block.weights[t] * impact(tf[t], m) for t in block.terms[q] if t in tf) for q in queries]


def _rescored(docs: DataFrame, wanted: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """``(q, id, score)`` of the rows of ``docs`` named by ``wanted(id, text_key, qs)``."""
    i, key, qs = free_names(docs, "_id", "_key", "_qs")
    wanted = wanted.select(F.col("id").alias(i), F.col("text_key").alias(key), F.col("qs").alias(qs))
    on = docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(key))
    d = docs.join(maybe_broadcast(wanted), on).select(
        docs[id_col].alias("id"), docs[text_col].cast("binary").alias("_text"), F.col(qs).alias("qs"))
    kind = dict(d.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                q, row, found = [], [], []
                for r, (text, asked) in enumerate(zip(b.column("_text"), b.column("qs"))):
                    asked = asked.as_py()
                    q.extend(asked)
                    row.extend([r] * len(asked))
                    found.extend(score(text.as_py(), asked, shared.value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int32()), b.column("id").take(pa.array(row, pa.int32())), pa.array(found, pa.int64())],
                    ["q", "id", "score"])

    return d.mapInArrow(run, f"q int, id {kind}, score long").filter("score > 0")


def _by_row(asked: DataFrame) -> DataFrame:
    return asked.groupBy("id", "text_key").agg(F.collect_set("q").alias("qs"))


def _first_copies(asked: DataFrame, k: int) -> DataFrame:
    """Of equal texts, which score the same, only the ``k`` first can be in a result;
    however many copies there are, a task passes on ``k`` of a text for each query."""
    order = Window.partitionBy("q", "text_key").orderBy(F.asc_nulls_last("id"))
    return asked.distinct().withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def _top(scored: DataFrame, k: int) -> DataFrame:
    """Only ``k`` rows a query leave a task, as Spark limits ranks before the shuffle."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           query_col: str = "item_id", query_text_col: str = "text", coordinates: int = COORDINATES,
           block_queries: int = BLOCK_QUERIES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``query_col``, ``rank`` (from 1), ``id_col`` and ``score``: the ``k`` best rows of
    ``docs`` with a score above 0 for every row of ``queries``."""
    spark = docs.sparkSession
    q = checkpointed(queries.select(F.monotonically_increasing_id().alias("_row"), F.col(query_col).alias("_query"),
                                    F.col(query_text_col).cast("binary").alias("_text")))
    path = scratch_path(spark, "sketches")
    sketches(docs, id_col, text_col, coordinates).write.parquet(path)
    index = spark.read.parquet(path)
    n, total = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = None
    for rows in _blocks(q.select("_row", "_text"), block_queries, block_terms) if n else ():
        top = _search_block(docs, index, rows, n, total, k, id_col, text_col, coordinates)
        found = top if found is None else found.unionByName(top)
    delete_path(spark, path)  # what was found is checkpointed
    if found is None:
        kind = dict(docs.dtypes)[id_col]
        found = spark.createDataFrame([], f"_row long, rank int, id {kind}, score long")
    out = found.join(maybe_broadcast(q.select("_row", "_query")), "_row")
    return out.select(F.col("_query").alias(query_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(docs, index, rows, n, total, k, id_col, text_col, coordinates) -> DataFrame:
    spark = docs.sparkSession
    block = Block([r for r, _ in rows], [t for _, t in rows], {}, n, total)
    terms = sorted({t for ts in block.terms for t in ts})
    df = document_frequencies(docs, terms, text_col)
    block.weights = {t: weight(df.get(t, 0), n) for t in terms}
    shared = spark.sparkContext.broadcast(block)

    order = Window.partitionBy("q").orderBy(F.desc("bound"), F.asc_nulls_last("id"))
    least = [1] * len(rows)
    for width in (k, WIDER * k):
        high = _highest(index, shared, least, coordinates, width).withColumn("r", F.row_number().over(order))
        scored = _top(_rescored(docs, checkpointed(_by_row(high.filter(F.col("r") <= width))), shared, id_col, text_col), k)
        for r in scored.filter(F.col("rank") == k).select("q", "score").collect():
            least[r["q"]] = max(least[r["q"]], r["score"])
    # a query with fewer than k documents so far takes every document with a bound above 0
    reach = _reaching(index, shared, least, coordinates)
    wanted = checkpointed(_by_row(_first_copies(reach.select("id", "text_key", F.explode("qs").alias("q")), k)))
    low = F.broadcast(spark.createDataFrame([(i, r, t) for i, ((r, _), t) in enumerate(zip(rows, least))],
                                            "q int, _row long, _least long"))
    scored = _rescored(docs, wanted, shared, id_col, text_col).join(low, "q").filter("score >= _least")
    return checkpointed(_top(scored, k).select("_row", "rank", "id", "score"))
