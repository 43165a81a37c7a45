"""SimHash near-duplicates by covering locality-sensitive hashing.

1. One 64-bit fingerprint per text, from the hashes of its word shingles.
2. Equal fingerprints collapse to one row, so exact copies cost nothing more.
3. Covering tables: bit ``i`` of a fingerprint gets the non-zero vector ``m(i)``
   of ``radius + 1`` bits; table ``v`` (each non-zero vector) keeps the bits whose
   ``m(i)`` has odd parity with ``v``.  The vectors of at most ``radius`` differing
   bits cannot span the space, so some ``v`` is orthogonal to all of them: that
   table's mask leaves every differing bit out and the pair meets there.  No pair
   within the radius is missed.
4. Fingerprints that share a table's masked key are linked inside one task by a
   search that emits a spanning star per component, never all pairs.  A bucket
   over ``max_bucket`` fingerprints is not searched: its rows get ``radius + 1``
   narrower masks, each with one block of the still free bits added.  Two
   fingerprints within the radius agree on one block at least, so nothing is
   lost, and a bucket with few free bits is small by itself.
5. Connected components over the emitted links, then the smallest id of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed, free_names, maybe_broadcast, word_blocks
from textloom.operators.bounded import skew_safe_lookup
from textloom.operators.graph import connected_components

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: fingerprints of one bucket searched in one task; larger buckets are split
MAX_BUCKET = 16_384
#: a bucket with this few free bits holds at most 2**12 fingerprints: always searched
_FREE = 12


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint: a bit is set if more than half of the shingle
    hashes have it.  Fewer words than a shingle are one shingle; no word gives 0."""
    if not text:
        return 0
    ones, total = np.zeros(BITS, np.int64), 0
    for words, _ in word_blocks(text.encode("utf-8", "surrogatepass").lower(), shingle - 1):
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        ends = ends[min(shingle, len(words)) - 1:].tolist()
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(h)
    if not total:
        return 0
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id``, ``text_key`` (hash of the text) and ``fp`` (signed 64-bit) of every row."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                    F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column("_text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("text_key"), pa.array(fps.view(np.int64))], ["id", "text_key", "fp"])

    kind = dict(d.dtypes)["id"]
    return d.mapInArrow(run, f"id {kind}, text_key long, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The ``2**(radius + 1) - 1`` masks (unsigned)."""
    top = 1 << (radius + 1)
    vector = [i % (top - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(mask: int, parts: int) -> list[int]:
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << i for i in free[j::parts]) for j in range(parts)]


def spanning_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links ``(member, smallest)`` that span each component of distinct ``fps``."""
    left, out = np.sort(fps), []
    while len(left) > 1:
        root, left, todo = left[0], left[1:], [left[0]]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                todo.extend(found)
                out.extend((int(x), int(root)) for x in found)
    return out


def _search(radius: int, max_bucket: int):
    """Rows (mask, key, fp) in bucket order -> links (mask null, a, b), and the
    rows (mask, a = fp) of split buckets."""
    schema = pa.schema([("mask", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def table(masks, a, b):
        as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [as_long(masks) if masks is not None else pa.nulls(len(a), pa.int64()), as_long(a),
             as_long(b) if b is not None else pa.nulls(len(a), pa.int64())], schema=schema)

    def split(mask: int, fps: np.ndarray):
        for block in _blocks(mask, radius + 1):
            yield table([mask | block] * len(fps), fps, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, hot = [], None, False  # the bucket that may go on in the next batch

        def close():
            if at is not None and not hot and held:
                fps = np.concatenate(held)
                if len(fps) > 1 and (links := spanning_links(fps, radius)):
                    yield table(None, *map(list, zip(*links)))

        for batch in batches:
            mask, key, fp = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3))
            if not len(fp):
                continue
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
            # buckets of one or two that lie inside the batch are done all at once
            inner = np.ones(len(first), bool)
            inner[[0, -1]] = False
            two = first[inner & (last - first == 2)]
            x, y = fp[two], fp[two + 1]
            near = np.bitwise_count(x ^ y) <= radius
            if near.any():
                yield table(None, np.maximum(x, y)[near], np.minimum(x, y)[near])
            for i in np.flatnonzero(~inner | (last - first > 2)):
                s, e = first[i], last[i]
                here = (int(mask[s]), int(key[s]))
                if here != at:
                    yield from close()
                    held, at, hot = [], here, False
                part = fp[s:e]
                if not hot:
                    held.append(part)
                    if sum(map(len, held)) > max_bucket and BITS - here[0].bit_count() > _FREE:
                        hot, part = True, np.concatenate(held)
                        held = []
                if hot:
                    yield from split(here[0], part)
        yield from close()

    return run


def links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of the distinct
    ``fp`` within ``radius`` bits."""
    keys = [F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for m in covering_masks(radius)]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("_b")).select("_b.mask", "_b.key", "fp")
    found = None
    while True:
        out = (rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
               .mapInArrow(_search(radius, max_bucket), "mask long, a long, b long"))
        out = checkpointed(out)
        new = out.filter("mask IS NULL").select("a", "b")
        found = new if found is None else found.unionByName(new)
        split = out.filter("mask IS NOT NULL")
        if split.isEmpty():  # masks only get wider, so this ends
            return found.distinct()
        rows = split.select("mask", F.col("a").bitwiseAND(F.col("mask")).alias("key"), F.col("a").alias("fp")).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                   max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``text_key``, ``fp``, ``root`` (the
    fingerprint that names the group) and ``component_id`` (the smallest id in it).

    Null, empty and wordless texts have fingerprint zero, linked like any other;
    null ids belong to groups but never name one unless the group has no other."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("w")))
    comp = connected_components(links(distinct.select("fp"), radius, max_bucket), "a", "b")
    rooted = distinct.join(comp.select(F.col("id").alias("fp"), F.col("component").alias("root")), "fp", "left")
    rooted = checkpointed(rooted.select("fp", "w", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("w"))
    least = checkpointed(least)
    named = skew_safe_lookup(rooted.select("fp", "root"), least.select("root", "component_id"),
                             ["root"], least.select("root", "w"))
    return skew_safe_lookup(rows, named.select("fp", "root", "component_id"), ["fp"],
                            distinct.select("fp", "w"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id, then the
    smallest text hash; of rows equal in both, any one."""
    groups = checkpointed(simhash_groups(docs, id_col, text_col, shingle, radius))
    keyed = groups.groupBy("root", "id", "text_key").agg(F.count("*").alias("n"))
    best = keyed.groupBy("root").agg(F.min_by(
        F.struct("id", "text_key", "n"),
        F.struct(F.col("id").isNull(), F.col("id"), F.col("text_key"))).alias("best"),
        F.count("*").alias("w"))
    best = checkpointed(best)
    flagged = skew_safe_lookup(keyed, best.select("root", "best"), ["root"], best.select("root", "w"))
    is_best = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_key") == F.col("best.text_key"))
    row, key = free_names(docs, "_id", "_key")
    named = lambda d, i, k: d.select(F.col(i).alias(row), F.col(k).alias(key))
    gone = checkpointed(named(flagged.filter(~is_best), "id", "text_key"))
    repeated = named(best.filter("best.n > 1"), "best.id", "best.text_key")
    on = docs[id_col].eqNullSafe(F.col(row)) & (F.xxhash64(docs[text_col]) == F.col(key))
    kept = docs.join(maybe_broadcast(gone), on, "left_anti")
    if repeated.isEmpty():
        return kept
    again = maybe_broadcast(repeated)
    one = docs.join(again, on, "left_semi").withColumn(key, F.xxhash64(text_col))
    return kept.join(again, on, "left_anti").unionByName(one.dropDuplicates([id_col, key]).drop(key))
