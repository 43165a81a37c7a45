"""Exact set-similarity join: components of all pairs of sets at a Jaccard threshold.

Sets are sorted rare-first.  Two sets of sizes m and n with similarity t or more share
at least ``t / (1 + t) * (m + n)`` elements, so they share one of the first
``n - ceil(t * n) + 1`` elements of each: the prefixes.  Only sets that meet in a
prefix element are candidates, sizes must be within a factor t, and the places of the
shared element must leave room for enough others.  No signature is involved and no
pair can be missed.

Any fixed order of the elements is right; a rare-first one keeps groups small.  It is
taken from a table of ``BUCKETS`` hashed counts, whose size does not grow.

A group of n sets that share an element is not expanded into all its pairs.  Each set
is first verified against the smallest set it meets anywhere; then members of a group
that is not one component yet are verified against its 1, 8, 64, 512, ... smallest
members of other components, until a group is one component or all of its members
have been among those.

That is done on sketches first: one bit per hash bucket, the parity of the set's elements
there.  Two sets differ in at least as many elements as their sketches in bits, so no
similar pair fails, and a sketch has about a 50th of the bytes of its set.  Full sets move
once, to the task that verifies the component which their sketches form; only of a
component that is too large for a task are pairs verified in rounds once more.
"""

from __future__ import annotations

import hashlib
import zlib
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.bounded import skew_safe_lookup
from textloom.operators.graph import connected_components

BUCKETS = 1 << 20
#: rows of a table up to which it is broadcast
BROADCAST_ROWS = 100_000
_CHUNK = 1 << 14
#: rows of hashes up to which they are broadcast
BROADCAST_HASHES = 1_000_000
#: sets, and elements of them, in a block of nodes that are verified together
_BLOCK_SETS = 1024
_BLOCK_ELEMENTS = 1 << 20
#: the same for a component that one task verifies as a whole
_WHOLE_SETS = 4096
_WHOLE_ELEMENTS = 1 << 22
_EPS = 1e-9
_BASE = np.uint64(1099511628211)


def shingle_set(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-grams (one of all words if there are fewer)."""
    t = word_hashes.view(np.uint64)
    if not len(t):
        return np.zeros(1, np.uint64)  # the empty sequence is a shingle too
    n = max(len(t) - k + 1, 1)
    h = np.full(n, min(k, len(t)), np.uint64)
    for j in range(min(k, len(t))):
        h = h * _BASE + t[j:j + n]
    h ^= h >> np.uint64(31)
    return np.unique(h * np.uint64(0x9E3779B97F4A7C15))


def set_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def node_of(key: bytes, salt: int, bits: int = 64) -> int:
    """Number of a set, from its key: what stands for the set in all rows."""
    h = hashlib.blake2b(key, digest_size=8, salt=salt.to_bytes(4, "little")).digest()
    return int.from_bytes(h, "little", signed=True) >> (64 - bits)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity of the elements in each of as many buckets as there are elements, or up to
    twice as many: a power of two, 64 at least."""
    bits = 1 << max(6, int(len(elements) - 1).bit_length())
    at = ((elements >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with fewer buckets: ``size`` words of 64."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def may_be_similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Of two sketches, each behind the size of its set: False only if the sets differ in
    too many elements."""
    size = min(len(a), len(b)) - 1
    least = int(np.bitwise_count(folded(a[1:], size) ^ folded(b[1:], size)).sum())
    return least * (1 + threshold) <= (1 - threshold) * int(a[0] + b[0]) + _EPS


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Exact, of the elements of two sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= threshold * (len(a) + len(b) - both)


def _sets(b: pa.RecordBatch, k: int) -> Iterator[np.ndarray | None]:
    """The set of every row of a batch with a column ``th`` of word hashes."""
    words = b.column("th")
    flat, ends = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    for i in range(len(words)):
        yield shingle_set(flat[ends[i]:ends[i + 1]].astype(np.int64), k) if words[i].is_valid else None


def keys_and_counts(words: DataFrame, k: int, salt: int = 0, bits: int = 64, buckets: int = BUCKETS) -> tuple[DataFrame, np.ndarray]:
    """In one pass over ``words(id, text_key, th)``: ``id, text_key, node, key, n, sketch``
    (its size, then its words) of the set of every row, and how many rows hold an element of each hash bucket (a
    table of fixed size)."""
    kind = dict(words.dtypes)["id"]
    schema = ["id", "text_key", "node", "key", "n", "sketch", "at", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, id_type = np.zeros(buckets, np.int64), None
        for b in batches:
            id_type, found = b.schema.field("id").type, []
            for s in _sets(b, k):
                found.append((None,) * 4 if s is None else (
                    node_of(key := set_key(s), salt, bits), key, len(s), np.append(np.uint64(len(s)), sketch(s)).view(np.int64)))
                if s is not None:
                    np.add.at(n, (s % np.uint64(buckets)).astype(np.int64), 1)
            own = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64())))]
            none = pa.nulls(len(found), pa.int32()), pa.nulls(len(found), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_key"), *own, *none], schema)
        for at in range(0, buckets if id_type else 0, _CHUNK):
            if n[at:at + _CHUNK].any():
                none = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*none, pa.array([at], pa.int32()), pa.array([_packed(n[at:at + _CHUNK])], pa.binary())], schema)

    both = words.select("id", "text_key", "th").mapInArrow(
        run, f"id {kind}, text_key long, node long, key binary, n int, sketch array<long>, at int, counts binary").checkpoint(eager=True)

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"at": [pdf["at"].iloc[0]], "counts": [_packed(np.sum([_unpacked(c) for c in pdf["counts"]], axis=0))]})

    total = np.zeros(buckets, np.int64)
    parts = both.filter("at IS NOT NULL").select("at", "counts", (F.spark_partition_id() % 64).alias("_d"))
    partial = parts.groupBy("at", "_d").applyInPandas(add, "at int, counts binary")  # sums of some of the tasks first
    for r in partial.groupBy("at").applyInPandas(add, "at int, counts binary").collect():  # `buckets` numbers
        some = _unpacked(r["counts"])
        total[r["at"]:r["at"] + len(some)] = some
    return both.filter("at IS NULL").drop("at", "counts"), total


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype(np.int64).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int64)


def prefix_length(n: int, threshold: float) -> int:
    return n - int(np.ceil(threshold * n - 1e-9)) + 1


def shared_prefixes(words: DataFrame, k: int, counts: np.ndarray, threshold: float, salt: int = 0, bits: int = 64,
                    max_rows: int = 1 << 20) -> DataFrame:
    """``element, node, n, at``: the prefix elements that several distinct sets have,
    with their places in rare-first order.

    One shuffle by element.  An element whose bucket counts more than ``max_rows`` is
    dealt over several partitions and taken for shared without a count."""
    shared = words.sparkSession.sparkContext.broadcast(counts)
    schema = ["element", "part", "node", "n", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = shared.value
        for b in batches:
            done: set[int] = set()  # copies inside a batch
            for at in range(0, b.num_rows, 256):
                firsts, keys, sizes = [], [], []
                for s in _sets(b.slice(at, 256), k):
                    if s is None or (key := node_of(set_key(s), salt, bits)) in done:
                        continue
                    done.add(key)
                    order = np.lexsort((s, frequency[(s % np.uint64(len(frequency))).astype(np.int64)]))
                    firsts.append(s[order[:prefix_length(len(s), threshold)]])
                    keys.append(key)
                    sizes.append(len(s))
                if keys:
                    lengths = [len(f) for f in firsts]
                    elements = np.concatenate(firsts)
                    hot = frequency[(elements % np.uint64(len(frequency))).astype(np.int64)] // max_rows
                    dealt = np.repeat(np.array(keys, np.int64), lengths) % (hot + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(elements.view(np.int64)), pa.array(np.where(hot > 0, dealt + 1, 0).astype(np.int32)),
                         pa.array(np.repeat(np.array(keys, np.int64), lengths)),
                         pa.array(np.repeat(sizes, lengths).astype(np.int32)),
                         pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]))], schema)

    rows = words.select("th").mapInArrow(run, "element long, part int, node long, n int, at int").repartition("element", "part")
    rows = rows.groupBy("element", "part", "node").agg(F.first("n").alias("n"), F.first("at").alias("at"))
    several = F.count(F.lit(1)).over(Window.partitionBy("element", "part")) > 1
    return rows.withColumn("_s", several).filter("_s OR part > 0").select("element", "node", "n", "at")


def sets_of(words: DataFrame, k: int) -> DataFrame:
    """``words(node, th, ...)`` -> ``node, sh`` of every row, and its other columns."""
    others = [(c, t) for c, t in words.dtypes if c not in ("node", "th")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                sh = pa.array([s.view(np.int64) for s in _sets(some, k)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([some.column("node"), sh, *(some.column(c) for c, _ in others)], ["node", "sh", *(c for c, _ in others)])

    return words.mapInArrow(run, ", ".join(["node long, sh array<long>", *(f"{c} {t}" for c, t in others)]))


def _broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(node, block)``: nodes with the same smallest partner lie together, in blocks of
    bounded size.  Which block a node is in changes what is moved, not the result."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"), F.col("b").alias("by"))
    homes = ends.groupBy("node").agg(F.min("by").alias("by")).join(sets.select("node", F.size("sh").alias("n")), "node")
    room = homes.groupBy("by").agg(F.greatest(F.ceil(F.sum("n") / _BLOCK_ELEMENTS), F.ceil(F.count(F.lit(1)) / _BLOCK_SETS)).alias("p"))
    part = F.pmod(F.xxhash64("node"), F.col("p").cast("long"))
    return homes.join(room, "by").select("node", F.xxhash64("by", part).alias("block")).checkpoint(eager=True)


def _cells(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``lo, hi, node, us, sh``: the pairs of two blocks of nodes are a cell.  A set (or its
    sketch) moves once to every cell that asks for it, however many of its pairs lie there:
    without ``us`` for a set of the first block, with its partners there for one of the second."""
    blocks = _blocks(pairs, sets)
    near = _broadcast_if_small(blocks, BROADCAST_ROWS)
    of = lambda c: near.select(F.col("node").alias(c), F.col("block").alias(f"{c}_block"))
    swap = F.col("a_block") > F.col("b_block")
    dealt = pairs.join(of("a"), "a").join(of("b"), "b").select(
        F.least("a_block", "b_block").alias("lo"), F.greatest("a_block", "b_block").alias("hi"),
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("u"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("v")).checkpoint(eager=True)
    kind = dict(pairs.dtypes)["a"]
    held = dealt.select("lo", "hi", F.col("u").alias("node"), F.lit(None).cast(f"array<{kind}>").alias("us")).distinct()
    read = dealt.groupBy("lo", "hi", F.col("v").alias("node")).agg(F.collect_list("u").alias("us"))
    # sets that no pair asks for stay where they are
    asked = _broadcast_if_small(blocks.select(F.xxhash64("node").alias("_h")).distinct(), BROADCAST_HASHES)
    wanted = sets.join(asked, F.xxhash64(sets["node"]) == F.col("_h"), "left_semi")
    rows = wanted.join(_broadcast_if_small(held.unionByName(read), BROADCAST_ROWS), "node")
    return rows.select("lo", "hi", "node", "us", "sh")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float, judge: Callable = similar) -> DataFrame:
    """``(a, b, ok)``: what ``judge`` says of each pair: the exact similarity of two sets
    against the threshold, or of their sketches whether it can be reached.

    A task holds the sets of one block of a cell and reads those of the other."""
    rows = _cells(pairs, sets).repartition("lo", "hi").sortWithinPartitions("lo", "hi", F.col("us").isNotNull())
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, block = None, {}
        for batch in batches:
            a, b, ok, name_type = [], [], [], batch.schema.field("node").type
            for lo, hi, node, us, sh in zip(*(batch.column(c) for c in ("lo", "hi", "node", "us", "sh"))):
                if cell != (at := (lo.as_py(), hi.as_py())):
                    cell, block = at, {}
                name, mine = node.as_py(), sh.values.to_numpy().view(np.uint64)
                if not us.is_valid:  # the sets of the first block come first
                    block[name] = mine.copy()
                    continue
                for u in us.as_py():
                    a.append(max(u, name))
                    b.append(min(u, name))
                    ok.append(bool(judge(block[u], mine, threshold)))
            yield pa.RecordBatch.from_arrays([pa.array(a, name_type), pa.array(b, name_type), pa.array(ok, pa.bool_())],
                                             ["a", "b", "ok"])

    return rows.mapInArrow(run, f"a {kind}, b {kind}, ok boolean")


def components_of(names: list[int], sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """``(node, smallest node)`` of those of a few sets that have a similar one."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets, names = [sets[i] for i in order], np.array([names[i] for i in order], np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    sketches = [sketch(s) for s in sets]
    comp, linked = names.copy(), np.zeros(len(sets), bool)
    at = 0
    while at < len(sets):  # sets whose sketches have the same length, against themselves and larger ones
        size = len(sketches[at])
        end = at + next((i for i, x in enumerate(sketches[at:]) if len(x) > size), len(sets) - at)
        reach = int(np.searchsorted(sizes, sizes[end - 1] / threshold + 1))
        bits = np.stack([folded(x, size) for x in sketches[at:reach]])
        for i in range(at, end):
            others = np.arange(i + 1, int(np.searchsorted(sizes, sizes[i] / threshold + _EPS, "right")))
            others = others[comp[others] != comp[i]]
            differ = np.bitwise_count(bits[others - at] ^ bits[i - at]).sum(axis=1, dtype=np.int64)
            for j in others[differ * (1 + threshold) <= (1 - threshold) * (sizes[i] + sizes[others]) + _EPS]:
                if comp[j] != comp[i] and similar(sets[i], sets[j], threshold):
                    linked[[i, j]] = True
                    old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                    comp[comp == old] = new
        at = end
    return list(zip(names[linked].tolist(), comp[linked].tolist()))


def _whole_components(sets: DataFrame, threshold: float) -> DataFrame:
    """``(node, comp)``; ``sets(node, sh, super)``: all sets of a ``super`` lie in one
    task, and sets of different ones are not similar."""
    rows = sets.select("super", "node", "sh").repartition("super").sortWithinPartitions("super")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def settled() -> pa.RecordBatch:
            found = components_of(list(held), list(held.values()), threshold)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["node", "comp"])

        for b in batches:
            for sup, node, sh in zip(*(b.column(c) for c in ("super", "node", "sh"))):
                if now != (at := sup.as_py()):
                    if held:
                        yield settled()
                    now, held = at, {}
                held[node.as_py()] = sh.values.to_numpy().view(np.uint64).copy()
        if held:
            yield settled()

    return rows.mapInArrow(run, "node long, comp long")


def similar_components(groups: DataFrame, judged: Callable, threshold: float) -> DataFrame | None:
    """``(node, comp)`` of every node with a similar one; ``groups``: the prefix rows of
    elements that several nodes share, ``judged``: the similar ones of pairs ``(a, b)``.
    None if there is no candidate at all."""
    tried = good = comps = None

    def with_comps(df: DataFrame) -> DataFrame:
        if comps is None:
            return df.withColumn("comp", F.col("node"))
        near = _broadcast_if_small(comps, BROADCAST_ROWS)
        return df.join(near, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def candidates(g: DataFrame, hubs: int) -> DataFrame:
        first = g.filter(F.col("_r") <= hubs).select("element", *[F.col(c).alias(f"h_{c}") for c in ("node", "n", "at", "comp")])
        j = g.join(first, "element").filter((F.col("comp") != F.col("h_comp")) & (F.col("node") != F.col("h_node")))
        left = F.least(F.col("n") - F.col("at"), F.col("h_n") - F.col("h_at")) + F.least("at", "h_at")
        room = left * (1 + threshold) >= threshold * (F.col("n") + F.col("h_n")) - _EPS
        size = F.least("n", "h_n") >= threshold * F.greatest("n", "h_n") - _EPS
        return j.filter(room & size)

    group = Window.partitionBy("element")
    active, hubs = groups, 0  # at 0 hubs every node tries one partner only
    while True:
        # one shuffle by element finds the open groups, their first members and the pairs
        g = with_comps(active).withColumns({
            "_n": F.count(F.lit(1)).over(group), "_lo": F.min("comp").over(group), "_hi": F.max("comp").over(group),
            "_r": F.row_number().over(group.orderBy("node"))})
        # with n hubs tried, a group of n + 1 is done
        g = g.filter((F.col("_lo") < F.col("_hi")) & (F.col("_n") > hubs // 8 + 1)).drop("_n", "_lo", "_hi")
        if hubs > 1:  # most groups are pairs, which are done by then
            g = g.checkpoint(eager=True)
            if g.isEmpty():
                return comps
            active = g.drop("comp", "_r")
        found = candidates(g, max(hubs, 1))
        if not hubs:
            found = found.groupBy("node").agg(F.min("h_node").alias("h_node"))
        pairs = found.select(F.greatest("node", "h_node").alias("a"), F.least("node", "h_node").alias("b")).distinct()
        pairs = (pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")).checkpoint(eager=True)
        if not pairs.isEmpty():
            links = judged(pairs).checkpoint(eager=True)
            tried = pairs if tried is None else tried.unionByName(pairs)
            good = links if good is None else good.unionByName(links)
            comps = connected_components(good).select(F.col("id").alias("node"), F.col("component").alias("comp"))
        hubs = hubs * 8 or 1


def _keyed(words: DataFrame, k: int, bits: int) -> tuple[int, DataFrame, np.ndarray, DataFrame]:
    """Salt, rows and counts of ``keys_and_counts``, and ``node, n, sketch, least`` (the
    smallest id), ``first`` (the smallest row), ``w`` (rows) of each set; the salt is one
    that gives every set a number of its own."""
    salt = 0
    while True:
        keyed, counts = keys_and_counts(words, k, salt, bits)
        nodes = keyed.filter("node IS NOT NULL").groupBy("node").agg(
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("id").alias("least"), F.count(F.lit(1)).alias("w"),
            F.min(F.struct("id", "text_key")).alias("first"), (F.min("key") != F.max("key")).alias("_two")).checkpoint(eager=True)
        if nodes.filter("_two").isEmpty():
            return salt, keyed.select("id", "text_key", "node"), counts, nodes.drop("_two")
        salt += 1


def _linked(texts: DataFrame, with_words: Callable, nodes: DataFrame, groups: DataFrame, k: int, threshold: float,
            whole_sets: int, whole_elements: int) -> DataFrame | None:
    """``(node, comp)`` of every node with a similar one; None if there is no candidate."""
    sketches = nodes.join(groups.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("sketch").alias("sh")).checkpoint(eager=True)

    def close(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, sketches, threshold, may_be_similar).filter("ok").select("a", "b")

    loose = similar_components(groups, close, threshold)
    if loose is None:
        return None
    loose = loose.withColumnRenamed("comp", "super").join(nodes.select("node", "n", "first"), "node")
    size = loose.groupBy("super").agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_n")).select(
        "super", ((F.col("_c") <= whole_sets) & (F.col("_n") <= whole_elements)).alias("whole"))
    loose = loose.join(size, "super").select("node", "super", "whole", F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key")).checkpoint(eager=True)

    # only texts of such sets are shuffled, not the arrays made of them
    asked = _broadcast_if_small(loose.select(F.xxhash64("_id", "_key").alias("_h")).distinct(), BROADCAST_HASHES)
    some = texts.join(asked, F.xxhash64("id", "text_key") == F.col("_h"), "left_semi").filter("text IS NOT NULL")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))

    def sets(which: DataFrame) -> DataFrame:
        found = some.join(_broadcast_if_small(which.drop("whole"), BROADCAST_ROWS), same).select("node", "super", "text")
        return sets_of(with_words(found), k)

    comps = _whole_components(sets(loose.filter("whole")), threshold).checkpoint(eager=True)
    large = loose.filter("NOT whole")
    if not large.isEmpty():
        # rows that are equal in id and text name one set: one of them is enough
        held = sets(large).groupBy("node").agg(F.first("sh").alias("sh")).checkpoint(eager=True)

        def exact(pairs: DataFrame) -> DataFrame:
            return _verified(close(pairs).checkpoint(eager=True), held, threshold).filter("ok").select("a", "b")

        inside = groups.join(large.select("node", "super"), "node").select(
            F.xxhash64("element", "super").alias("element"), "node", "n", "at").checkpoint(eager=True)
        more = similar_components(inside, exact, threshold)
        comps = comps if more is None else comps.unionByName(more)
    return comps


def similar_texts(texts: DataFrame, tokens, threshold: float, k: int, node_bits: int = 64,
                  whole_sets: int = _WHOLE_SETS, whole_elements: int = _WHOLE_ELEMENTS) -> DataFrame:
    """``texts(id, text_key, text)`` -> ``id, text_key, cluster`` (the smallest id of
    the component; null only if no row of it has one) of every row; ``tokens`` makes
    the array of word hashes of a text column."""
    def with_words(df: DataFrame) -> DataFrame:
        return df.withColumn("th", tokens(F.col("text"))).drop("text")

    words = with_words(texts)
    salt, keyed, counts, nodes = _keyed(words, k, node_bits)
    groups = shared_prefixes(words, k, counts, threshold, salt, node_bits).checkpoint(eager=True)
    comps = _linked(texts, with_words, nodes, groups, k, threshold, whole_sets, whole_elements)
    named = nodes.select("node", "least", "w")
    named = (named.withColumn("comp", F.col("node")) if comps is None else
             named.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))).checkpoint(eager=True)
    least = named.groupBy("comp").agg(F.min("least").alias("cluster"), F.count(F.lit(1)).alias("w")).checkpoint(eager=True)
    named = skew_safe_lookup(named.select("node", "comp", F.col("w").alias("_w")), least.select("comp", "cluster"), ["comp"],
                             least.select("comp", "w"), salt_by=["_w"]).checkpoint(eager=True)
    linked = skew_safe_lookup(keyed.filter("node IS NOT NULL").select("id", "text_key", "node"),
                              named.select("node", "cluster"), ["node"], named.select("node", F.col("_w").alias("w")),
                              salt_by=["id", "text_key"]).select("id", "text_key", "cluster")
    return linked.unionByName(keyed.filter("node IS NULL").select("id", "text_key", F.col("id").alias("cluster")))
