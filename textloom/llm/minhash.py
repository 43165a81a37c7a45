"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts: the set of distinct word shingles (64-bit hashes), a key of
   the set, and ``PERMUTATIONS`` 32-bit MinHash values.  Equal sets collapse to one node.
2. Bands of ``ROWS`` values: nodes that agree in a band share a bucket.  A pair at the
   threshold 0.85 shares none with probability (1 - 0.85**5)**32 = 7e-9.
3. Inside a bucket, signatures are compared batch after batch of 32 values.  With a
   uniform prior, after m of n equal values the similarity has a Beta(m + 1, n - m + 1)
   posterior; a pair goes as soon as its posterior chance to reach the threshold is
   below ``miss``.
   In a bucket this gives a spanning forest of likely links; the components of all
   forests are families: every pair that reaches the threshold lies in one.
4. Each family is verified exactly: its texts come together once, the survivors of the
   sequential test are compared on their full sets, and what is linked already is not
   compared again.  A family of n copies costs n - 1 comparisons and n - 1 links.

Nothing is compared pair by pair outside a task, and a task is bounded: buckets and
families over ``max_bucket`` nodes (or ``max_bytes`` of text) are dealt into parts.  The
parts of a bucket are one family.  The parts of a family are verified with ``PIVOTS``
nodes of it added to each, which joins most of them; then only parts that hold a node
outside the family's largest component meet the others, block by block.

Defined results.  Null, empty and wordless texts: empty set, linked with nothing, their
own component.  Fewer words than a shingle: one shingle, the whole sequence.  Very long
texts: whole, hashed in blocks of a megabyte.  Repeated rows and equal texts: one node,
a row each.  Null ids: belong to a component but never name one, unless it has no other
id.  Empty tables: no row.  Only the named columns are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed, free_names, maybe_broadcast, row_slices, word_blocks
from textloom.operators.bounded import skew_safe_lookup
from textloom.operators.graph import connected_components

SHINGLE = 3
THRESHOLD = 85  # percent
ROWS = 5
BANDS = 32
PERMUTATIONS = ROWS * BANDS
BATCH = 32
MISS = 1e-6
SEED = 13
#: nodes, and bytes of their texts, that are compared in one task
MAX_BUCKET = 8192
MAX_BYTES = 1 << 25
#: nodes of a family in parts that every part sees
PIVOTS = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that keeps the order of words apart


# ---------------------------------------------------------------- one text
def shingle_hashes(data: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; empty without words."""
    parts = []
    for words, _ in word_blocks((data or b"").lower(), k - 1):
        if not words:
            continue
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        n = max(len(w) - k + 1, 1)
        h = np.full(n, min(k, len(w)), np.uint64)
        for j in range(min(k, len(w))):
            h = (h ^ w[j:j + n]) * _STEP
            h ^= h >> np.uint64(29)
        parts.append(np.unique(h))
    if not parts:
        return np.empty(0, np.uint64)
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, (n, 1), np.uint32) << np.uint32(1) | np.uint32(1),
            rng.integers(0, 1 << 32, (n, 1), np.uint32))


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), block):
        np.minimum(low, (a * x[at:at + block] + b).min(axis=1), out=low)
    return low


def least_matches(n: int, percent: int, miss: float) -> int:
    """The fewest equal values of ``n`` that leave a posterior chance of at least
    ``miss`` that the similarity reaches ``percent``: with a uniform prior that
    chance is P(Binomial(n + 1, percent / 100) <= m)."""
    t, total, term = Fraction(percent, 100), Fraction(0), Fraction(100 - percent, 100) ** (n + 1)
    for m in range(n + 1):
        total += term
        if total >= Fraction(miss):
            return m
        term = term * (n + 1 - m) / (m + 1) * t / (1 - t)
    return n


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, permutations_: int) -> DataFrame:
    """``id``, ``text_key``, ``n_shingles``, ``node`` (key of the set, null if empty), ``sig``."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                    F.col(text_col).cast("binary").alias("_text"))
    kind = dict(d.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(permutations_, seed)
        for batch in batches:
            for part in row_slices(batch):
                sizes, nodes, sigs = [], [], []
                for x in part.column("_text"):
                    h = shingle_hashes(x.as_py(), shingle)
                    sizes.append(len(h))
                    nodes.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                    sigs.append(signature(h, a, b).tobytes() if len(h) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_key"), pa.array(sizes, pa.int64()),
                     pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                    ["id", "text_key", "n_shingles", "node", "sig"])

    return d.mapInArrow(run, f"id {kind}, text_key long, n_shingles long, node binary, sig binary")


# ---------------------------------------------------------------- search inside a block
class Search:
    """Candidate links among the members of one block."""

    def __init__(self, n_values: int, percent: int, miss: float):
        self.stops = [(at, min(at + BATCH, n_values), least_matches(min(at + BATCH, n_values), percent, miss))
                      for at in range(0, n_values, BATCH)]

    def near(self, sig: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
        """Of ``others`` those that may reach the threshold."""
        equal = np.zeros(len(others), np.int64)
        for start, end, least in self.stops:
            equal += (sig[others, start:end] == sig[x, start:end]).sum(1)
            stay = equal >= least
            others, equal = others[stay], equal[stay]
        return others

    def merged(self, sig: np.ndarray, label: np.ndarray, sets: "Sets | None" = None) -> np.ndarray:
        """Labels after joining those of candidates (with ``sets``: of pairs that reach
        the threshold)."""
        label = label.copy()
        for x in range(len(sig)):
            others = x + 1 + np.flatnonzero(label[x + 1:] != label[x])
            if not len(others):
                continue
            others = self.near(sig, x, others)
            for y in sets.reach(x, others) if sets else others:
                if label[y] != label[x]:
                    label[label == label[y]] = label[x]
        return label


class Sets:
    """The full sets of the nodes of one block."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes, self.percent = np.array([len(s) for s in sets]), percent
        self.ends = np.cumsum(self.sizes)
        distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.mark = flat, np.zeros(len(distinct), bool)

    def elements(self, x: int) -> np.ndarray:
        return self.flat[self.ends[x] - self.sizes[x]:self.ends[x]]

    def reach(self, x: int, others: np.ndarray) -> np.ndarray:
        """Of ``others`` those whose similarity to ``x`` reaches the threshold."""
        if not len(others):
            return others
        self.mark[self.elements(x)] = True
        both = np.array([np.count_nonzero(self.mark[self.elements(y)]) for y in others])
        self.mark[self.elements(x)] = False
        return others[100 * both >= self.percent * (self.sizes[x] + self.sizes[others] - both)]


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([max(p) for p in pairs], pa.binary()),
                                       pa.array([min(p) for p in pairs], pa.binary())], schema=_LINKS)


def _per_block(members: DataFrame, columns: list[str], one) -> DataFrame:
    """``one(rows) -> links`` for the rows (tuples of ``columns``) of every
    ``(group, block)``, in node order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for group, block, *row in zip(*(batch.column(c).to_pylist() for c in ("group", "block", *columns))):
                if (group, block) != at:
                    if rows:
                        yield _links(one(rows))
                    at, rows = (group, block), []
                rows.append(row)
        if rows:
            yield _links(one(rows))

    return (members.select("group", "block", *columns).repartition("group", "block")
            .sortWithinPartitions("group", "block", "node").mapInArrow(run, "a binary, b binary"))


def _joined(rows: list, search: Search, sets: Sets | None = None) -> list[tuple[bytes, bytes]]:
    """``rows`` of (node, label, signature, ...): every label that meets another, with
    the smallest label that it meets."""
    names = sorted({r[1] for r in rows})
    number = {n: i for i, n in enumerate(names)}
    label = np.array([number[r[1]] for r in rows])
    if len(names) < 2:
        return []
    group = search.merged(_signatures(rows, 2), label, sets)
    least: dict[int, int] = {}
    for before, after in sorted(set(zip(label.tolist(), group.tolist()))):
        least.setdefault(after, before)
    return [(names[before], names[least[after]]) for before, after in set(zip(label.tolist(), group.tolist()))
            if before != least[after]]


def _signatures(rows: list, at: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[at] for r in rows), np.uint32).reshape(len(rows), -1)


def _parts(n, size: int):
    return F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("long")


# ---------------------------------------------------------------- families
def families(nodes: DataFrame, percent: int, rows: int, bands: int, miss: float, max_bucket: int) -> DataFrame:
    """``(node, family)`` of ``nodes(node, sig)`` that have a likely link: pairs that
    reach the threshold share a family."""
    search = Search(rows * bands, percent, miss)

    def likely(members: list) -> list[tuple[bytes, bytes]]:
        # the parts of a bucket do not meet here, so that all of it is one family
        rep = members[0][3]
        return _joined(members, search) if rep is None else [(r[0], rep) for r in members if r[0] != rep]

    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 4 * rows * k + 1, 4 * rows)) for k in range(bands)])
    keyed = nodes.select("node", F.explode(keys).alias("group"))
    # of buckets with the same members one
    size = keyed.groupBy("group").agg(F.count("*").alias("n"), F.min("node").alias("rep"),
                                      F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who"))
    size = size.filter("n > 1").groupBy("n", "who", "rep").agg(F.min("group").alias("group"))
    size = checkpointed(size.select("group", "n", F.when(F.col("n") > max_bucket, F.col("rep")).alias("rep")))
    members = skew_safe_lookup(keyed, size, ["group"], size.select("group", F.col("n").alias("w")), how="inner",
                               salt_by=["node"])
    members = members.withColumn("block", F.pmod(F.xxhash64("node", "group"), _parts(F.col("n"), max_bucket)))
    members = members.join(nodes.select("node", "sig"), "node").withColumn("label", F.col("node"))
    found = _per_block(members, ["node", "label", "sig", "rep"], likely).distinct()
    return connected_components(checkpointed(found)).select(F.col("id").alias("node"), F.col("component").alias("family"))


# ---------------------------------------------------------------- exact verification
def _meetings(members: DataFrame, sizes: DataFrame, max_bucket: int, max_bytes: int) -> DataFrame:
    """Members ``(group, node, comp, bytes)`` of families in parts, dealt so that every
    two of different components share a block.  ``sizes``: ``group, main`` (the largest
    component), and rows and bytes of it and of all."""
    def parts(n, size):
        return F.greatest(_parts(n, max_bucket), _parts(size, max_bytes))

    rest = parts(F.col("n") - F.col("n_main"), F.col("size") - F.col("size_main"))
    main, is_main = parts(F.col("n_main"), F.col("size_main")), F.col("comp") == F.col("main")
    mine = F.pmod(F.xxhash64("node", "group"), F.when(is_main, main).otherwise(rest))
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    of_main = F.transform(to(rest), lambda r: F.concat_ws("-", F.lit("m"), r, mine))
    of_rest = F.concat(F.transform(to(main), lambda p: F.concat_ws("-", F.lit("m"), mine, p)),
                       F.transform(to(rest), lambda r: F.concat_ws("-", F.lit("r"), F.least(mine, r), F.greatest(mine, r))))
    m = skew_safe_lookup(members, sizes, ["group"], sizes.select("group", F.col("n").alias("w")), how="inner", salt_by=["node"])
    return m.withColumn("block", F.explode(F.when(is_main, of_main).otherwise(of_rest)))


def _verified(members: DataFrame, percent: int, shingle: int, rows: int, bands: int, miss: float) -> DataFrame:
    """Links ``(a, b)`` between the ``comp`` of members of a block: what pairs that
    reach the threshold join."""
    search = Search(rows * bands, percent, miss)

    def exact(block: list) -> list[tuple[bytes, bytes]]:
        if len({r[1] for r in block}) < 2:
            return []
        return _joined(block, search, Sets([shingle_hashes(r[3], shingle) for r in block], percent))

    return checkpointed(_per_block(members, ["node", "comp", "sig", "text"], exact).distinct())


def linked_nodes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, rows: int,
                 bands: int, miss: float, max_bucket: int, max_bytes: int) -> DataFrame:
    """``(node, comp)``: exact components of the nodes that have a link."""
    family = checkpointed(families(nodes.select("node", "sig"), percent, rows, bands, miss, max_bucket))
    # the text of every node with a family
    i, key, node = free_names(docs, "_id", "_key", "_node")
    asked = checkpointed(nodes.join(family, "node", "left_semi").select(
        F.col("first.id").alias(i), F.col("first.text_key").alias(key), F.col("node").alias(node)))
    on = docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(key))
    texts = docs.join(maybe_broadcast(asked), on).select(F.col(node).alias("node"), docs[text_col].cast("binary").alias("text"))
    # rows equal in id and text name the same node: one of them is enough
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    members = checkpointed(texts.join(nodes.select("node", "sig"), "node").join(family, "node").select(
        F.col("family").alias("group"), "node", "sig", "text", F.length("text").alias("bytes"), F.col("node").alias("comp")))
    verify = lambda df: _verified(df, percent, shingle, rows, bands, miss)

    parts = F.greatest(_parts(F.count("*"), max_bucket), _parts(F.sum("bytes"), max_bytes))
    large = checkpointed(members.groupBy("group").agg(parts.alias("parts")).filter("parts > 1"))
    whole = members if large.isEmpty() else members.join(large, "group", "left_anti")
    # in a block that is a whole family every label meets the smallest of its component
    stars = lambda links: links.unionByName(links.select(F.col("b").alias("a"), "b").distinct()).select(
        F.col("a").alias("node"), F.col("b").alias("comp"))
    comps = stars(verify(whole.withColumn("block", F.lit(0))))
    if large.isEmpty():
        return comps

    split = checkpointed(members.join(large, "group"))
    each = split.withColumn("block", F.pmod(F.xxhash64("node", "group"), F.col("parts")))
    pivot = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("node"), "node"))
    pivots = split.select("group", "node", pivot.alias("r")).filter(F.col("r") <= PIVOTS).select("group", "node")
    seen = split.join(pivots, ["group", "node"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    first = verify(each.unionByName(seen).dropDuplicates(["group", "block", "node"]))
    joined = connected_components(first).select(F.col("id").alias("node"), F.col("component").alias("_c"))
    split = checkpointed(split.join(joined, "node", "left").withColumn("comp", F.coalesce("_c", "node")).drop("_c", "parts"))
    by_comp = split.groupBy("group", "comp").agg(F.count("*").alias("c"), F.sum("bytes").alias("s"))
    largest = F.max(F.struct("c", "comp", "s"))
    sizes = checkpointed(by_comp.groupBy("group").agg(F.sum("c").alias("n"), F.sum("s").alias("size"), largest.alias("l")).select(
        "group", "n", "size", F.col("l.comp").alias("main"), F.col("l.c").alias("n_main"), F.col("l.s").alias("size_main"))
        .filter("n_main < n"))
    more = verify(_meetings(split, sizes, max_bucket, max_bytes))
    linked = first.unionByName(more)
    return comps.unionByName(connected_components(linked).select(F.col("id").alias("node"), F.col("component").alias("comp")))


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = THRESHOLD, rows: int = ROWS, bands: int = BANDS, miss: float = MISS,
                   seed: int = SEED, max_bucket: int = MAX_BUCKET, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the
    smallest id reachable by links of at least ``percent`` Jaccard similarity."""
    found = checkpointed(fingerprints(docs, id_col, text_col, shingle, seed, rows * bands))
    nodes = checkpointed(found.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_key"))).alias("_named"),
        F.min(F.struct("id", "text_key")).alias("_any"), F.first("sig").alias("sig"), F.count("*").alias("w"))
        .select("node", F.coalesce("_named", "_any").alias("first"), "sig", "w"))
    comps = linked_nodes(docs, nodes, id_col, text_col, shingle, percent, rows, bands, miss, max_bucket, max_bytes)
    rooted = checkpointed(nodes.select("node", "w", F.col("first.id").alias("component_id")).join(
        comps.select("node", F.col("comp").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = checkpointed(rooted.groupBy("root").agg(F.min("component_id").alias("component_id"), F.count("*").alias("w")))
    named = skew_safe_lookup(rooted.select("node", "root", F.col("w").alias("_w")), least.select("root", "component_id"),
                             ["root"], least.select("root", "w"), salt_by=["node"])
    named = checkpointed(named.select("node", F.col("_w").alias("w"), "component_id"))
    with_set = skew_safe_lookup(found.filter("node IS NOT NULL").select("id", "n_shingles", "node", "text_key"),
                                named.select("node", "component_id"), ["node"], named.select("node", "w"),
                                salt_by=["id", "text_key"])
    without = found.filter("node IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    return with_set.select("id", "n_shingles", "component_id").unionByName(without)
