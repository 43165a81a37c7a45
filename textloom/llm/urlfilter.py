"""URL filtering: longest matching rule first, then exact set membership from a
cascade of Bloom filters.

Level 0 holds the listed keys.  Over the corpus's complete key universe some
unlisted keys pass it by chance; level 1 holds those, level 2 the listed keys that
pass level 1, and so on until a level lets no wrong key pass.  A key's answer is the
level that first turns it away, which is exact for every key of the universe:
pages are judged without a join with the list.

Keys are dealt by hash into shards of about ``SHARD_KEYS``, each with a cascade of
its own that one task builds; a key is 128 hash bits, and repeated urls are
aggregated away before the shuffle.  The finished cascades (a few bits per key) are
broadcast up to ``MAX_BROADCAST_BYTES``; beyond that pages are dealt to their
shard's cascade instead, hot keys spread over copies of it.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from textloom.llm.common import checkpointed, free_names

SHARD_KEYS = 500_000
FALSE_POSITIVES = 0.01
MAX_BROADCAST_BYTES = 64 << 20
#: copies of a shard's cascade beyond the broadcast bound; rows are spread over them
COPIES = 16

Rule = tuple[str, str, str]  # verdict, host, path


# ------------------------------------------------------------------ url parts and rules
def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


# ------------------------------------------------------------------ one Bloom filter, one cascade
def _probes(a: np.ndarray, b: np.ndarray, level: int, hashes: int, bits: int) -> Iterator[np.ndarray]:
    """Bit places of keys ``(a, b)``; every level mixes them anew."""
    with np.errstate(over="ignore"):
        salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x, y = _mix(a ^ salt), _mix(b + salt) | np.uint64(1)
        for i in range(hashes):
            yield _mix(x + np.uint64(i) * y) % np.uint64(bits)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Bloom:
    def __init__(self, level: int, hashes: int, bits: int, data: np.ndarray):
        self.level, self.hashes, self.bits, self.data = level, hashes, bits, data

    @classmethod
    def of(cls, a, b, level: int, rate: float) -> Bloom:
        bits = max(64, int(np.ceil(-len(a) * np.log(rate) / np.log(2) ** 2 / 8)) * 8)
        hashes = max(1, round(-np.log2(rate)))
        data = np.zeros(bits // 8, np.uint8)
        for at in _probes(a, b, level, hashes, bits):
            np.bitwise_or.at(data, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        return cls(level, hashes, bits, data)

    def has(self, a, b) -> np.ndarray:
        out = np.ones(len(a), bool)
        for at in _probes(a, b, self.level, self.hashes, self.bits):
            out &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    def to_bytes(self) -> bytes:
        return np.array([self.hashes, self.bits], "<u8").tobytes() + self.data.tobytes()

    @classmethod
    def from_bytes(cls, level: int, x: bytes) -> Bloom:
        hashes, bits = np.frombuffer(x, "<u8", 2).tolist()
        return cls(level, hashes, bits, np.frombuffer(x, np.uint8, offset=16))


def build_cascade(a: np.ndarray, b: np.ndarray, listed: np.ndarray, rate: float = FALSE_POSITIVES) -> list[Bloom]:
    """Levels for distinct keys; those in ``listed`` are in the set.  Ends when
    a level lets no wrong key pass: every level keeps about ``rate`` of them."""
    levels: list[Bloom] = []
    inside, outside = (a[listed], b[listed]), (a[~listed], b[~listed])
    while len(inside[0]):
        f = Bloom.of(*inside, len(levels), rate if not levels else 0.25)
        levels.append(f)
        passed = f.has(*outside)
        inside, outside = (outside[0][passed], outside[1][passed]), inside
    return levels


def in_cascade(levels: list[Bloom], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Membership: a key turned away first by level k is listed if k is odd; one
    that passes all is listed if their number is odd."""
    answer = np.full(len(a), len(levels) % 2 == 1)
    left = np.arange(len(a))
    for f in levels:
        ok = f.has(a[left], b[left])
        answer[left[~ok]] = f.level % 2 == 1
        left = left[ok]
    return answer


# ------------------------------------------------------------------ over tables
def _hashes(key: Column, names: list[str]) -> list[Column]:
    """128 bits of a key; null is a key of its own."""
    k = F.coalesce(F.concat(F.lit("k"), key), F.lit(""))
    return [F.xxhash64(F.lit(i), k).alias(n) for i, n in enumerate(names)]


def cascades(universe: DataFrame, key_col: str, listed_col: str, shard_keys: int = SHARD_KEYS,
             rate: float = FALSE_POSITIVES) -> DataFrame:
    """``(shard, shards, level, data)`` of the cascades over all keys of
    ``universe``; a key is listed if any of its rows says so (null: not)."""
    keys = universe.select(*_hashes(F.col(key_col), ["_a", "_b"]), F.coalesce(F.col(listed_col), F.lit(False)).alias("_l"))
    keys = checkpointed(keys.groupBy("_a", "_b").agg(F.max("_l").alias("_l")))
    shards = max(1, -(-keys.count() // shard_keys))
    sharded = keys.withColumn("shard", F.pmod(F.col("_a"), F.lit(shards)).cast("int"))

    def run(t: pa.Table) -> pa.Table:
        a, b = (t.column(c).to_numpy().view(np.uint64) for c in ("_a", "_b"))
        levels = build_cascade(a, b, t.column("_l").to_numpy(zero_copy_only=False).astype(bool), rate)
        n = len(levels)
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()] * n, pa.int32()),
                         "shards": pa.array([shards] * n, pa.int32()),
                         "level": pa.array(range(n), pa.int32()),
                         "data": pa.array([f.to_bytes() for f in levels], pa.binary())})

    return checkpointed(sharded.groupBy("shard").applyInArrow(
        run, "shard int, shards int, level int, data binary"))


def _levels(rows) -> dict[int, list[Bloom]]:
    found: dict[int, list[Bloom]] = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        found.setdefault(r[0], []).append(Bloom.from_bytes(r[1], bytes(r[2])))
    return found


def listed(rows: DataFrame, key_col: str, filters: DataFrame, out: str = "listed",
           max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``rows`` with a boolean ``out``: whether ``key_col`` is listed.  Exact
    for keys of the universe that ``filters`` were built over."""
    size, shards = filters.agg(F.sum(F.length("data")), F.max("shards")).first()
    if not size:  # nothing is listed
        return rows.withColumn(out, F.lit(False))
    one, two, deal, copy = free_names(rows, "_a", "_b", "_shard", "_copy")
    d = rows.select("*", *_hashes(F.col(key_col), [one, two]))
    schema = StructType([*rows.schema.fields, StructField(out, BooleanType())])
    names = rows.columns

    def judge(b: pa.RecordBatch | pa.Table, found: dict[int, list[Bloom]]):
        a, h = (np.asarray(b.column(c)).view(np.uint64) for c in (one, two))
        shard = (a.view(np.int64) % shards).astype(np.int64)
        yes = np.zeros(len(a), bool)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            yes[at] = in_cascade(found.get(int(s), []), a[at], h[at])
        return [*(b.column(c) for c in names), pa.array(yes)]

    if size <= max_broadcast:
        sent = rows.sparkSession.sparkContext.broadcast(
            [tuple(r) for r in filters.select("shard", "level", "data").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _levels(sent.value)
            for b in batches:
                yield pa.RecordBatch.from_arrays(judge(b, found), [*names, out])

        return d.mapInArrow(run, schema)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _levels(zip(*(right.column(c).to_pylist() for c in ("shard", "level", "data"))))
        return pa.table(judge(left, found), [*names, out])

    spread = d.select("*", F.pmod(F.col(one), F.lit(shards)).cast("int").alias(deal),
                      F.pmod(F.monotonically_increasing_id(), F.lit(COPIES)).cast("int").alias(copy))
    copies = filters.select(F.col("shard").alias(deal), "shard", "level", "data", F.explode(
        F.array(*[F.lit(i) for i in range(COPIES)])).alias(copy))
    return spread.groupBy(deal, copy).cogroup(copies.groupBy(deal, copy)).applyInArrow(join, schema)


def filter_urls(pages: DataFrame, block_list: DataFrame, rules: list[Rule], url_col: str = "url",
                key_col: str = "key", shard_keys: int = SHARD_KEYS, rate: float = FALSE_POSITIVES,
                max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of
    these names are replaced): the longest rule's verdict, else ``block`` for
    listed keys (host and path) and ``allow`` for all others.

    ``block_list`` has keys in ``key_col``; keys that no page has do no harm.
    Null urls and urls without ``://`` have an empty host and path, and fit no
    rule.  An empty list blocks nothing."""
    taken = ["host", "path", "rule", "verdict"]
    d = pages.drop(*taken)
    d = d.select("*", url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    key = F.concat("host", "path")
    universe = d.select(key.alias("_key"), F.lit(False).alias("_in")).unionByName(
        block_list.select(F.col(key_col).alias("_key"), F.lit(True).alias("_in")))
    filters = cascades(universe, "_key", "_in", shard_keys, rate)
    name, answer, best = free_names(d, "_key", "_listed", "_best")
    judged = listed(d.withColumn(name, key), name, filters, answer, max_broadcast)
    judged = judged.withColumn(best, longest_rule(F.col("host"), F.col("path"), rules))
    return judged.select(*d.columns, F.col(f"{best}.rule").alias("rule"), F.coalesce(
        F.col(f"{best}.verdict"), F.when(F.col(answer), "block").otherwise("allow")).alias("verdict"))
