"""T4/T5: byte-level BPE and WordPiece vocabularies trained as Spark jobs.

The corpus pass is ``word_counts`` (partial aggregation).  Training then
works on the *distinct-word* table ``(syms, freq)`` where ``syms`` holds the
current symbols of a word separated by single spaces.  Symbols are written as
lower-case hex of their UTF-8 bytes, so merges can be applied with plain
``regexp_replace`` without escaping; a WordPiece continuation symbol carries
a leading ``_`` (shown as ``##``).

Greedy training takes one merge at a time; a Spark job per merge would spend
its time starting jobs.  So each job tries many merges and the driver takes
those that greedy training would have taken:

* the driver holds the exact pair counts (the ``max_pairs`` most frequent, and
  a bound on all others);
* a ``Predictor`` plays greedy training on the ``predict_words`` most frequent
  words (a bounded number) and lists the merges it expects, with those that
  only earlier ones of the list make possible;
* one job replays the list on the distinct words and returns, per merge, how
  much it changes which pair counts, exactly and over all words;
* as long as the true maximum of the counts updated so far is in the list, the
  driver takes its merge and applies its changes.  Pairs that are nearly as frequent
  come in another order than expected: merges of the list change places as long as
  their occurrences do not overlap (``_swap``).  The rest is thrown away.

The first pair of a list is always right, so every job makes progress, and a
prediction only decides how much.  The output is that of sequential training,
ties by (count desc, left asc, right asc).  Merges are left to right,
non-overlapping: ``a a a`` + (a, a) -> ``aa a``.  Counts are recounted in full
only if a pair below the bound could come next.

Symbols are numbers in the table of words that jobs read (``CodedWords``).  A task
lays its words end to end (``SymbolChain``) and finds the places of a pair by a sorted
index, so a merge costs what it changes, not a pass over the words.  The merges taken
since the table was written are replayed first; it is written anew when they have
become many, without the words that are one symbol by then.
"""

from __future__ import annotations

import heapq
from collections import Counter
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import SPECIAL_TOKENS, byte_level_tokens, normalize_text_col, word_tokens
from textloom.session import checkpoint_dir, scratch_path
from textloom.sources.artifacts import delete_path

CONT = "_"  # continuation marker inside symbol strings (displayed as "##")


def byte_symbols(c) -> F.Column:
    """'hi' -> '68 69' (one symbol per UTF-8 byte)."""
    h = F.lower(F.hex(F.encode(c, "UTF-8")))
    return F.regexp_replace(h, F.lit("(..)(?!$)"), F.lit("$1 "))


def char_symbols(c) -> F.Column:
    """'hé' -> '68 _c3a9' (first char plain, later chars continuation)."""
    chars = F.split(c, "(?<=.)(?=.)", -1)
    hexed = F.transform(chars, lambda ch, i: F.when(i == 0, F.lower(F.hex(F.encode(ch, "UTF-8"))))
                        .otherwise(F.concat(F.lit(CONT), F.lower(F.hex(F.encode(ch, "UTF-8"))))))
    return F.array_join(hexed, " ")


def symbol_text(sym: str) -> str:
    """Display form of a symbol: bytes decoded as UTF-8 (replacement on error);
    continuation symbols get the ``##`` prefix."""
    cont = sym.startswith(CONT)
    raw = bytes.fromhex(sym[1:] if cont else sym).decode("utf-8", errors="replace")
    return ("##" if cont else "") + raw


def merged_symbol(left: str, right: str) -> str:
    return left + (right[1:] if right.startswith(CONT) else right)


def _merge(syms: list[str], left: str, right: str) -> list[str]:
    new, out, i = merged_symbol(left, right), [], 0
    while i < len(syms):
        if i + 1 < len(syms) and syms[i] == left and syms[i + 1] == right:
            out.append(new)
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


def replay(syms: list[str], places: dict[tuple[str, str], list[int]], merges: list[tuple[str, str]]
           ) -> Iterator[tuple[int, list[str], list[str]]]:
    """Apply ``merges`` in order to one word; yields ``(merge, before, after)``
    for every merge that changes it.  ``places`` has the positions of each pair."""
    at = -1
    while len(syms) > 1:
        coming = [i for p in set(zip(syms, syms[1:])) for i in places.get(p, ()) if i > at]
        if not coming:
            return
        at = min(coming)
        after = _merge(syms, *merges[at])
        yield at, syms, after
        syms = after


def _places(merges: list[tuple[str, str]]) -> dict[tuple[str, str], list[int]]:
    out: dict[tuple[str, str], list[int]] = {}
    for i, m in enumerate(merges):
        out.setdefault(m, []).append(i)
    return out


def apply_merges(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """``(syms, freq)`` after ``merges`` in order."""
    places = _places(merges)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for w in pdf["syms"]:
                syms = w.split(" ")
                for _, _, syms in replay(syms, places, merges):
                    pass
                out.append(" ".join(syms))
            yield pd.DataFrame({"syms": out, "freq": pdf["freq"]})
    return words.mapInPandas(run, "syms string, freq long")


def older_pairs(pairs: list[tuple[str, str]], merges: list[tuple[str, str]]) -> set[tuple[str, str]]:
    """Pairs of which a word held at least one before ``merges`` if it holds one
    of ``pairs`` after them.  A symbol may have been there before, or been made
    in several ways; all of them count."""
    made: dict[str, list[tuple[str, str]]] = {}
    for m in merges:
        made.setdefault(merged_symbol(*m), []).append(m)
    found, todo = set(), list(pairs)
    while todo:
        p = todo.pop()
        if p not in found:
            found.add(p)
            todo += [m for s in p for m in made.get(s, ())]
    return found


#: symbols that a task lays end to end at once
_CHAIN = 1 << 21
_GAP, _GONE = -1, -2
_USUAL = 12


def _code(left, right):
    return np.int64(left) << np.int64(32) | np.int64(right)


def _summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their weights, exact in 64 bits."""
    if not len(codes):
        return codes, weights
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(weights, first)


class SymbolChain:
    """Words of numbered symbols, end to end with gaps between them, as a linked list."""

    def __init__(self, words: pa.Array, freq: np.ndarray, wanted: np.ndarray | None = None):
        """``wanted``: sorted codes of the only pairs that will be asked for."""
        sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = words.flatten().to_numpy(zero_copy_only=False)
        at = np.arange(len(flat)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
        self.sym = np.full(len(flat) + len(sizes) + 1, _GAP, np.int32)
        self.sym[at] = flat
        self.word = np.zeros(len(self.sym), np.int32)
        self.word[at] = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.freq = freq
        self.after = np.arange(1, len(self.sym) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(self.sym) - 1, dtype=np.int32)
        self.wanted = wanted
        links = np.flatnonzero((self.sym[:-1] >= 0) & (self.sym[1:] >= 0))
        codes = self._codes(links)
        if wanted is not None:
            keep = self._is_wanted(codes)
            links, codes = links[keep], codes[keep]
        order = np.argsort(codes, kind="stable")
        self.codes, self.places = codes[order], links[order].astype(np.int32)
        self.made: dict[int, list[np.ndarray]] = {}  # places of pairs that merges made

    def _codes(self, links: np.ndarray) -> np.ndarray:
        return self.sym[links].astype(np.int64) << 32 | self.sym[self.after[links]].astype(np.int64)

    def _is_wanted(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.wanted):
            return np.zeros(len(codes), bool)
        return self.wanted[np.minimum(np.searchsorted(self.wanted, codes), len(self.wanted) - 1)] == codes

    def _weights(self, links: np.ndarray) -> np.ndarray:
        return self.freq[self.word[links]]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return _summed(self.codes, self._weights(self.places))

    def find(self, left: int, right: int) -> np.ndarray:
        code = _code(left, right)
        lo, hi = np.searchsorted(self.codes, [code, code + 1])
        at = [self.places[lo:hi], *self.made.get(int(code), ())]
        at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
        # places from before other merges may hold something else now
        return at[(self.sym[at] == left) & (self.sym[self.after[at]] == right)]

    def merge(self, left: int, right: int, new: int, effects: bool = True):
        """Merge in all words; codes of the pairs whose counts change, and by how much."""
        at = self.find(left, right)
        if left == right and len(at) > 1:  # of a run every second one
            start = np.append(True, self.after[at[:-1]] != at[1:])
            n = np.arange(len(at))
            at = at[(n - np.maximum.accumulate(np.where(start, n, 0))) % 2 == 0]
        if not len(at):
            return None
        gone = self.after[at]
        if effects:
            lost = np.unique(np.concatenate([self.before[at], at, gone]))
            lost = lost[(self.sym[lost] >= 0) & (self.sym[self.after[lost]] >= 0)]
            lost_codes, lost_weights = self._codes(lost), self._weights(lost)
        self.sym[at], self.sym[gone] = new, _GONE
        self.after[at] = self.after[gone]
        self.before[self.after[at]] = at
        links = np.unique(np.concatenate([self.before[at], at]))
        links = links[(self.sym[links] >= 0) & (self.sym[self.after[links]] >= 0)]
        codes = self._codes(links)
        noted, note = codes, links
        if self.wanted is not None:
            keep = self._is_wanted(codes)
            noted, note = codes[keep], links[keep]
        if len(noted):
            order = np.argsort(noted, kind="stable")
            noted, note = noted[order], note[order]
            cut = np.flatnonzero(noted[1:] != noted[:-1]) + 1
            for c, p in zip(noted[np.append(0, cut)].tolist(), np.split(note.astype(np.int32), cut)):
                self.made.setdefault(c, []).append(p)
        if not effects:
            return None
        codes, deltas = _summed(np.concatenate([lost_codes, codes]), np.concatenate([-lost_weights, self._weights(links)]))
        return codes[deltas != 0], deltas[deltas != 0]

    def state(self) -> tuple:
        return self.sym.copy(), self.after.copy(), self.before.copy()

    def words(self) -> pa.Array:
        alive = self.sym >= 0
        ends = np.append(0, np.cumsum(np.bincount(self.word[alive], minlength=len(self.freq))))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.sym[alive]))


class Symbols:
    """Numbers of the symbols, on the driver; bounded by the alphabet and the merges tried."""

    def __init__(self, names: list[str]):
        self.names, self.number = list(names), {s: i for i, s in enumerate(names)}

    def of(self, name: str) -> int:
        if name not in self.number:
            self.number[name] = len(self.names)
            self.names.append(name)
        return self.number[name]

    def triple(self, pair: tuple[str, str]) -> tuple[int, int, int]:
        return self.of(pair[0]), self.of(pair[1]), self.of(merged_symbol(*pair))

    def pair(self, code: int) -> tuple[str, str]:
        return self.names[code >> 32], self.names[code & 0xFFFFFFFF]


def _chains(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None,
            pairs: np.ndarray | None = None) -> Iterator[SymbolChain]:
    """The words of a task, ``_CHAIN`` symbols at a time; with ``pairs`` only those that hold one."""
    held, n = [], 0

    def chain():
        t = pa.Table.from_batches(held).combine_chunks()
        words, freq = t.column("syms").combine_chunks(), t.column("freq").combine_chunks()
        if pairs is not None:
            keep = pa.array(_holding(words, pairs))
            words, freq = words.filter(keep), freq.filter(keep)
        return SymbolChain(words, freq.to_numpy(), wanted)

    for b in batches:
        held.append(b)
        n += len(b.column("syms").flatten())
        if n >= _CHAIN:
            yield chain()
            held, n = [], 0
    if held:
        yield chain()


def _holding(words: pa.Array, pairs: np.ndarray) -> np.ndarray:
    """Which words (of two symbols or more) hold one of the pairs (sorted codes)."""
    at = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(pairs) or not len(flat):
        return np.zeros(len(words), bool)
    codes = flat[:-1] << 32 | flat[1:]
    hit = pairs[np.minimum(np.searchsorted(pairs, codes), len(pairs) - 1)] == codes
    total = np.append(0, np.cumsum(hit))
    return total[at[1:] - 1] > total[at[:-1]]


class CodedWords:
    """The distinct words with numbers for symbols, written below the checkpoint folder."""

    def __init__(self, words: DataFrame, n_parts: int):
        self.spark, self.n_parts = words.sparkSession, n_parts
        self.path = scratch_path(self.spark, "bpe")
        plain = f"{self.path}-text"
        words.filter(F.instr("syms", " ") > 0).repartition(n_parts).write.parquet(plain)
        text = self.spark.read.parquet(plain)
        # distinct symbols: bounded by the character set, not the corpus
        names = sorted(r["s"] for r in text.select(F.explode(F.split("syms", " ")).alias("s")).distinct().collect())
        self.symbols, of = Symbols(names), pa.array(names, pa.string())

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                syms = pc.split_pattern(b.column("syms").cast(pa.string()), " ")
                numbers = pc.index_in(syms.flatten(), value_set=of)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pc.subtract(syms.offsets, syms.offsets[0]), numbers), b.column("freq")], ["syms", "freq"])

        text.select("syms", "freq").mapInArrow(code, "syms array<int>, freq long").write.parquet(self.path)
        delete_path(self.spark, plain)
        self.words = self.spark.read.parquet(self.path)

    def rebase(self, merges: list[tuple[str, str]]) -> None:
        triples, old = [self.symbols.triple(m) for m in merges], self.path
        wanted = np.unique(np.array([x << 32 | y for x, y, _ in triples], np.int64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chain in _chains(batches, wanted):
                for t in triples:
                    chain.merge(*t, effects=False)
                words = chain.words()
                keep = pc.greater(pc.list_value_length(words), 1)  # a word of one symbol never forms a pair again
                yield pa.RecordBatch.from_arrays([words.filter(keep), pa.array(chain.freq).filter(keep)], ["syms", "freq"])

        self.path = scratch_path(self.spark, "bpe")
        self.words.mapInArrow(run, "syms array<int>, freq long").write.parquet(self.path)
        self.words = self.spark.read.parquet(self.path)
        delete_path(self.spark, old)

    def drop(self) -> None:
        delete_path(self.spark, self.path)

    def pair_counts(self) -> DataFrame:
        """``(code, count)`` of adjacent symbols, weighted by word frequency."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chain in _chains(batches):
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in chain.counts()], ["code", "count"])
        return self.words.mapInArrow(run, "code long, count long").groupBy("code").agg(F.sum("count").alias("count"))


def merge_effects(table: CodedWords, done: list[tuple[str, str]], tried: list[tuple[str, str]]) -> DataFrame:
    """``(step, code, delta)``: by how much each of ``tried``, applied in order after
    ``done``, changes the count of a pair; at step -1 the number of words that were replayed."""
    of, n_done = table.symbols, len(done)
    triples = [of.triple(m) for m in done + tried]
    wanted = np.unique(np.array([x << 32 | y for x, y, _ in triples], np.int64))
    roots = np.unique(np.array([of.of(x) << 32 | of.of(y) for x, y in older_pairs(tried, done + tried)], np.int64))
    schema = ["step", "code", "delta"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chain in _chains(batches, wanted, roots):
            steps, codes, deltas = [np.array([-1])], [np.array([0])], [np.array([len(chain.freq)])]
            for i, t in enumerate(triples):
                found = chain.merge(*t, effects=i >= n_done)
                if found is not None:
                    steps.append(np.full(len(found[0]), i - n_done))
                    codes.append(found[0])
                    deltas.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(steps), pa.int32()), pa.array(np.concatenate(codes), pa.int64()),
                 pa.array(np.concatenate(deltas), pa.int64())], schema)

    return (table.words.mapInArrow(run, "step int, code long, delta long")
            .groupBy("step", "code").agg(F.sum("delta").alias("delta")).filter("delta <> 0"))


def _adjacent(symbols):
    """Array of the adjacent pairs of a column of symbols (not an expression,
    which a lambda would evaluate per element)."""
    return F.arrays_zip(F.slice(symbols, 1, F.size(symbols) - 1).alias("left"),
                        F.slice(symbols, 2, F.size(symbols) - 1).alias("right"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent symbol pairs weighted by word frequency."""
    arr = F.col("_tl_a")
    return (words.select(F.split(F.col("syms"), " ").alias("_tl_a"), "freq")
            .filter(F.size(arr) > 1)
            .select(F.explode(_adjacent(arr)).alias("p"), "freq")
            .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
            .agg(F.sum("freq").cast("long").alias("count")))


class PairTable:
    """Exact counts of the most frequent pairs; ``floor`` bounds all others."""

    def __init__(self, table: CodedWords, max_pairs: int):
        rows = table.pair_counts().orderBy(F.desc("count"), "code").limit(max_pairs + 1).collect()
        self.floor = int(rows[max_pairs]["count"]) if len(rows) > max_pairs else 0
        self.counts = {table.symbols.pair(r["code"]): int(r["count"]) for r in rows[:max_pairs]}
        self.heap = [(-c, *p) for p, c in self.counts.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[tuple[str, str], int] | None:
        """The most frequent pair, if it is surely above all that are not held."""
        while self.heap:
            c, x, y = self.heap[0]
            if self.counts.get((x, y)) == -c:
                return ((x, y), -c) if -c > self.floor else None
            heapq.heappop(self.heap)
        return None

    def next_in_line(self, n: int, least: int) -> list[tuple[str, str]]:
        least = max(least, self.floor + 1)
        return [p[1:] for p in heapq.nsmallest(n, ((-c, *p) for p, c in self.counts.items() if c >= least))]

    def change(self, effects: list[tuple[str, str, int]], new_symbol: str | None) -> bool:
        """Apply a merge's effects; false if a pair's count is no longer known.
        ``new_symbol`` is the merge's result if no earlier merge made it: its
        pairs had no count before."""
        sure = True
        for x, y, d in effects:
            if (x, y) in self.counts or self.floor == 0 or new_symbol in (x, y):
                c = self.counts.get((x, y), 0) + d
                if c:
                    self.counts[x, y] = c
                    heapq.heappush(self.heap, (-c, x, y))
                else:
                    self.counts.pop((x, y), None)
            elif d > 0:
                sure = False
        return sure


class Predictor:
    """Greedy training on the ``limit`` most frequent words, one list ahead of
    the exact counts.  With all words among them its lists come true.

    Words of ``_USUAL`` symbols are meant; of shorter ones more go into the same room."""

    def __init__(self, table: CodedWords, limit: int):
        size = table.words.agg(F.count(F.lit(1)), F.sum(F.size("syms"))).first()
        limit = int(limit * max(1.0, _USUAL * size[0] / (size[1] or 1)))
        rows = table.words.orderBy(F.desc("freq"), "syms").limit(limit).toArrow()
        words = rows.column("syms").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
        self.symbols = table.symbols
        self.chain = SymbolChain(words, rows.column("freq").to_numpy())
        self._before = self.chain.state()

    def play(self, pairs: PairTable, n: int, least: int) -> list[tuple[str, str]]:
        """Up to ``n`` merges that should come next; they stay applied."""
        ahead, at = pairs.next_in_line(4 * n, least), 0
        now: dict[tuple[str, str], int] = {}  # expected counts that differ from the exact ones
        heap: list[tuple[int, str, str]] = []
        out: list[tuple[str, str]] = []
        self._before = self.chain.state()
        while len(out) < n:
            while at < len(ahead) and ahead[at] in now:
                at += 1
            while heap and now[heap[0][1:]] != -heap[0][0]:
                heapq.heappop(heap)
            if at == len(ahead):
                break
            best = (-pairs.counts[ahead[at]], *ahead[at])
            if heap and heap[0] < best:
                best = heap[0]
            pair = best[1:]
            out.append(pair)
            for p, c in self._apply(pair, -best[0]).items():
                now[p] = now.get(p, pairs.counts.get(p, 0)) + c
                if now[p] > 0 and p != pair:
                    heapq.heappush(heap, (-now[p], *p))
            now[pair] = 0
        return out

    def _apply(self, pair: tuple[str, str], count: int) -> dict[tuple[str, str], int]:
        """Merge in all words; the changes, as large as ``count`` lets expect."""
        found = self.chain.merge(*self.symbols.triple(pair))
        if found is None:
            return {}
        delta = {self.symbols.pair(c): d for c, d in zip(found[0].tolist(), found[1].tolist())}
        here = -delta.get(pair, 0)
        if here and here != count:
            return {p: round(d * count / here) for p, d in delta.items()}
        return delta

    def keep(self, taken: list[tuple[str, str]], played: list[tuple[str, str]]) -> None:
        """Take back all of the merges ``played`` last but those ``taken``, in that order."""
        if taken == played:
            return
        # places noted by what is taken back are checked when they are asked for
        self.chain.sym, self.chain.after, self.chain.before = self._before
        for pair in taken:
            self.chain.merge(*self.symbols.triple(pair), effects=False)


def _swap(q: tuple[str, str], p: tuple[str, str], of_q: dict, of_p: dict, known: set[str]) -> bool:
    """Turn the effects of ``q``, then ``p`` into those of ``p``, then ``q``; false if that
    needs the words.  ``known``: symbols that may have been there before ``q``.

    Where occurrences only touch, the words end up the same, and which of the two merges
    sees the other's symbol or its part can be told from the counts of the touching pairs."""
    (a, b), (c, d), zq, zp = q, p, merged_symbol(*q), merged_symbol(*p)
    if p == q or b == c or d == a or zq == zp or zq in p or zp in q or zq in known:
        return False
    for touching, apart_, made, part in (((zq, c), (b, c), (zq, zp), (b, zp)), ((d, zq), (d, a), (zp, zq), (zp, a))):
        n = -of_p.get(touching, 0)
        if n:
            for effects, k in ((of_p, n), (of_q, -n)):
                for pair, change in ((touching, k), (apart_, -k), (made, -k), (part, k)):
                    effects[pair] = effects.get(pair, 0) + change
    return True


def _merge_loop(spark: SparkSession, words: DataFrame, n_merges: int, min_frequency: int,
                max_pairs: int, predict_words: int = 500_000, n_try: int = 128,
                rebase_every: int = 512, report: list | None = None) -> list[tuple[str, str, int]]:
    checkpoint_dir(spark)
    least = max(min_frequency, 1)
    table = CodedWords(words, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = PairTable(table, max_pairs)
    predictor = Predictor(table, predict_words)
    merges: list[tuple[str, str, int]] = []
    made, alphabet = set(), set(table.symbols.names)
    pending: list[tuple[str, str]] = []  # taken, not yet in the table
    while len(merges) < n_merges:
        best = pairs.best()
        if best is None or best[1] < least:
            if pairs.floor < least:  # nothing frequent enough is left anywhere
                break
            table.rebase(pending)
            pending, pairs, predictor = [], PairTable(table, max_pairs), Predictor(table, predict_words)
            if pairs.best() is None:
                # all of the held pairs are as frequent as the first left out: hold more
                max_pairs *= 2
                pairs = PairTable(table, max_pairs)
            continue
        tried = predictor.play(pairs, min(n_try, n_merges - len(merges)), least)
        n_words, effects = 0, [{} for _ in tried]
        rows = merge_effects(table, pending, tried).toArrow()  # the neighbours of `tried`
        for step, code, delta in zip(*(rows.column(c).to_pylist() for c in ("step", "code", "delta"))):
            if step < 0:
                n_words = delta
            else:
                effects[step][table.symbols.pair(code)] = delta
        left, taken, sure = list(range(len(tried))), [], True
        places, products = _places(tried), Counter(merged_symbol(*m) for m in tried)
        known = made | alphabet | {s for s, n in products.items() if n > 1}
        while sure and left:
            best = pairs.best()
            if best is None or best[1] < least or not places.get(best[0]):
                break
            pair, i = best[0], places[best[0]][0]
            at = left.index(i)
            if not all(_swap(tried[j], pair, effects[j], effects[i], known) for j in reversed(left[:at])):
                break  # the effects are thrown away
            del left[at], places[pair][0]
            symbol = merged_symbol(*pair)
            merges.append((*pair, best[1]))
            pending.append(pair)
            sure = pairs.change([(*p, n) for p, n in effects[i].items() if n], symbol if symbol not in made else None)
            made.add(symbol)
            taken.append(pair)
        predictor.keep(taken, tried)
        if report is not None:
            report.append({"tried": len(tried), "taken": len(taken), "words": n_words})
        n_try = min(1024, max(128, 4 * len(taken)))
        if not sure or (len(pending) >= max(rebase_every, len(merges) // 2) and len(merges) < n_merges):
            table.rebase(pending)
            pending, predictor = [], Predictor(table, predict_words)  # words that are one symbol make room for others
            if not sure:
                pairs = PairTable(table, max_pairs)
    table.drop()
    return merges


MERGES_SCHEMA = T.StructType([T.StructField("rank", T.IntegerType()),
                              T.StructField("left", T.StringType()),
                              T.StructField("right", T.StringType()),
                              T.StructField("count", T.LongType())])
VOCAB_SCHEMA = T.StructType([T.StructField("id", T.IntegerType()),
                             T.StructField("piece", T.StringType()),
                             T.StructField("text", T.StringType()),
                             T.StructField("special", T.BooleanType())])


def _tables(spark, specials, alphabet, merges):
    vocab = [(i, s, s, True) for i, s in enumerate(specials)]
    for sym in alphabet:
        vocab.append((len(vocab), sym, symbol_text(sym), False))
    for l, r, _ in merges:
        m = merged_symbol(l, r)
        vocab.append((len(vocab), m, symbol_text(m), False))
    mrows = [(i, l, r, c) for i, (l, r, c) in enumerate(merges)]
    return (spark.createDataFrame(vocab, VOCAB_SCHEMA),
            spark.createDataFrame(mrows, MERGES_SCHEMA))


def train_bpe(texts: DataFrame, vocab_size: int = 8000, text_col: str = "text",
              special_tokens=tuple(SPECIAL_TOKENS[1:]), min_frequency: int = 2,
              max_pairs: int = 200_000, predict_words: int = 500_000,
              report: list | None = None) -> tuple[DataFrame, DataFrame]:
    """T4: byte-level BPE.  Returns ``(vocab, merges)``.

    ``max_pairs`` bounds the pair counts that the driver holds and
    ``predict_words`` the words it predicts merges from; they change how many
    jobs it takes, not the result.  ``report`` gets, per job, the merges tried
    and taken and the words read.

    Vocabulary: special tokens, then the 256 byte symbols, then one symbol
    per merge in merge order.  Pre-tokenisation is the byte-level split."""
    spark = texts.sparkSession
    words = (texts.select(F.explode(byte_level_tokens(F.col(text_col))).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).cast("long").alias("freq"))
             .select(byte_symbols(F.col("w")).alias("syms"), "freq"))
    alphabet = [f"{b:02x}" for b in range(256)]
    n_merges = max(0, vocab_size - len(special_tokens) - len(alphabet))
    merges = _merge_loop(spark, words, n_merges, min_frequency, max_pairs, predict_words, report=report)
    return _tables(spark, list(special_tokens), alphabet, merges)


def train_wordpiece(texts: DataFrame, vocab_size: int = 8000, text_col: str = "text",
                    lower_case: bool = True, special_tokens=tuple(SPECIAL_TOKENS),
                    min_frequency: int = 0, max_pairs: int = 200_000, predict_words: int = 500_000,
                    report: list | None = None) -> tuple[DataFrame, DataFrame]:
    """T5: the same merge loop on characters with a ``##`` continuation prefix,
    after NFD / optional lower-case / accent stripping and the whitespace
    pre-tokenizer.  Vocabulary: specials, the sorted alphabet (plain and
    continuation forms as seen), then merges."""
    spark = texts.sparkSession
    norm = normalize_text_col(F.col(text_col), lower=lower_case, strip_accents=True)
    words = (texts.select(F.explode(word_tokens(norm)).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).cast("long").alias("freq"))
             .select(char_symbols(F.col("w")).alias("syms"), "freq"))
    checkpoint_dir(spark)
    words = words.checkpoint(eager=True)
    # alphabet: distinct symbols -- bounded by the character set, not the corpus
    alphabet = sorted(r["s"] for r in words.select(F.explode(F.split("syms", " ")).alias("s"))
                      .distinct().collect())
    n_merges = max(0, vocab_size - len(special_tokens) - len(alphabet))
    merges = _merge_loop(spark, words, n_merges, min_frequency, max_pairs, predict_words, report=report)
    return _tables(spark, list(special_tokens), alphabet, merges)
