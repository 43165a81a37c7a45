"""Unigram-LM vocabulary trained by EM as Spark jobs.

* normalisation: NFKC and runs of white space to one, as the library's default;
* seeds: every character, and the ``seed_size`` best by frequency x length of the
  substrings (at most ``max_piece_len`` characters) that go on in two ways on both
  sides: the others always stand inside a longer one.  They come from the sorted
  suffixes of the distinct words, one row per suffix instead of one per substring
  (``substring_seeds``);
* E-step: forward-backward over each distinct word's piece lattice in
  ``mapInPandas`` (piece log-probabilities as a broadcast variable, bounded by
  the seed size) emitting expected piece counts; thousands of words at once, by
  numpy (``Pieces``), long words one by one;
* M-step: ``groupBy(piece).sum``, then ``digamma(count) - digamma(total)``, which takes
  more from rare pieces than from frequent ones; pieces other than characters go below
  an expected count of 0.5;
* prune: loss of removing a piece = its Viterbi usage x (its log-prob - the
  log-prob of the best segmentation of the piece without it); keep the
  highest-loss share each round.  Characters are never pruned, so every word
  keeps a path; with more characters than ``vocab_size`` allows, the vocabulary
  is the special tokens and all characters.

Words are whitespace-separated chunks with a leading ``▁`` (metaspace).
"""

from __future__ import annotations

import copy
import math
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import SPECIAL_TOKENS, nfkc_chunk_counts
from textloom.session import checkpoint_dir

METASPACE = "▁"
#: expected count below which a longer piece goes, and that a character has at least
LEAST_COUNT = 0.5
_COUNTS = T.StructType([T.StructField("i", T.LongType()),  # number of the piece
                        T.StructField("ex", T.DoubleType()),
                        T.StructField("vit", T.DoubleType())])


def _lse(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    if b == -math.inf:
        return a
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def lattice(word: str, logp: dict, max_len: int) -> list[tuple[int, int, str, float]]:
    """``(from, to, piece, log-prob)`` of every piece in a word, by their end."""
    return [(s, e, p, logp[p]) for e in range(1, len(word) + 1) for s in range(max(0, e - max_len), e)
            if (p := word[s:e]) in logp]


def expected_uses(n: int, edges: list[tuple[int, int, str, float]]) -> list[float] | None:
    """Posterior probability of every edge; None if no path covers the word."""
    alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    probs = [math.exp(lp) for *_, lp in edges]
    for (s, e, _, _), p in zip(edges, probs):
        alpha[e] += alpha[s] * p
    if 1e-280 < alpha[n] < math.inf:
        for (s, e, _, _), p in sorted(zip(edges, probs), key=lambda x: -x[0][0]):
            beta[s] += p * beta[e]
        return [alpha[s] * p * beta[e] / alpha[n] for (s, e, _, _), p in zip(edges, probs)]
    # a long word leaves the range of doubles: the same in logarithms
    alpha, beta = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
    for s, e, _, lp in edges:
        alpha[e] = _lse(alpha[e], alpha[s] + lp)
    if alpha[n] == -math.inf:
        return None
    for s, e, _, lp in sorted(edges, key=lambda x: -x[0]):
        beta[s] = _lse(beta[s], lp + beta[e])
    return [math.exp(alpha[s] + lp + beta[e] - alpha[n]) for s, e, _, lp in edges]


def best_path(n: int, edges: list[tuple[int, int, str, float]]) -> list[str]:
    """Pieces of the most probable segmentation; of equal ones the first found."""
    best, back = [0.0] + [-math.inf] * n, [(0, "")] * (n + 1)
    for s, e, p, lp in edges:
        if best[s] + lp > best[e]:
            best[e], back[e] = best[s] + lp, (s, p)
    out, at = [], n
    while at > 0:
        at, p = back[at]
        out.append(p)
    return out


def substring_counts(words: DataFrame, max_len: int) -> DataFrame:
    """``(piece, c)``: how often each substring of 1 to ``max_len`` characters stands in
    the words of ``words(word, n)``.  Words are counted by batches: the substrings of a
    length are numbered by those one shorter and the character that follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("word").to_pylist()
            text, lengths = "".join(names), np.array([len(w) for w in names], np.int64)
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
            freq, left = np.repeat(b.column("n").to_numpy(), lengths), np.repeat(np.cumsum(lengths), lengths) - np.arange(len(code))
            at, ids = np.arange(len(code)), np.zeros(len(code), np.int64)
            for k in range(1, max_len + 1):
                here = left[at] >= k
                at, ids = at[here], ids[here]
                if not len(at):
                    break
                _, first, ids = np.unique(ids << 21 | code[at + k - 1], return_index=True, return_inverse=True)
                total = np.zeros(len(first), np.int64)
                np.add.at(total, ids, freq[at])
                yield pa.RecordBatch.from_arrays([pa.array([text[i:i + k] for i in at[first].tolist()], pa.string()), pa.array(total)],
                                                 ["piece", "c"])

    return words.select("word", "n").mapInArrow(run, "piece string, c long").groupBy("piece").agg(F.sum("c").alias("c"))


class _Path:
    """Counts of all prefixes of the suffix that is being read."""

    def __init__(self, size: int):
        self.c, self.starts, self.ends = [0] * size, [0] * size, [0] * size
        self.left, self.right = [set() for _ in range(size)], [set() for _ in range(size)]

    def clear(self, d: int) -> None:
        self.c[d] = self.starts[d] = self.ends[d] = 0
        self.left[d], self.right[d] = set(), set()

    def add(self, d: int, freq: int, starts: int, left, right: str) -> None:
        """``freq`` occurrences that go on with ``right`` (empty: the word ends)."""
        self.c[d] += freq
        self.starts[d] += starts
        self.ends[d] += freq if not right else 0
        if len(self.left[d]) < 2:
            self.left[d].update(left)
        if len(self.right[d]) < 2:
            self.right[d].add(right)

    def is_seed(self, d: int) -> bool:
        return (len(self.left[d]) > 1 or self.starts[d] > 1) and (len(self.right[d]) > 1 or self.ends[d] > 1)


def substring_seeds(words: DataFrame, max_len: int) -> DataFrame:
    """``(piece, c)`` of the substrings of 2 to ``max_len`` characters of ``words(word,
    freq)`` that have two different characters, or twice an end of the word, on each side.

    Suffixes (cut after ``max_len`` characters and the one that follows) with the same
    three first characters are read in sorted order; the prefixes of a suffix that the
    next one does not share are complete then.  A task holds one suffix at a time."""
    at = words.select("word", "freq", F.posexplode(F.sequence(F.lit(1), F.length("word"))).alias("_", "i"))
    suffix = F.substr(F.col("word"), F.col("i"), F.lit(max_len + 1))
    left = F.when(F.col("i") > 1, F.substr(F.col("word"), F.col("i") - 1, F.lit(1))).otherwise(F.lit(""))
    rows = at.select(suffix.alias("s"), left.alias("l"), "freq").filter(F.length("s") > 1).groupBy("s").agg(
        F.sum("freq").alias("f"), F.sum(F.when(F.col("l") == "", F.col("freq")).otherwise(0)).alias("starts"),
        F.min("l").alias("l0"), F.max("l").alias("l1"))
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # of two characters: their own group, since they begin in many of three
    two = rows.select(F.substring("s", 1, 2).alias("piece"), F.substring("s", 3, 1).alias("r"), "f", "starts", "l0", "l1")
    two = two.groupBy("piece").agg(
        F.sum("f").alias("c"), F.sum("starts").alias("starts"), F.min("l0").alias("l0"), F.max("l1").alias("l1"),
        F.min("r").alias("r0"), F.max("r").alias("r1"), F.sum(F.when(F.col("r") == "", F.col("f")).otherwise(0)).alias("ends"))
    two = two.filter(((F.col("l0") != F.col("l1")) | (F.col("starts") > 1)) & ((F.col("r0") != F.col("r1")) | (F.col("ends") > 1)))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, last = _Path(max_len + 1), ""
        for pdf in it:
            found = []

            def close(down_to: int):
                for d in range(min(len(last), max_len), down_to, -1):
                    if path.is_seed(d):
                        found.append((last[:d], path.c[d]))
                    path.clear(d)

            for s, f, starts, l0, l1 in zip(pdf["s"], pdf["f"], pdf["starts"], pdf["l0"], pdf["l1"]):
                same = 0
                while same < min(len(s), len(last)) and s[same] == last[same]:
                    same += 1
                close(max(2, same))
                for d in range(3, min(len(s), max_len) + 1):
                    path.add(d, f, starts, (l0, l1), s[d:d + 1])
                last = s
            yield pd.DataFrame(found, columns=["piece", "c"])
        # the last suffix of the task
        found = [(last[:d], path.c[d]) for d in range(3, min(len(last), max_len) + 1) if path.is_seed(d)]
        yield pd.DataFrame(found, columns=["piece", "c"])

    # suffixes of two characters have no longer prefix; without a filter here both read one shuffle
    longer = (rows.repartition(n, F.substring("s", 1, 3)).sortWithinPartitions("s")
              .mapInPandas(run, "piece string, c long"))
    return two.select("piece", F.col("c").cast("long").alias("c")).unionByName(longer)


def best_seeds(seeds: DataFrame, n: int, room: int = 2) -> pa.Table:
    """The ``n`` best of ``seeds(piece, c)``, by frequency x length and then by piece;
    pieces must differ.

    A sort with a limit sends the best of every task to the driver.  Here a histogram of
    the scores, 64 steps a doubling, tells where the ``n`` best end, and the driver takes the
    rows up to there.  Where they are more than ``room`` times ``n`` (equal scores), they
    are sorted by ranges first, and it takes the first ranges."""
    if n <= 0:
        return pa.table({"piece": pa.array([], pa.string()), "c": pa.array([], pa.int64())})
    scored = seeds.select("piece", "c", (F.col("c") * F.length("piece")).alias("v")).withColumn(
        "f", F.floor(64 * F.log2("v"))).checkpoint(eager=True)
    rows, least = 0, None
    for r in sorted(scored.groupBy("f").count().collect(), reverse=True):
        rows, least = rows + r["count"], r["f"]
        if rows >= n:
            break
    some = scored.filter(F.lit(least is not None) & (F.col("f") >= F.lit(least))).drop("f")
    if rows > room * n:
        parts = max(int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // n))
        some = some.repartitionByRange(parts, F.desc("v"), "piece").withColumn("p", F.spark_partition_id()).checkpoint(eager=True)
        held, last = 0, 0
        for r in sorted(some.groupBy("p").count().collect()):
            held, last = held + r["count"], r["p"]
            if held >= n:
                break
        some = some.filter(F.col("p") <= last).drop("p")
    return some.toArrow().sort_by([("v", "descending"), ("piece", "ascending")]).slice(0, n).select(["piece", "c"])


def digamma(x: float) -> float:
    out = 0.0
    while x < 7:
        out, x = out - 1 / x, x + 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


#: words at once, and the longest of them; longer ones leave the range of doubles
_BATCH, _LONGEST = 8192, 64


class Pieces:
    """A trie in arrays, which all places of many words walk in step.  Built once for many
    models: ``scored`` leaves out pieces that a model no longer has."""

    def __init__(self, names, max_len: int):
        self.names, self.max_len = sorted(names), max_len
        sizes = np.array([len(p) for p in self.names], np.int64)
        chars = np.frombuffer("".join(self.names).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start, node = np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.int64)
        keys, piece = [], [np.array([-1])]
        for d in range(int(sizes.max(initial=0))):  # the nodes of a depth, from those above and a character
            live = np.flatnonzero(sizes > d)
            new, at = np.unique(node[live] << 21 | chars[start[live] + d], return_inverse=True)
            node[live] = 1 + sum(map(len, keys)) + at
            ends = sizes[live] == d + 1
            named = np.full(len(new), -1)
            named[at[ends]] = live[ends]
            keys.append(new)
            piece.append(named)
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], 1 + order
        self.piece, self.score, self._plain = np.concatenate(piece), np.full(len(self.names), -np.inf), None

    def scores(self, logp: dict[str, float]) -> np.ndarray:
        return np.array([logp.get(p, -math.inf) for p in self.names])

    def scored(self, score: np.ndarray) -> "Pieces":
        out = copy.copy(self)
        out.score, out._plain = score, None
        return out

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``word, from, to, piece`` of all edges in the order of ``lattice`` inside each
        ``to``, and the lengths of the words."""
        sizes = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room, at = sizes[word] - start, np.arange(len(chars))  # `at`: places that still walk
        node, found = np.zeros(len(chars), np.int64), []
        for d in range(min(self.max_len, int(sizes.max(initial=0)))):
            live = room[at] > d
            at, node = at[live], node[live]
            if not len(at) or not len(self.keys):
                break
            key = node << 21 | chars[at + d]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[i] == key
            at, node = at[hit], self.to[i[hit]]
            p = self.piece[node]
            ends = (p >= 0) & (self.score[p] > -np.inf)
            found.append((at[ends], np.full(ends.sum(), d + 1), p[ends]))
        place, length, piece = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
        order = np.lexsort((place, start[place] + length))
        place, length, piece = place[order], length[order], piece[order]
        return word[place], start[place], start[place] + length, piece, sizes

    def uses(self, words: list[str], freq: np.ndarray, ex: np.ndarray, vit: np.ndarray) -> None:
        """Add the expected uses and those of the best path of every word."""
        word, s, e, piece, sizes = self.edges(words)
        n, width = len(words), int(sizes.max(initial=0)) + 1
        lp = self.score[piece]
        prob = np.exp(lp)
        alpha, beta = np.zeros((n, width)), np.zeros((n, width))
        best, back = np.full((n, width), -np.inf), np.full((n, width), -1)
        alpha[:, 0], best[:, 0] = 1.0, 0.0
        cuts = np.searchsorted(e, np.arange(width + 1))
        for t in range(1, width):
            g = slice(cuts[t], cuts[t + 1])
            alpha[:, t] = np.bincount(word[g], alpha[word[g], s[g]] * prob[g], n)
            total = best[word[g], s[g]] + lp[g]
            np.maximum.at(best[:, t], word[g], total)
            # of equal ones the first found: written last
            first = np.flatnonzero((total == best[word[g], t]) & (total > -np.inf))[::-1]
            back[word[g][first], t] = cuts[t] + first
        beta[np.arange(n), sizes] = 1.0
        by_start = np.argsort(s, kind="stable")
        cuts = np.searchsorted(s[by_start], np.arange(width + 1))
        for t in range(width - 2, -1, -1):
            g = by_start[cuts[t]:cuts[t + 1]]
            beta[:, t] += np.bincount(word[g], prob[g] * beta[word[g], e[g]], n)
        whole = alpha[np.arange(n), sizes]
        sure = (whole > 1e-280) & (whole < np.inf)
        ok = sure[word]
        with np.errstate(divide="ignore", invalid="ignore"):
            posterior = alpha[word, s] * prob * beta[word, e] / whole[word]
        np.add.at(ex, piece[ok], (freq[word] * posterior)[ok])
        at, rows = sizes.copy(), np.flatnonzero(sure)
        while len(rows):
            edge = back[rows, at[rows]]
            np.add.at(vit, piece[edge], freq[rows])
            at[rows] = s[edge]
            rows = rows[at[rows] > 0]
        for i in np.flatnonzero(~sure):
            self.use(words[i], freq[i], ex, vit)

    def use(self, word: str, f: float, ex: np.ndarray, vit: np.ndarray) -> None:
        """The same for a word alone, of any length."""
        if self._plain is None:
            held = np.flatnonzero(self.score > -np.inf).tolist()
            self._plain = {self.names[i]: float(self.score[i]) for i in held}, {self.names[i]: i for i in held}
        logp, number = self._plain
        edges = lattice(word, logp, self.max_len)
        uses = expected_uses(len(word), edges)
        if uses is None:
            raise ValueError(f"no pieces cover {word!r}")  # characters are always kept
        for (_, _, p, _), u in zip(edges, uses):
            ex[number[p]] += f * u
        for p in best_path(len(word), edges):
            vit[number[p]] += f


def _estep(trie, score):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = trie.value.scored(score.value)
        ex, vit = np.zeros(len(pieces.names)), np.zeros(len(pieces.names))
        for pdf in it:
            size = pdf["word"].str.len()
            for w, f in zip(pdf["word"][size > _LONGEST], pdf["freq"][size > _LONGEST]):
                pieces.use(w, float(f), ex, vit)
            short = pdf[size <= _LONGEST]
            for at in range(0, len(short), _BATCH):
                some = short.iloc[at:at + _BATCH]
                pieces.uses(some["word"].tolist(), some["freq"].to_numpy(float), ex, vit)
        seen = np.flatnonzero((ex > 0) | (vit > 0))
        yield pd.DataFrame({"i": seen, "ex": ex[seen], "vit": vit[seen]})
    return run


def _alt_score(model, max_len: int):
    """Best log-prob of a piece segmented without using the piece itself."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logp = model.value
        for pdf in it:
            alts = []
            for w in pdf["piece"]:
                n = len(w)
                best = [0.0] + [-math.inf] * n
                for e in range(1, n + 1):
                    for s in range(max(0, e - max_len), e):
                        if s == 0 and e == n:
                            continue
                        lp = logp.get(w[s:e])
                        if lp is not None and best[s] + lp > best[e]:
                            best[e] = best[s] + lp
                alts.append(best[n])
            yield pd.DataFrame({"piece": pdf["piece"], "alt": alts})
    return run


def train_unigram(texts: DataFrame, vocab_size: int = 8000, text_col: str = "text",
                  special_tokens=tuple(SPECIAL_TOKENS), max_piece_len: int = 16,
                  seed_size: int = 200_000, shrink: float = 0.75, em_iters: int = 2) -> DataFrame:
    """Returns the vocabulary ``(id, piece, text, special, score)``: specials
    first, then pieces by log-probability (desc) and piece (asc)."""
    spark = texts.sparkSession
    checkpoint_dir(spark)
    words = nfkc_chunk_counts(texts.select(text_col), METASPACE).withColumnRenamed("n", "freq")
    # the distinct words in slices for the Python E-steps, each of which gives a row for every piece
    slices = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    words = words.repartition(slices).checkpoint(eager=True)
    target = max(0, vocab_size - len(special_tokens))
    L = max_piece_len
    letters = words.select(F.explode(F.split("word", "(?<=.)(?=.)", -1)).alias("piece"), "freq")
    counts = {r.piece: float(r.c) for r in letters.groupBy("piece").agg(F.sum("freq").alias("c")).collect()}
    chars = set(counts)  # the characters in use
    seeds = best_seeds(substring_seeds(words, L), seed_size)
    counts.update(zip(seeds["piece"].to_pylist(), map(float, seeds["c"].to_pylist())))
    total = sum(counts.values())
    logp = {p: math.log(c / total) for p, c in counts.items()}
    pieces = trie = None
    while counts:
        vit: dict[str, float] = {}
        if pieces is None or 2 * len(logp) < len(pieces.names):  # a smaller one for what is left
            if trie is not None:
                trie.destroy()
            pieces = Pieces(logp, L)
            trie = spark.sparkContext.broadcast(pieces)
        for _ in range(em_iters):
            model = spark.sparkContext.broadcast(pieces.scores(logp))
            stats = (words.mapInPandas(_estep(trie, model), _COUNTS)
                     .groupBy("i").agg(F.sum("ex").alias("ex"), F.sum("vit").alias("vit"))
                     .toArrow().to_pydict())
            named = [pieces.names[i] for i in stats["i"]]
            ex = {c: 0.0 for c in chars} | {p: x for p, x in zip(named, stats["ex"]) if x >= LEAST_COUNT or p in chars}
            vit = dict(zip(named, stats["vit"]))
            logsum = digamma(max(sum(ex.values()), LEAST_COUNT))
            logp = {p: digamma(max(c, LEAST_COUNT)) - logsum for p, c in ex.items()}
            model.destroy()
        longer = [p for p in logp if p not in chars]
        room = max(0, target - len(chars))
        if len(longer) <= room:
            break
        model = spark.sparkContext.broadcast(logp)
        alts = spark.createDataFrame([(p,) for p in longer], "piece string").mapInPandas(
            _alt_score(model, L), "piece string, alt double").toArrow().to_pydict()
        model.destroy()
        loss = {p: vit.get(p, 0.0) * (logp[p] - alt) for p, alt in zip(alts["piece"], alts["alt"])}
        n_keep = min(max(room, int(len(longer) * shrink)), len(longer) - 1)  # one at least goes
        kept = set(sorted(loss, key=lambda p: (-loss[p], p))[:n_keep])
        logp = {p: lp for p, lp in logp.items() if p in chars or p in kept}
    ordered = sorted(logp.items(), key=lambda kv: (-kv[1], kv[0]))
    rows = [(i, s, s, True, 0.0) for i, s in enumerate(special_tokens)]
    rows += [(len(special_tokens) + i, p, p, False, float(lp)) for i, (p, lp) in enumerate(ordered)]
    return spark.createDataFrame(rows, "id int, piece string, text string, special boolean, "
                                       "score double")
