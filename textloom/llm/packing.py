"""Best-fit packing of tokenised documents with swap-based local search.

Documents are tokenised inside their scan tasks; only piece lengths (no ids, no
text) go on.  Pieces are dealt by hash into groups of about ``GROUP_PIECES``;
each group is packed by best fit (longest piece first, into the fullest sequence
that takes it) and then improved: documents are moved, or exchanged one for one
or two for one, between underfull sequences whenever that raises the sum of
squared fills, until none does; sequences that run empty disappear.  More data
means more groups of the same size, and at most about one underfull sequence a
group is the price of not packing everything in one task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import checkpointed

CAPACITY = 1024
END_ID = 2
#: pieces packed together in one task
GROUP_PIECES = 20_000
#: sequences of one group have numbers group * SEQUENCES .. (group + 1) * SEQUENCES - 1
SEQUENCES = 1 << 32

# fixed value: how byte-level BPE of this family cuts a text before merging
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# the pattern's white space; the length is far below what the pattern can take
_LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")


def byte_bpe(path: str):
    """The byte-level BPE of a ``tokenizers`` file, run by tiktoken: the same
    ids at several times the speed.  Its 256 byte symbols and merged symbols are
    numbered in merge order, which is all that the merging needs."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # byte-level files write printable bytes as themselves, the others from U+0100 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in sym): i for sym, i in spec["model"]["vocab"].items()
             if sym not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)


_TOKENIZERS: dict = {}


def worker_tokenizer(path: str):
    """One tokenizer for all tasks of a Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = byte_bpe(path)
    return _TOKENIZERS[path]


def _in_parts(tok, text: str) -> Iterator[np.ndarray]:
    """Ids of a text by parts: a long run of white space is one piece of the
    pattern, but for its last character if a word follows."""
    at = 0
    for m in _LONG_SPACE.finditer(text):
        start, end = m.span()
        if end < len(text) and not text.startswith(tuple(tok.special_tokens_set), end):
            end -= 1
        yield tok.encode_to_numpy(text[at:start], allowed_special="all")
        yield np.array(tok._encode_single_piece(text[start:end]), "<u4")
        at = end
    yield tok.encode_to_numpy(text[at:], allowed_special="all")


def encode(tok, text: str) -> bytes:
    """Ids as little-endian 32-bit bytes; a special token's string in a text is
    that token, as in ``tokenizers``.  tiktoken's pattern gives up on about a
    million characters of white space in a row; such texts go by parts."""
    try:
        ids = tok.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        ids = np.concatenate(list(_in_parts(tok, text)))
    return ids.astype("<u4", copy=False).tobytes()


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int]]:
    """``(piece, start, length, crc32)``: cut from the end, so that only the
    first piece may be shorter than ``capacity``."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    start, k, view = 0, 0, memoryview(ids)
    while start < n:
        length = first if k == 0 else capacity
        yield k, start, length, zlib.crc32(view[4 * start:4 * (start + length)])
        start, k = start + length, k + 1


def tokenised_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32``.  Null
    text is empty; every document ends with ``end_id``, so it has a piece."""
    kind = dict(docs.dtypes)[id_col]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = worker_tokenizer(tokenizer)
        for b in batches:
            rows, cols = [], ([], [], [], [])
            for i, t in enumerate(b.column(1)):
                for p in pieces_of(encode(tok, t.as_py() or "") + end, capacity):
                    rows.append(i)
                    for c, v in zip(cols, p):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[1:])],
                [id_col, "piece", "start", "length", "ids_crc32"])

    d = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return d.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------------ packing of one group
def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, longest first: bins of places in ``lengths``."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = defaultdict(list)
    gaps = 0  # bit g is set if some bin has a gap of g
    for i in order:
        n = lengths[i]
        fits = gaps >> n
        if fits:
            gap = n + (fits & -fits).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[at].append(i)
        else:
            gap, at = capacity, len(bins)
            bins.append([i])
        if gap > n:
            by_gap[gap - n].append(at)
            gaps |= 1 << (gap - n)
    return bins


class _Underfull:
    """Bins under their capacity, found by what they hold: bit ``n`` of
    ``singles`` (``pairs``) is set if some bin holds a piece (a pair of pieces)
    of ``n`` tokens in all."""

    def __init__(self, bins: list[list[int]], lengths: list[int]):
        self.bins, self.lengths = bins, lengths
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.of = (defaultdict(dict), defaultdict(dict))
        self.bits = [0, 0]

    def _sums(self, at: int):
        b, n = self.bins[at], self.lengths
        for i in b:
            yield 0, n[i]
        for x in range(len(b)):
            for y in range(x):
                yield 1, n[b[x]] + n[b[y]]

    def add(self, at: int) -> None:
        for kind, s in self._sums(at):
            self.of[kind][s][at] = True
            self.bits[kind] |= 1 << s

    def remove(self, at: int) -> None:
        for kind, s in self._sums(at):
            here = self.of[kind][s]
            here.pop(at, None)
            if not here:
                self.bits[kind] &= ~(1 << s)

    def best(self, kind: int, above: int, upto: int, skip: int, floor: int):
        """The largest sum in (above, upto] that a bin other than ``skip``
        holds whose fill is below ``floor`` + gain; and that bin."""
        window = (self.bits[kind] & ((1 << (upto + 1)) - 1)) >> (above + 1)
        while window:
            s = above + window.bit_length()
            for at in self.of[kind][s]:
                # taking s for `above` raises the squares if the giver is emptier than what results
                if at != skip and self.fill[at] < floor + s - above:
                    return s, at
            window &= (1 << (window.bit_length() - 1)) - 1
        return None


def _take(b: list[int], lengths: list[int], kind: int, total: int) -> list[int]:
    if kind == 0:
        return [next(i for i in b if lengths[i] == total)]
    return next([b[x], b[y]] for x in range(len(b)) for y in range(x) if lengths[b[x]] + lengths[b[y]] == total)


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search: until no move, one-for-one or two-for-one exchange between
    two underfull bins raises the sum of squared fills.  Every step raises that
    whole number, so the search ends; no bin is ever overfull."""
    full = [b for b in bins if sum(lengths[i] for i in b) >= capacity]
    state = _Underfull([b for b in bins if sum(lengths[i] for i in b) < capacity], lengths)
    for at in range(len(state.bins)):
        state.add(at)
    todo = sorted(range(len(state.bins)), key=lambda at: state.fill[at])
    waiting = set(todo)
    while todo:
        at = todo.pop()  # the fullest first
        waiting.discard(at)
        while state.bins[at] and state.fill[at] < capacity:
            step = _step(state, at, capacity)
            if step is None:
                break
            giver, give, back = step
            for x in (at, giver):
                state.remove(x)
            state.bins[giver] = [i for i in state.bins[giver] if i not in give] + back
            state.bins[at] = [i for i in state.bins[at] if i not in back] + give
            for x in (at, giver):
                state.fill[x] = sum(lengths[i] for i in state.bins[x])
                if state.bins[x] and state.fill[x] < capacity:
                    state.add(x)
            if giver not in waiting and state.bins[giver]:
                todo.insert(0, giver)
                waiting.add(giver)
    return full + [b for b in state.bins if b]


def _step(state: _Underfull, at: int, capacity: int):
    """The improving exchange that fills bin ``at`` most: (giver, what it
    gives, what it gets)."""
    b, n = state.bins[at], state.lengths
    gap, fill, best = capacity - state.fill[at], state.fill[at], None
    # (what goes back, what may come): nothing or one piece for one or two, two for one
    offers = [([], 0)] + [([i], k) for i in b for k in (0, 1)]
    offers += [([b[x], b[y]], 0) for x in range(len(b)) for y in range(x)]
    for back, kind in offers:
        out = sum(n[i] for i in back)
        # taking s for out leaves the giver below what `at` had iff fill[giver] - (s - out) < fill
        found = state.best(kind, out, out + gap, at, fill)
        if found and (best is None or found[0] - out > best[0]):
            best = (found[0] - out, found[1], back, kind, found[0])
            if best[0] == gap:
                break
    if best is None:
        return None
    _, giver, back, kind, total = best
    return giver, _take(state.bins[giver], n, kind, total), back


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number (from 0) and offset of every piece of one group."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, b in enumerate(bins):
        at = 0
        for i in b:
            seq[i], off[i] = k, at
            at += lengths[i]
    return seq, off


def best_fit_pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY, end_id: int = END_ID,
                  group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of ``docs`` with ``sequence_id`` and ``offset``.

    Only documents of more than ``capacity`` ids are cut.  Repeated rows are
    packed each for itself; null ids too; no rows give no rows.  Full pieces
    are sequences by themselves and join no group."""
    pieces = checkpointed(tokenised_pieces(docs, tokenizer, id_col, text_col, capacity, end_id))
    whole = pieces.filter(F.col("length") == capacity)
    part = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group_pieces))
    # rows that are equal in all columns must not all meet in one group
    part = part.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        seq, off = pack_group(table.column("length").to_pylist(), capacity)
        g = table.column("_group").to_numpy()
        out = table.drop_columns(["_group"])
        return (out.append_column("sequence_id", pa.array(g * SEQUENCES + seq))
                .append_column("offset", pa.array(off)))

    names = [id_col, "piece", "start", "length", "ids_crc32"]
    kind = dict(docs.dtypes)[id_col]
    packed = part.groupBy("_group").applyInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, "
             "sequence_id long, offset long")
    alone = whole.select(*names, (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)
