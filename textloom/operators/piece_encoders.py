"""Encoders of one distinct piece, in time that grows with its length only.

* byte-level BPE: a heap of the merges that are possible, over a linked list;
* WordPiece: a compiled trie with failure links, so that longest-match-first never
  reads a character twice;
* unigram: the same kind of trie finds, per end position, exactly the vocabulary
  pieces that end there, for a Viterbi search.

``build_encoder(spec)`` makes a ``str -> list[int]`` function from plain data.
"""

from __future__ import annotations

import heapq
import math
from collections import deque


def build_encoder(spec: tuple):
    kind = spec[0]
    if kind == "bytebpe":
        return bpe_encoder(spec[1], spec[2])
    if kind == "wordpiece":
        return wordpiece_encoder(*spec[1:])
    return unigram_encoder(spec[1], spec[2])


def bpe_encoder(merges: list[tuple[str, str]], sym_id: dict[str, int]):
    """Merges by rank; all places of one rank left to right, then the next best."""
    ranks = {pair: i for i, pair in enumerate(merges)}

    def encode(piece: str) -> list[int]:
        syms: list[str | None] = [f"{b:02x}" for b in piece.encode("utf-8")]
        n = len(syms)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((syms[i], syms[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, new = heap[0][0], []
            while heap and heap[0][0] == rank:
                i = heapq.heappop(heap)[1]
                j = after[i]
                if syms[i] is None or j >= n or ranks.get((syms[i], syms[j])) != rank:
                    continue  # one of the two went into another merge
                syms[i], syms[j] = syms[i] + syms[j], None
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    new.append(i)
                if before[i] >= 0:
                    new.append(before[i])
            for i in new:
                j = after[i]
                if syms[i] is not None and j < n and (r := ranks.get((syms[i], syms[j]))) is not None:
                    heapq.heappush(heap, (r, i))
        return [sym_id[s] for s in syms if s is not None]
    return encode


class _Trie:
    """Nodes as parallel lists; node 0 is the root."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.value: list = [None]

    def new(self) -> int:
        self.next.append({})
        self.value.append(None)
        return len(self.next) - 1

    def add(self, text: str, value, root: int = 0) -> None:
        at = root
        for c in text:
            to = self.next[at].get(c)
            if to is None:
                to = self.next[at][c] = self.new()
            at = to
        self.value[at] = value


def wordpiece_encoder(text_id: dict[str, int], unk_id: int, max_chars: int = 100):
    """Longest match first.  ``fail[v]`` is the node that goes on when nothing follows
    after ``v``, ``pops[v]`` the ids that are certain then; no node: unknown."""
    trie = _Trie()
    rest = trie.new()  # root of the continuations
    for text, i in text_id.items():
        trie.add(text, i)
        if len(text) > 2 and text.startswith("##"):
            trie.add(text[2:], i, rest)
    fail: list[int | None] = [None] * len(trie.next)
    pops: list[list[int]] = [[] for _ in trie.next]
    todo = deque((root, c, v) for root in (0, rest) for c, v in trie.next[root].items())
    while todo:
        u, c, v = todo.popleft()
        if trie.value[v] is not None:
            fail[v], pops[v] = rest, [trie.value[v]]
        else:
            z, out = fail[u], list(pops[u])
            while z is not None and c not in trie.next[z]:
                out += pops[z]
                z = fail[z]
            if z is not None:
                fail[v], pops[v] = trie.next[z][c], out
        todo.extend((v, d, w) for d, w in trie.next[v].items())

    def encode(word: str) -> list[int]:
        if len(word) > max_chars:
            return [unk_id]
        out, at = [], 0
        for c in word:
            while c not in trie.next[at]:
                if fail[at] is None:
                    return [unk_id]
                out += pops[at]
                at = fail[at]
            at = trie.next[at][c]
        while at not in (0, rest):
            if fail[at] is None:
                return [unk_id]
            out += pops[at]
            at = fail[at]
        return out
    return encode


def unigram_encoder(scores: dict[str, tuple[int, float]], unk_id: int):
    """Viterbi best segmentation by summed log-probabilities; a character that no
    piece covers becomes the unknown id (runs of unknowns collapse to one)."""
    unk_score = min((s for _, s in scores.values()), default=0.0) - 10.0
    trie = _Trie()
    for text, (i, score) in scores.items():
        if text:
            trie.add(text, (len(text), i, score))
    n_nodes = len(trie.next)
    fail = [0] * n_nodes  # the longest proper suffix that is a node
    shorter = [0] * n_nodes  # the longest proper suffix that is a piece
    todo = deque(trie.next[0].values())
    while todo:
        u = todo.popleft()
        for c, v in trie.next[u].items():
            z = fail[u]
            while z and c not in trie.next[z]:
                z = fail[z]
            fail[v] = trie.next[z].get(c, 0)
            todo.append(v)
        z = fail[u]
        shorter[u] = z if trie.value[z] is not None else shorter[z]

    def encode(word: str) -> list[int]:
        n, at = len(word), 0
        best = [0.0] + [-math.inf] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for end, c in enumerate(word, 1):
            while at and c not in trie.next[at]:
                at = fail[at]
            at = trie.next[at].get(c, 0)
            hit = at if trie.value[at] is not None else shorter[at]
            while hit:  # longest first, so that ties keep the longest
                size, i, score = trie.value[hit]
                if best[end - size] + score > best[end]:
                    best[end], back[end] = best[end - size] + score, (end - size, i)
                hit = shorter[hit]
            if best[end - 1] + unk_score > best[end]:
                best[end], back[end] = best[end - 1] + unk_score, (end - 1, unk_id)
        ids, end = [], n
        while end > 0:
            end, i = back[end]
            if not (i == unk_id and ids and ids[-1] == unk_id):
                ids.append(i)
        return ids[::-1]
    return encode
