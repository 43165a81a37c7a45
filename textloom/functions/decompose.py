"""Unicode canonical decomposition (NFD) as Spark expressions.

Spark has no normalisation function, but NFD is a table lookup and a stable sort:

* a text is cut at the characters that may decompose; each of them is replaced by
  its parts with one ``translate`` per place of a part (Hangul syllables are in the
  same tables: leading, vowel, trailing);
* runs of combining marks are sorted by their combining class.

Texts of ASCII and Latin-1 symbols cost one test of a small character class.  Texts
that have accented Latin letters besides take a short way: no marks of their own, so
nothing to sort, and without accents a single ``translate``.  The tables are generated
from Python's Unicode database.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ranges(points: list[int], gap: int) -> list[tuple[int, int]]:
    """Sorted code points as ranges; gaps of up to ``gap`` are closed."""
    out: list[tuple[int, int]] = []
    for p in points:
        if out and p - out[-1][1] <= gap + 1:
            out[-1] = out[-1][0], p
        else:
            out.append((p, p))
    return out


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


@lru_cache(maxsize=1)
def _tables():
    """Ranges that hold all characters that decompose; per place of a part the
    ``translate`` strings; ranges of the marks, the marks and their classes."""
    parts, marks = {}, {}
    for p in range(sys.maxunicode + 1):
        if 0xD800 <= p < 0xE000:
            continue
        c = chr(p)
        d = unicodedata.normalize("NFD", c)
        if d != c:
            parts[c] = d
        if unicodedata.combining(c):
            marks[c] = unicodedata.combining(c)
    places = []
    for k in range(max(map(len, parts.values()))):
        some = [c for c, d in parts.items() if len(d) > k]
        # characters without a k-th part come last: translate deletes them
        places.append(("".join(some) + "".join(c for c, d in parts.items() if len(d) <= k),
                       "".join(parts[c][k] for c in some)))
    return (_class(_ranges(sorted(map(ord, parts)), 64)), places, _class(_ranges(sorted(map(ord, marks)), 0)),
            "".join(marks), "".join(chr(0x100 + n) for n in marks.values()))


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), f)[0]


# accented Latin letters; beside them only characters that never decompose
_LATIN = r"\x{C0}-\x{24F}\x{1E00}-\x{1EFF}"
_PLAIN = r"\x{00}-\x{BF}"


def _is_plain(c: Column) -> Column:
    return ~c.rlike(f"[^{_PLAIN}]")


def _is_latin(c: Column) -> Column:
    return ~c.rlike(rf"[^{_PLAIN}{_LATIN}\x{{2010}}-\x{{206F}}]")


def _expanded(c: Column, inside: str) -> Column:
    """Every character of the ranges that decomposes, as its parts."""
    _, places, *_ = _tables()

    def one(token: Column) -> Column:
        first = F.translate(token, *places[0])
        return F.when(first == token, token).otherwise(F.concat(first, *[F.translate(token, *p) for p in places[1:]]))

    # only single characters of the ranges are looked up
    tokens = F.regexp_extract_all(c, F.lit(f"[{inside}]|[^{inside}]+"), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(F.length(t) == 1, one(t)).otherwise(t)), "")


def _decomposed(c: Column) -> Column:
    inside = _tables()[0]
    return F.when(c.rlike(f"[{inside}]"), _expanded(c, inside)).otherwise(c)


@lru_cache(maxsize=1)
def _latin_bases() -> tuple[str, str]:
    points = [chr(p) for a, b in ((0xC0, 0x24F), (0x1E00, 0x1EFF)) for p in range(a, b + 1)]
    changed = [c for c in points if unicodedata.normalize("NFD", c) != c]
    return "".join(changed), "".join(unicodedata.normalize("NFD", c)[0] for c in changed)


def _reordered(c: Column) -> Column:
    _, _, mark, marks, classes = _tables()

    def in_order(run: Column) -> Column:
        chars = F.transform(F.split(run, "(?<=.)(?=.)", -1), lambda ch, i: F.struct(
            F.translate(ch, marks, classes).alias("c"), i.alias("i"), ch.alias("ch")))
        return F.array_join(F.transform(F.array_sort(chars), lambda s: s["ch"]), "")

    tokens = F.regexp_extract_all(c, F.lit(f"[{mark}]+|[^{mark}]+"), F.lit(0))
    whole = F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(f"^[{mark}]{{2}}"), in_order(t)).otherwise(t)), "")
    return F.when(c.rlike(f"[{mark}]{{2}}"), whole).otherwise(c)


def nfd_expr(c: Column) -> Column:
    """Unicode canonical decomposition of a text column, without Python."""
    return _let(c, lambda t: F.when(_is_plain(t), t).when(_is_latin(t), _expanded(t, _LATIN)).otherwise(
        _let(_decomposed(t), _reordered)))


def without_accents(c: Column, otherwise) -> Column:
    """The base letters of texts of Latin letters; ``otherwise(text)`` for the rest."""
    return _let(c, lambda t: F.when(_is_latin(t), F.translate(t, *_latin_bases())).otherwise(otherwise(t)))
