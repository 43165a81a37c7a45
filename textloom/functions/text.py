"""String scalar functions: cleaning, byte repair, pre-tokenizer patterns.

All helpers return Spark ``Column`` expressions, so they stay in the JVM.  Only
:func:`nfkc` needs Python, for texts that are not plain ASCII; it is an Arrow-batched
``pandas_udf`` over whole columns.  The chunks of NFKC texts are cut there too.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.decompose import nfd_expr, without_accents

__all__ = [
    "EOT", "SPECIAL_TOKENS", "WORD_PATTERN", "BYTE_LEVEL_PATTERN", "WHITESPACE_CLASS",
    "col_of", "reflow_newlines", "collapse_blank_lines", "trim_chars",
    "strip_one_leading_space", "drop_cr", "affix", "decode_cp1252", "universal_newlines",
    "nfd", "strip_marks", "normalize_text_col", "word_tokens", "byte_level_tokens",
]

# ---- fixed values (must equal the reference's behaviour) -------------------
# record delimiter of the story corpus
EOT = "<|endoftext|>"
# special tokens, in id order
SPECIAL_TOKENS = ["<|unknown|>", "<|pad|>", "<|cls|>", "<|endoftext|>", "<|mask|>"]
# instruction prefix used for summarisation inputs
SUMMARIZE_PREFIX = "Summarize the following text:\n"
# ---------------------------------------------------------------------------

# Unicode White_Space, written out so Java and RE2 agree (both accept \x{...}).
WHITESPACE_CLASS = (r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
_WORD = r"\p{L}\p{M}\p{N}_"
# Whitespace pre-tokenizer: runs of word characters, or runs of anything that
# is neither a word character nor white space.
WORD_PATTERN = f"[{_WORD}]+|[^{_WORD}{WHITESPACE_CLASS}]+"
# Byte-level (GPT-2 style) split: contractions, optional leading space kept
# with the word, whitespace runs not followed by a non-space.
BYTE_LEVEL_PATTERN = (
    "'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+"
    f"| ?[^{WHITESPACE_CLASS}\\p{{L}}\\p{{N}}]+"
    f"|[{WHITESPACE_CLASS}]+(?![^{WHITESPACE_CLASS}])"
    f"|[{WHITESPACE_CLASS}]+"
)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reflow_newlines(c) -> Column:
    """Lone newline -> space, then exactly two newlines -> one; 3+ untouched."""
    c = col_of(c)
    step1 = F.regexp_replace(c, F.lit(r"(?<!\n)\n(?!\n)"), F.lit(" "))
    return F.regexp_replace(step1, F.lit(r"(?<!\n)\n\n(?!\n)"), F.lit("\n"))


def collapse_blank_lines(c) -> Column:
    """Runs of two or more newlines -> one newline."""
    return F.regexp_replace(col_of(c), F.lit(r"\n{2,}"), F.lit("\n"))


def trim_chars(c, chars: str = " \n") -> Column:
    """Strip every character in ``chars`` from both ends (tabs survive by default)."""
    return F.btrim(col_of(c), F.lit(chars))


def strip_one_leading_space(c) -> Column:
    return F.regexp_replace(col_of(c), F.lit("^ "), F.lit(""))


def drop_cr(c) -> Column:
    return F.replace(col_of(c), F.lit("\r"), F.lit(""))


def affix(c, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), col_of(c), F.lit(suffix))


def _cp1252_table() -> tuple[str, str]:
    """Bytes 0x80-0x9F as Latin-1 code points -> their windows-1252 characters.

    Built from Python's codec; the five bytes windows-1252 leaves undefined
    keep their C1 code point (the repairing decoder's behaviour).
    """
    src, dst = [], []
    for b in range(0x80, 0xA0):
        try:
            ch = codecs.decode(bytes([b]), "cp1252")
        except UnicodeDecodeError:
            continue
        src.append(chr(b))
        dst.append(ch)
    return "".join(src), "".join(dst)


_CP1252_FROM, _CP1252_TO = _cp1252_table()


def decode_cp1252(bytes_col) -> Column:
    """Decode binary as windows-1252, keeping undefined bytes as C1 characters."""
    latin1 = F.decode(col_of(bytes_col), "ISO-8859-1")
    return F.translate(latin1, _CP1252_FROM, _CP1252_TO)


def universal_newlines(c) -> Column:
    """``\\r\\n`` and lone ``\\r`` -> ``\\n`` (text-mode reading)."""
    return F.regexp_replace(col_of(c), F.lit("\r\n?"), F.lit("\n"))


def nfd(c) -> Column:
    """Unicode canonical decomposition (NFD)."""
    return nfd_expr(col_of(c))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition (NFKC), vectorised over an Arrow batch."""
    return s.str.normalize("NFKC")


def nfkc(c) -> Column:
    """NFKC; plain ASCII, which it does not change, stays out of Python."""
    other = F.when(col_of(c).rlike(r"[^\x00-\x7F]"), col_of(c))
    return F.coalesce(_nfkc(other), col_of(c))


_CHUNK = re.compile(r"[^\t\n\x0B\f\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+")  # WHITESPACE_CLASS
_SEPARATOR = re.compile(r"[\x1C-\x1F]")  # str.split cuts here too


def _chunk_lists(texts: pa.Array, prefix: str = "") -> pa.ListArray:
    """The runs of other than white space of each text after NFKC; null texts have none."""
    rows = []
    for t in texts.to_pylist():
        t = "" if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t)
        rows.append(_CHUNK.findall(t) if _SEPARATOR.search(t) else t.split())
    chunks = pa.array([w for row in rows for w in row], pa.string())
    if prefix:
        chunks = pc.binary_join_element_wise(prefix, chunks, "")
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(row) for row in rows])), pa.int32()), chunks)


def nfkc_chunks(c, prefix: str = "") -> Column:
    """Array of the runs of other than white space after NFKC, each behind ``prefix``."""
    def run(texts: pa.Array) -> pa.Array:
        return _chunk_lists(texts, prefix)
    return F.arrow_udf(run, "array<string>")(col_of(c))


def nfkc_chunk_counts(texts: DataFrame, prefix: str = "") -> DataFrame:
    """``(word, n)`` of each distinct chunk (``nfkc_chunks``) of the only column of
    ``texts``; counted where the texts are, so that no token becomes a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_chunk_lists(b.column(0).slice(at, 1000)).values.value_counts() for at in range(0, b.num_rows, 1000)]
            if found:
                t = pa.concat_tables([pa.table({"word": v.field("values"), "n": v.field("counts")}) for v in found])
                t = t.group_by("word").aggregate([("n", "sum")])
                words = pc.binary_join_element_wise(prefix, t.column("word"), "") if prefix else t.column("word")
                yield from pa.table({"word": words, "n": t.column("n_sum")}).to_batches()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def strip_marks(c) -> Column:
    """Drop combining marks (general category M)."""
    return F.regexp_replace(col_of(c), F.lit(r"\p{M}+"), F.lit(""))


def normalize_text_col(c, lower: bool = True, strip_accents: bool = True) -> Column:
    """NFD, then optional lower-case, then optional removal of combining marks."""
    low = F.lower if lower else (lambda x: x)
    if not strip_accents:
        return low(nfd(col_of(c)))
    return low(without_accents(col_of(c), lambda t: strip_marks(low(nfd(t)))))


def word_tokens(c) -> Column:
    """Array of whitespace-pre-tokenizer pieces."""
    return F.regexp_extract_all(col_of(c), F.lit(WORD_PATTERN), F.lit(0))


def byte_level_tokens(c) -> Column:
    """Array of byte-level (GPT-2 style) pre-tokenizer pieces."""
    return F.regexp_extract_all(col_of(c), F.lit(BYTE_LEVEL_PATTERN), F.lit(0))
