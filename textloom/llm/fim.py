"""Fill-in-the-middle transformation over seekable compressed frames.

1. ``frame_store``: every text becomes a list of independent zstandard frames of at
   most ``FRAME_BYTES`` bytes, with cumulative counts of units and code points before
   each.  A unit is a run of A-Z and a-z or any other single code point.
2. ``infill`` draws two cuts (in units) and a form from a hash of the id.  Only the
   frames that hold a cut are decompressed to find its place; the output is then
   written by streaming the frames in the order of the form, into frames again.
3. ``restore`` rebuilds a text from nothing but output and form, streaming: prefix and
   middle pass straight through, the suffix waits as compressed frames.

Forms: ``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle,
``plain`` is the text itself (empty texts, texts that hold a mark, and the share of
the rest that stays as it is).  A text without marks cannot form one at a seam, since
marks begin with a character that they do not repeat; so the first mark found is the
one that was written.

Defined results.  Null text: like empty text, plain, no unit.  Very long texts: many
frames, a few of them in memory uncompressed at a time; one run of letters may fill
many frames.  A null id: drawn like an id without digits.  Repeated rows: one row
each, equal.  Empty tables: no row.  Only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.llm.common import row_slices

FRAME_BYTES = 1 << 16
LEVEL = 3
#: fixed values: the marks before prefix, suffix and middle
MARKS = ("<P>", "<S>", "<M>")
SEED = "1"
PLAIN_FROM = 90
SPM_BELOW = 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True

_STORE = "units array<long>, chars array<long>, inside array<boolean>, frames array<binary>, marked boolean"


# ---------------------------------------------------------------- one text
def _code_points(b: np.ndarray) -> np.ndarray:
    return (b & 0xC0) != 0x80


def unit_starts(data: bytes, inside: bool) -> np.ndarray:
    """Byte offsets at which a unit starts; ``inside``: a letter came before."""
    b = np.frombuffer(data, np.uint8)
    letter = _LETTER[b]
    before = np.concatenate([[inside], letter[:-1]]) if len(b) else letter
    return np.flatnonzero(_code_points(b) & ~(letter & before))


def cut_frames(data: bytes, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """Parts of at most ``size`` bytes that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        cut = end
        while at < cut < len(data) and data[cut] & 0xC0 == 0x80:
            cut -= 1
        end = cut if cut > at else end  # bytes that are no UTF-8 are cut anywhere
        yield data[at:end]
        at = end


class Frames:
    """The seekable frames of one text."""

    def __init__(self, units, chars, inside, frames):
        self.units, self.chars, self.inside, self.frames = units, chars, inside, frames
        self._zstd = zstandard.ZstdDecompressor()

    @classmethod
    def of(cls, data: bytes, size: int = FRAME_BYTES) -> "Frames":
        packer = zstandard.ZstdCompressor(level=LEVEL)
        units, chars, inside, frames, open_ = [0], [0], [], [], False
        for part in cut_frames(data, size):
            inside.append(open_)
            frames.append(packer.compress(part))
            units.append(units[-1] + len(unit_starts(part, open_)))
            chars.append(chars[-1] + int(_code_points(np.frombuffer(part, np.uint8)).sum()))
            open_ = bool(_LETTER[part[-1]])
        return cls(units, chars, inside, frames)

    def __len__(self) -> int:
        """Units of the text."""
        return self.units[-1]

    def part(self, i: int) -> bytes:
        return self._zstd.decompress(self.frames[i])

    def place(self, unit: int) -> tuple[int, int, int]:
        """``(frame, byte in it, code points before)`` of the start of ``unit``
        (the end of the text if there are no more): one frame is decompressed."""
        if unit >= len(self):
            return len(self.frames), 0, self.chars[-1]
        i = bisect_right(self.units, unit) - 1
        data = self.part(i)
        at = int(unit_starts(data, self.inside[i])[unit - self.units[i]])
        return i, at, self.chars[i] + int(_code_points(np.frombuffer(data[:at], np.uint8)).sum())

    def stream(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> Iterator[bytes]:
        """The bytes between two places, frame after frame."""
        for i in range(start[0], min(end[0] + 1, len(self.frames))):
            if i == end[0] and not end[1]:
                return
            data = self.part(i)
            yield data[start[1] if i == start[0] else 0:end[1] if i == end[0] else len(data)]


class Writer:
    """Frames of a stream of bytes, and the digest of all that was written."""

    def __init__(self, size: int = FRAME_BYTES, keep: bool = True):
        self.frames, self.sha = [], hashlib.sha256()
        self._size, self._held, self._keep = size, bytearray(), keep
        self._zstd = zstandard.ZstdCompressor(level=LEVEL)

    def write(self, chunks: Iterable[bytes]) -> "Writer":
        for c in chunks:
            self.sha.update(c)
            if self._keep:
                self._held += c
                while len(self._held) > self._size:
                    self._flush(self._size)
        return self

    def _flush(self, n: int) -> None:
        self.frames.append(self._zstd.compress(bytes(self._held[:n])))
        del self._held[:n]

    def close(self) -> list[bytes]:
        if self._held:
            self._flush(len(self._held))
        return self.frames


def opened(frames: Iterable[bytes]) -> Iterator[bytes]:
    z = zstandard.ZstdDecompressor()
    return (z.decompress(f) for f in frames)


def draws(row_id, seed: str = SEED) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers from the id."""
    name = "" if row_id is None else str(row_id)
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{name}".encode()).digest()[:16])


def between_marks(chunks: Iterable[bytes], marks: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """``(how many marks came before, bytes)``; the first of each mark, in order, goes."""
    seen, held = 0, b""
    for c in chunks:
        held += c
        while seen < len(marks) and (at := held.find(marks[seen])) >= 0:
            yield seen, held[:at]
            held, seen = held[at + len(marks[seen]):], seen + 1
        # a mark may go on in the next chunk
        tail = len(marks[seen]) - 1 if seen < len(marks) else 0
        if len(held) > tail:
            yield seen, held[:len(held) - tail]
            held = held[len(held) - tail:]
    yield seen, held


def restored(chunks: Iterable[bytes], form: str, marks=MARKS) -> Iterator[bytes]:
    """The text of an output, in order."""
    if form == "plain":
        yield from chunks
        return
    p, s, m = (x.encode() for x in marks)
    suffix_at, order = (2, [p, s, m]) if form == "psm" else (1, [s, p, m])
    waiting = Writer()
    for k, part in between_marks(chunks, order):
        if k == suffix_at:
            waiting.write([part])
        elif k:
            yield part
    yield from opened(waiting.close())


# ---------------------------------------------------------------- tables
def frame_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                frame_bytes: int = FRAME_BYTES, marks=MARKS) -> DataFrame:
    """``id`` and the frames of every row: ``units`` and ``chars`` before each frame
    (and in all), ``inside`` (the frame begins inside a run of letters), ``frames``,
    and ``marked`` (the text holds a mark)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("_text"))
    kind, needles = dict(d.dtypes)["id"], [m.encode() for m in marks]
    types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.binary()), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                out = [[] for _ in types]
                for x in b.column("_text"):
                    data = x.as_py() or b""
                    f = Frames.of(data, frame_bytes)
                    row = f.units, f.chars, f.inside, f.frames, any(n in data for n in needles)
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), *(pa.array(c, t) for c, t in zip(out, types))],
                    ["id", "units", "chars", "inside", "frames", "marked"])

    return d.mapInArrow(run, f"id {kind}, {_STORE}")


def write_store(docs: DataFrame, path: str, **options) -> DataFrame:
    """``frame_store`` written to a folder and read again; frames are compressed already."""
    frame_store(docs, **options).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.parquet(path)


def infill(store: DataFrame, seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
           frame_bytes: int = FRAME_BYTES, marks=MARKS) -> DataFrame:
    """``id``, ``n`` (units), ``form``, ``prefix_chars`` and ``middle_chars`` (null if
    plain), ``output`` (frames) and ``output_sha256`` of every row of the store."""
    kind = dict(store.dtypes)["id"]
    p, s, m = (x.encode() for x in marks)

    def one(row_id, f: Frames, marked: bool):
        n = len(f)
        h1, h2, h3, h4 = draws(row_id, seed)
        out, start, end = Writer(frame_bytes), (0, 0, 0), f.place(n)
        if not n or marked or h3 % 100 >= plain_from:
            out.write(f.stream(start, end))
            return n, "plain", None, None, out
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = f.place(a), f.place(b)
        form = "spm" if h4 % 100 < spm_below else "psm"
        prefix, suffix = (p, start, a), (s, b, end)
        for mark, x, y in (suffix, prefix, (m, a, b)) if form == "spm" else (prefix, suffix, (m, a, b)):
            out.write([mark]).write(f.stream(x, y))
        return n, form, a[2], b[2] - a[2], out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                rows = []
                columns = [b.column(c) for c in ("id", "units", "chars", "inside", "frames", "marked")]
                for row_id, units, chars, inside, frames, marked in zip(*columns):
                    *row, out = one(row_id.as_py(), Frames(units.as_py(), chars.as_py(), inside.as_py(),
                                                           frames.as_py()), marked.as_py())
                    rows.append((*row, out.close(), out.sha.hexdigest()))
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), *(pa.array(list(c), t) for c, t in zip(zip(*rows), types))],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])

    return store.select("id", "units", "chars", "inside", "frames", "marked").mapInArrow(
        run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, "
             "output array<binary>, output_sha256 string")


def restore(found: DataFrame, marks=MARKS, keep_text: bool = True) -> DataFrame:
    """``found`` with ``restored`` (frames; without ``keep_text`` null) and
    ``restored_sha256``, rebuilt from ``output`` and ``form`` alone."""
    kinds = dict(found.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                frames, shas = [], []
                for output, form in zip(b.column("output"), b.column("form")):
                    w = Writer(keep=keep_text).write(restored(opened(output.as_py()), form.as_py(), marks))
                    frames.append(w.close() if keep_text else None)
                    shas.append(w.sha.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in passed), pa.array(frames, pa.list_(pa.binary())), pa.array(shas, pa.string())],
                    [*passed, "restored", "restored_sha256"])

    passed = [c for c in found.columns if keep_text or c != "output"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in passed)
    return found.mapInArrow(run, f"{schema}, restored array<binary>, restored_sha256 string")


@F.udf(returnType=StringType())
def frames_text(frames):
    """The text of a column of frames."""
    return None if frames is None else b"".join(opened(bytes(f) for f in frames)).decode("utf-8", "replace")


def fill_in_middle(spark: SparkSession, store_path: str) -> DataFrame:
    """Outputs and restored texts of a written store, as text columns."""
    found = restore(infill(spark.read.parquet(store_path)))
    return found.withColumn("output", frames_text("output")).withColumn("restored", frames_text("restored"))
