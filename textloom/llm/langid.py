"""Language identification with a byte convolutional network.

A text's UTF-8 bytes are cut into fixed-length windows that overlap by the
widest filter less one, so every byte n-gram lies in exactly one window.  The
network embeds bytes, applies filters of several widths, takes each filter's
maximum over the window, and ends in a softmax over the languages.  A document's
probabilities are the mean over all its windows, weighted by their bytes.

It is trained in numpy on the driver, on a bounded sample of labelled documents
whose windows are cut in the tasks.  Prediction runs in the scan tasks: the
first two and the last two byte positions of a filter become two lookup tables
over byte pairs, so a convolution is two gathers and a sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import free_names, maybe_broadcast, row_slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
DIM = 8
WIDEST = max(WIDTHS)
STRIDE = WINDOW - (WIDEST - 1)
PAD = 256
#: labelled documents of one language in the training sample, and of all
SAMPLE_PER_LANG = 500
SAMPLE_TOTAL = 20_000
#: training windows of one sampled document, spread over its whole text
WINDOWS_PER_DOC = 4
EPOCHS = 16
#: how far from a guess among the learned languages (0) to certainty (1) a score has to be
MIN_CONFIDENCE = 1 / 3
UNKNOWN = "und"


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text (rows of ``WINDOW`` byte numbers, ``PAD`` after its end)."""
    m = max(1, -(-(len(data) - (WIDEST - 1)) // STRIDE))
    flat = np.full(m * STRIDE + WIDEST - 1, PAD, np.uint16)
    flat[:len(data)] = np.frombuffer(data, np.uint8)
    step = flat.strides[0]
    return np.lib.stride_tricks.as_strided(flat, (m, WINDOW), (STRIDE * step, step), writeable=False)


@dataclass
class Model:
    langs: list[str]
    emb: np.ndarray  # (257, DIM)
    conv: np.ndarray  # (WIDEST, DIM, filters)
    bias: np.ndarray
    out: np.ndarray  # (filters, langs)
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What a byte pair adds to each filter as its first and as its last two bytes."""
        per = np.einsum("bd,kdf->kbf", self.emb, self.conv).astype(np.float32)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, a.shape[1])
        return pair(per[0] + self.bias.astype(np.float32), per[1]), pair(per[2], per[3])

    def probabilities(self, windows: np.ndarray, tables=None, block: int = 32) -> np.ndarray:
        """Softmax over the languages of each window."""
        head, tail = tables or self.tables()
        top = np.empty((len(windows), head.shape[1]), np.float32)
        for at in range(0, len(windows), block):
            w = windows[at:at + block].astype(np.int32)
            pair = w[:, :-1] * (PAD + 1) + w[:, 1:]
            z = head[pair[:, :-2]]
            z += tail[pair[:, 2:]]
            top[at:at + block] = z.max(1)
        z = np.maximum(top, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _mask() -> np.ndarray:
    """Filters of width w have no weight beyond their first w positions."""
    m = np.zeros((WIDEST, 1, FILTERS * len(WIDTHS)))
    for i, w in enumerate(WIDTHS):
        m[:w, :, i * FILTERS:(i + 1) * FILTERS] = 1
    return m


def train(windows: np.ndarray, labels: list[str], epochs: int = EPOCHS, batch: int = 64,
          rate: float = 0.01, seed: int = 7) -> Model:
    """Fit by Adam on cross-entropy; the same input gives the same model."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels])
    n_f, mask = FILTERS * len(WIDTHS), _mask()
    par = {"emb": rng.normal(0, 0.5, (PAD + 1, DIM)), "conv": rng.normal(0, 0.3, (WIDEST, DIM, n_f)) * mask,
           "bias": np.zeros(n_f), "out": rng.normal(0, 0.1, (n_f, len(langs))), "out_bias": np.zeros(len(langs))}
    first = {k: np.zeros_like(v) for k, v in par.items()}
    second = {k: np.zeros_like(v) for k, v in par.items()}
    step, spots = 0, WINDOW - WIDEST + 1
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at:at + batch]
            x, n = windows[rows].astype(np.int64), len(rows)
            e = par["emb"][x]
            cols = np.concatenate([e[:, k:k + spots] for k in range(WIDEST)], 2)
            z = cols @ par["conv"].reshape(WIDEST * DIM, n_f)
            best = z.argmax(1)
            top = np.take_along_axis(z, best[:, None], 1)[:, 0] + par["bias"]
            h = np.maximum(top, 0)
            p = h @ par["out"] + par["out_bias"]
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y[rows]] -= 1
            p /= n
            dh = (p @ par["out"].T) * (top > 0)
            seen = cols[np.arange(n)[:, None], best]  # (n, filters, WIDEST * DIM)
            d_conv = np.einsum("bf,bfk->kf", dh, seen).reshape(WIDEST, DIM, n_f) * mask
            d_emb = np.zeros_like(par["emb"])
            back = dh[:, :, None, None] * par["conv"].transpose(2, 0, 1)[None]
            np.add.at(d_emb, x[np.arange(n)[:, None, None], best[:, :, None] + np.arange(WIDEST)], back)
            grads = {"emb": d_emb, "conv": d_conv, "bias": dh.sum(0), "out": h.T @ p, "out_bias": p.sum(0)}
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                par[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(langs, par["emb"], par["conv"], par["bias"], par["out"], par["out_bias"])


def training_windows(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG, total: int = SAMPLE_TOTAL,
                     windows_per_doc: int = WINDOWS_PER_DOC) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of the sample: of each language at most
    ``per_lang`` documents (fewer if all would pass ``total``), first by hash
    of their id; of each at most ``windows_per_doc`` windows."""
    d = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"),
        F.xxhash64(F.lit("sample"), F.col(id_col)).alias("_h"))
    sizes = d.groupBy("_lang").agg(F.count("*").alias("_n"))
    langs = sizes.count()
    if not langs:
        return np.empty((0, WINDOW), np.uint16), []
    if langs > total:
        raise ValueError(f"{langs} languages; a sample of {total} documents cannot hold them all")
    want = min(per_lang, total // langs)
    # thin out by hash first, so that ranking sees about twice the sample and not the corpus
    range_ = 1 << 30
    cut = F.least(F.lit(range_), F.ceil(F.lit(range_) * F.lit(2.0 * want + 20) / F.col("_n")))
    thin = d.join(maybe_broadcast(sizes, total), "_lang").filter(F.pmod("_h", F.lit(range_)) < cut)
    ids = thin.groupBy("_lang").agg(F.slice(F.array_sort(F.collect_set(F.pmod("_h", F.lit(range_)))),
                                            1, want).alias("_hs"))
    bound = ids.select(F.col("_lang").alias("_l"), F.element_at("_hs", -1).alias("_last"))
    picked = thin.join(F.broadcast(bound), F.col("_lang") == F.col("_l")).filter(
        F.pmod("_h", F.lit(range_)) <= F.col("_last"))
    # an id that fills many rows counts once
    picked = picked.groupBy("_lang", "_h").agg(F.min("_text").alias("_text")).select("_lang", "_text", "_h")

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, hashes, places, rows = [], [], [], []
            for lang, text, h in zip(b.column(0), b.column(1), b.column(2)):
                w = windows_of(text.as_py().encode("utf-8", "surrogatepass"))
                take = np.unique(np.linspace(0, len(w) - 1, min(windows_per_doc, len(w))).astype(int))
                for i in take:
                    langs.append(lang.as_py())
                    hashes.append(h.as_py())
                    places.append(int(i))
                    rows.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(places, pa.int32()),
                 pa.array(rows, pa.binary())], ["lang", "h", "place", "window"])

    got = picked.mapInArrow(cut_windows, "lang string, h long, place int, window binary").collect()
    got = sorted(set(map(tuple, got)), key=lambda r: (r[0], r[1], r[2], bytes(r[3])))
    x = np.frombuffer(b"".join(bytes(r[3]) for r in got), np.uint16).reshape(-1, WINDOW)
    return x, [r[0] for r in got]


_TABLES: dict = {}


def document_scores(model: Model, texts: Iterator[str | None]) -> Iterator[tuple[str, float]]:
    """``(language, probability)`` of each text; short texts share a batch of windows."""
    key = (len(model.langs), model.emb.tobytes()[:64], model.out.tobytes())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = model.tables()
    tables = _TABLES[key]
    held, sizes = [], []

    def flush():
        if not held:
            return
        p = model.probabilities(np.concatenate(held), tables)
        at = 0
        for m, weight in sizes:
            mean = weight @ p[at:at + m] / weight.sum()
            at += m
            best = int(mean.argmax())
            yield model.langs[best], min(1.0, float(mean[best]))
        held.clear()
        sizes.clear()

    for t in texts:
        data = (t or "").encode("utf-8", "surrogatepass")
        w = windows_of(data)
        weight = np.full(len(w), float(STRIDE))
        weight[-1] = max(1, len(data) - STRIDE * (len(w) - 1))
        held.append(w)
        sizes.append((len(w), weight))
        if sum(map(len, held)) >= 1024:
            yield from flush()
    yield from flush()


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``lang_pred``, ``score``.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything when the model knows no language; repeated rows each give a row."""
    d = docs.select(F.col(id_col), F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _predict(model, b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], [id_col, "lang_pred", "score"])

    kind = dict(docs.dtypes)[id_col]
    return d.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def _predict(model: Model, texts: pa.Array) -> list[tuple[str, float]]:
    """Null stands for a text without a letter."""
    known = texts.is_valid().to_pylist()
    if not model.langs:
        return [(UNKNOWN, 0.0)] * len(known)
    scored = document_scores(model, (t.as_py() for t, k in zip(texts, known) if k))
    return [next(scored) if k else (UNKNOWN, 0.0) for k in known]


def least_score(langs: int, confidence: float = MIN_CONFIDENCE) -> float:
    """The score of ``confidence``: of L languages none can score below 1 / L."""
    return 1 / langs + (1 - 1 / langs) * confidence if langs else 0.0


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text",
                    min_score: float | None = None) -> DataFrame:
    """Rows whose language is known with ``min_score`` at least (by default that of
    ``MIN_CONFIDENCE``), with all their columns; nothing moves.  Texts that look like
    no learned language more than like the others go; one in an unlearned language
    that the network takes for a learned one stays.  A model without languages keeps
    every row that has a letter."""
    min_score = least_score(len(model.langs)) if min_score is None else min_score
    name, = free_names(docs, "_letters")
    d = docs.withColumn(name, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))).filter(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in row_slices(batch):
                if model.langs:
                    good = [s >= min_score for _, s in _predict(model, b.column(text_col))]
                    b = b.filter(pa.array(good, pa.bool_()))
                yield b

    return d.drop(name).mapInArrow(run, docs.schema)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = SAMPLE_PER_LANG, epochs: int = EPOCHS) -> Model:
    x, y = training_windows(labelled, id_col, text_col, lang_col, per_lang)
    if not y:
        return Model([], np.zeros((PAD + 1, DIM)), np.zeros((WIDEST, DIM, FILTERS * len(WIDTHS))),
                     np.zeros(FILTERS * len(WIDTHS)), np.zeros((FILTERS * len(WIDTHS), 0)), np.zeros(0))
    return train(x, y, epochs)
