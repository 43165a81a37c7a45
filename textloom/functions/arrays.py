"""Array-column helpers for token ids (Spark higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import col_of

__all__ = [
    "IGNORE_INDEX", "windows_of", "causal_inputs", "causal_targets", "mask_ids",
    "shift_right", "with_specials", "added_specials_mask", "truncate_pad", "truncate_pad_special",
    "attention_mask",
    "argmax", "log_softmax_at", "mean_neg_log_softmax", "hashed_unit", "hashed_key",
]

# fixed value: label id ignored by the loss
IGNORE_INDEX = -100


def windows_of(ids, length) -> Column:
    """Consecutive non-overlapping windows of ``length``; the short tail is dropped."""
    ids = col_of(ids)
    L = length if isinstance(length, Column) else F.lit(int(length))
    n_full = F.floor(F.size(ids) / L).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n_full - 1, F.lit(0)))
    return F.slice(F.transform(starts, lambda i: F.slice(ids, i * L + 1, L)), 1, n_full)


def causal_inputs(ids) -> Column:
    """``x[:-1]``"""
    ids = col_of(ids)
    return F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))


def causal_targets(ids) -> Column:
    """``x[1:]``"""
    ids = col_of(ids)
    return F.when(F.size(ids) <= 1, F.array().cast("array<int>")).otherwise(
        F.slice(ids, 2, F.size(ids) - 1))


def mask_ids(ids, value: int, replacement: int = IGNORE_INDEX) -> Column:
    """Replace every occurrence of ``value`` with ``replacement``."""
    return F.transform(col_of(ids), lambda x: F.when(x == value, F.lit(replacement)).otherwise(x))


def shift_right(ids, start_id: int, pad_id: int = 0) -> Column:
    """Decoder inputs: start token, then labels minus the last; -100 -> pad."""
    ids = col_of(ids)
    body = F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))
    shifted = F.concat(F.array(F.lit(start_id)), body)
    return mask_ids(shifted, IGNORE_INDEX, pad_id)


def with_specials(ids, cls_id: int, sep_id: int) -> Column:
    return F.concat(F.array(F.lit(cls_id)), col_of(ids), F.array(F.lit(sep_id)))


def added_specials_mask(ids) -> Column:
    """1 at the first and last position (the added CLS/SEP), 0 elsewhere."""
    n = F.size(col_of(ids))
    return F.transform(col_of(ids), lambda x, i: F.when((i == 0) | (i == n - 1), 1).otherwise(0))


def truncate_pad(ids, max_length: int, pad_id: int, keep_last: int | None = None) -> Column:
    """Truncate to ``max_length`` (optionally re-appending the trailing special
    ``keep_last``) and right-pad with ``pad_id``."""
    ids = col_of(ids)
    if keep_last is None:
        cut = F.slice(ids, 1, max_length)
    else:
        cut = F.when(F.size(ids) <= max_length, ids).otherwise(
            F.concat(F.slice(ids, 1, max_length - 1), F.array(F.lit(keep_last))))
    pad = F.array_repeat(F.lit(pad_id), F.greatest(F.lit(max_length) - F.size(cut), F.lit(0)))
    return F.concat(cut, pad)


def truncate_pad_special(values, special, max_length: int, pad_value: int) -> Column:
    """``truncate_pad`` of an aligned column that keeps the row's own last
    value when ``special`` marks the last position."""
    values, special = col_of(values), col_of(special)
    ends_special = (F.size(special) > 0) & (F.element_at(special, -1) == 1)
    cut = F.when(F.size(values) <= max_length, values).when(
        F.coalesce(ends_special, F.lit(False)),
        F.concat(F.slice(values, 1, max_length - 1), F.slice(values, -1, 1))).otherwise(
        F.slice(values, 1, max_length))
    return F.concat(cut, F.array_repeat(F.lit(pad_value), F.greatest(
        F.lit(max_length) - F.size(values), F.lit(0))))


def attention_mask(ids, max_length: int) -> Column:
    n = F.least(F.size(col_of(ids)), F.lit(max_length))
    return F.concat(F.array_repeat(F.lit(1), n),
                    F.array_repeat(F.lit(0), F.lit(max_length) - n))


def argmax(arr) -> Column:
    """0-based position of the first maximum."""
    arr = col_of(arr)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def _lse(arr: Column) -> Column:
    m = F.array_max(arr)
    return m + F.log(F.aggregate(arr, F.lit(0.0).cast("double"),
                                 lambda acc, x: acc + F.exp(x.cast("double") - m)))


def log_softmax_at(arr, idx) -> Column:
    """log p[idx] with a stable log-sum-exp; idx is 0-based."""
    arr = col_of(arr).cast("array<double>")
    return F.element_at(arr, col_of(idx) + 1) - _lse(arr)


def mean_neg_log_softmax(arr) -> Column:
    """mean_k(-log p_k) -- the uniform part of label smoothing."""
    arr = col_of(arr).cast("array<double>")
    lse = _lse(arr)
    total = F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + (lse - x))
    return total / F.size(arr)


def hashed_key(*cols) -> Column:
    """60 bits of md5 of the ':'-joined values, as a non-negative long
    (engine-independent, so SQL can recompute it)."""
    text = F.concat_ws(":", *[col_of(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hashed_unit(*cols) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from a hash of ``cols``."""
    return hashed_key(*cols) / float(1 << 60)
