"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TooLargeToBroadcast(ValueError):
    pass


def bounded_broadcast(df: DataFrame, max_rows: int, what: str = "table") -> DataFrame:
    """Broadcast hint after checking the row count is at most ``max_rows``.

    ``limit(max_rows + 1).count()`` stops early, so the check is cheap even
    when the bound is violated."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise TooLargeToBroadcast(f"{what}: more than {max_rows} rows; use a shuffle join")
    return F.broadcast(df)


# atomic types that can be hashed to choose a salt (maps cannot, arrays cost too much)
_SALT_TYPES = ("string", "bigint", "int", "smallint", "tinyint", "boolean", "date", "timestamp",
               "timestamp_ntz", "double", "float")


def _salt_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c, t in df.dtypes if c not in keys and (t in _SALT_TYPES or t.startswith("decimal"))]


def skew_safe_lookup(big: DataFrame, small: DataFrame, keys: list[str], weight: DataFrame,
                     hot_k: int = 1000, salt_buckets: int = 64, how: str = "left",
                     salt_by: list[str] | None = None, broadcast_rows: int = 10_000) -> DataFrame:
    """Many-to-one lookup of ``small`` (unique on ``keys``) for every row of
    ``big``, safe when a few keys carry a large share of ``big``.

    A ``small`` side of at most ``broadcast_rows`` rows (counted, not guessed)
    is broadcast, so ``big`` does not move at all.  Beyond the bound both sides
    are shuffled: ``weight(keys..., w)`` ranks keys by how many ``big`` rows
    they have; the ``hot_k`` heaviest, and rows whose key is null (they match
    nothing), are salted by a hash of ``salt_by`` (default: the atomic
    non-key columns).  Only the hot *keys* are broadcast, never the looked-up
    values, whose size is not bounded.  Value columns of ``small`` must not
    clash with ``big``."""
    if small.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return big.join(F.broadcast(small), keys, how)
    hot_keys = F.broadcast(weight.orderBy(F.desc("w"), *keys).limit(hot_k).select(
        *keys, F.lit(True).alias("_tl_is_hot")))
    is_hot = F.coalesce(F.col("_tl_is_hot"), F.lit(False))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    salt_cols = salt_by if salt_by is not None else _salt_columns(big, keys)
    salted = (F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salt_buckets))
              if salt_cols else F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets)))
    salt = F.when(is_hot | no_key, salted).otherwise(F.lit(0))
    big_s = (big.join(hot_keys, keys, "left").withColumn("_tl_salt", salt.cast("long"))
             .drop("_tl_is_hot"))
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))
                    ).otherwise(F.array(F.lit(0).cast("long")))
    small_s = (small.join(hot_keys, keys, "left").withColumn("_tl_salt", F.explode(copies))
               .drop("_tl_is_hot"))
    return big_s.join(small_s, [*keys, "_tl_salt"], how).drop("_tl_salt")
