"""Window analytics over training-run logs.

A run's log can be huge (one run may hold a third of all rows), so no
operator puts a whole run into one task:

* steps come from ``with_row_index`` partitioned by run (range buckets);
* per-run totals (last step, duration) are partial aggregates joined back;
* trailing windows (rolling mean, lag-based throughput) run per
  ``(run, step // bucket_rows)`` block, and each block receives a *halo*:
  the last ``window - 1`` rows of the previous block, so every row sees its
  full window while blocks stay bounded.
"""

from __future__ import annotations

import itertools
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators.order import with_row_index


def micros(c) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ columns
    (NTZ wall clock read in the session time zone, pinned to UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def run_steps(df: DataFrame, run_cols, ts_col: str = "ts", tiebreak: str = "event_id",
              step_col: str = "step") -> DataFrame:
    """Dense 0-based step per run in (ts, tiebreak) order."""
    keyed = df.withColumn("_tl_ts", micros(ts_col))
    return with_row_index(keyed, ["_tl_ts", tiebreak], step_col,
                          partition_by=_list(run_cols)).drop("_tl_ts")


def train_pct(df: DataFrame, run_cols, step_col: str = "step", out_col: str = "train_pct"
              ) -> DataFrame:
    """Step / last step of the run (partial aggregate joined back)."""
    from textloom.operators.bounded import skew_safe_lookup

    run_cols = _list(run_cols)
    stats = df.groupBy(*run_cols).agg(F.max(step_col).alias("_tl_last"),
                                      F.count(F.lit(1)).alias("w"))
    # a run may hold a third of all rows: hot runs are looked up by broadcast
    joined = skew_safe_lookup(df, stats.select(*run_cols, "_tl_last"), run_cols,
                              stats.select(*run_cols, "w"))
    return joined.withColumn(
        out_col, F.try_divide(F.col(step_col), F.col("_tl_last"))).drop("_tl_last")


def _blocked(df: DataFrame, run_cols, step_col: str, halo: int, bucket_rows: int):
    """Rows tagged with a block id, plus halo copies of each block's tail."""
    if halo >= bucket_rows:
        raise ValueError("bucket_rows must exceed the window")
    blk = F.floor(F.col(step_col) / bucket_rows).cast("long")
    in_tail = F.pmod(F.col(step_col), F.lit(bucket_rows)) >= bucket_rows - halo
    own = F.struct(blk.alias("b"), F.lit(False).alias("h"))
    copy = F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))
    # one pass: every row once, plus one halo copy of each block's tail
    tags = F.when(in_tail, F.array(own, copy)).otherwise(F.array(own))
    both = (df.withColumn("_tl_tag", F.explode(tags))
            .withColumn("_tl_blk", F.col("_tl_tag.b")).withColumn("_tl_halo", F.col("_tl_tag.h"))
            .drop("_tl_tag"))
    w = Window.partitionBy(*run_cols, "_tl_blk").orderBy(step_col)
    return both, w


def rolling_mean(df: DataFrame, run_cols, value_col: str, window: int = 25,
                 step_col: str = "step", out_col: str | None = None,
                 bucket_rows: int = 1 << 16) -> DataFrame:
    """R2: trailing mean of ``window`` rows; null until the window is full."""
    run_cols = _list(run_cols)
    out_col = out_col or f"{value_col}_smooth"
    both, w = _blocked(df, run_cols, step_col, window - 1, bucket_rows)
    frame = w.rowsBetween(-(window - 1), 0)
    val = F.col(value_col)
    res = both.withColumn(out_col, F.when(F.count(val).over(frame) == window,
                                          F.avg(val).over(frame)))
    return res.filter(~F.col("_tl_halo")).drop("_tl_blk", "_tl_halo")


def throughput(df: DataFrame, run_cols, window: int = 25, batch_size: int | None = None,
               samples_col: str | None = None, ts_col: str = "ts", step_col: str = "step",
               out_col: str = "samples_per_sec", bucket_rows: int = 1 << 16) -> DataFrame:
    """samples/s over the last ``window`` batches:
    ``(n_i - n_{i-window}) / (t_i - t_{i-window})`` with ``n`` the cumulative
    sample count (``batch_size`` per step, or a running total of ``samples_col``)."""
    run_cols = _list(run_cols)
    base = df
    if samples_col is not None:
        base = with_row_index(base.withColumn("_tl_tsu", micros(ts_col)),
                              [step_col], "_tl_ri", {"_tl_cum": samples_col},
                              partition_by=run_cols).drop("_tl_ri", "_tl_tsu")
        base = base.withColumn("_tl_cum", F.col("_tl_cum") + F.col(samples_col))
    else:
        base = base.withColumn("_tl_cum", (F.col(step_col) + 1) * F.lit(batch_size or 1))
    both, w = _blocked(base, run_cols, step_col, window, bucket_rows)
    secs = micros(ts_col) / 1e6
    both = both.withColumn("_tl_secs", secs)
    dn = F.col("_tl_cum") - F.lag("_tl_cum", window).over(w)
    dt = F.col("_tl_secs") - F.lag("_tl_secs", window).over(w)
    res = both.withColumn(out_col, F.try_divide(dn, dt))  # null, not an error, when dt = 0
    return res.filter(~F.col("_tl_halo")).drop("_tl_blk", "_tl_halo", "_tl_cum", "_tl_secs")


def run_duration(df: DataFrame, run_cols, ts_col: str = "ts") -> DataFrame:
    """Wall time per run, in seconds."""
    us = micros(ts_col)
    return df.groupBy(*_list(run_cols)).agg(((F.max(us) - F.min(us)) / 1e6).alias("seconds"))


def overlay_runs(dfs: list[DataFrame], labels: list[str], label_col: str = "label") -> DataFrame:
    """Curves of several runs in one table, labelled."""
    if len(dfs) != len(labels):
        raise ValueError("one label per run")
    out = None
    for d, lab in zip(dfs, labels):
        d = d.withColumn(label_col, F.lit(lab))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def overlay_log(df: DataFrame, run_col: str = "run", labels: dict[str, str] | None = None,
                label_col: str = "label") -> DataFrame:
    """R5 for runs that share a log: one scan, whatever the number of runs.  With
    ``labels`` (run -> label) only those runs are kept; else a run is its own label."""
    if labels is None:
        return df.withColumnRenamed(run_col, label_col)
    named = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return df.filter(F.col(run_col).isin(list(labels))).withColumn(label_col, named[F.col(run_col)]).drop(run_col)


def eval_by_epoch(df: DataFrame, run_cols, epoch_col: str = "epoch", value_col: str = "value",
                  step_col: str = "step", out_col: str = "metric") -> DataFrame:
    """The metric's last value (by step) in every epoch of every run."""
    return df.groupBy(*_list(run_cols), epoch_col).agg(
        F.max_by(F.col(value_col), F.col(step_col)).alias(out_col))


def early_stop(epochs: DataFrame, run_cols, patience: int = 1, epoch_col: str = "epoch",
               metric_col: str = "metric", higher_is_better: bool = True) -> DataFrame:
    """Best epoch (ties are not an improvement) and the first epoch where
    ``epoch - best_epoch > patience`` (null if training never stops).

    Input is one row per (run, epoch) -- bounded by the number of epochs."""
    run_cols = _list(run_cols)
    m = F.col(metric_col) if higher_is_better else -F.col(metric_col)
    w = Window.partitionBy(*run_cols).orderBy(epoch_col)
    prev_best = F.max(m).over(w.rowsBetween(Window.unboundedPreceding, -1))
    improved = prev_best.isNull() | (m > prev_best)
    tagged = epochs.withColumn("_tl_new", F.when(improved, F.col(epoch_col)))
    tagged = tagged.withColumn("_tl_best", F.last("_tl_new", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.when(F.col(epoch_col) - F.col("_tl_best") > patience, F.col(epoch_col))
    return tagged.groupBy(*run_cols).agg(
        F.min(stop).cast("long").alias("stop_epoch"),
        F.coalesce(F.min_by("_tl_best", stop), F.max_by("_tl_best", F.col(epoch_col)))
        .cast("long").alias("best_epoch"))


# ---------------------------------------------------------------- run matrix
def sweep_grid(spark: SparkSession, axes: dict, seeds=None) -> DataFrame:
    """The run matrix: one row per combination of axis values (and seed),
    with a ``group`` label naming the configuration without the seed."""
    names = list(axes)
    if seeds is not None:
        names.append("seed")
    rows = [combo + ((s,) if seeds is not None else ())
            for combo in itertools.product(*axes.values())
            for s in (seeds if seeds is not None else [None])]
    rows = [tuple(r) for r in rows] if seeds is not None else [tuple(r[:len(axes)]) for r in rows]
    df = spark.createDataFrame(rows, names)
    return df.withColumn("group", F.concat_ws("-", *[F.col(a).cast("string") for a in axes]))


# an option, and its value unless the next word is an option too
OPTION = r"(?<!\S)--([A-Za-z_][\w-]*)(?:[ =]+(?!--)([^ ]+))?"


def parse_runs(df: DataFrame, line_col: str = "line", types: dict | None = None) -> DataFrame:
    """``--key value`` options of a command line -> a map and typed columns.

    A flag without a value is ``true``; of a repeated option the last counts."""
    keys = F.regexp_extract_all(F.col(line_col), F.lit(OPTION), F.lit(1))
    vals = F.regexp_extract_all(F.col(line_col), F.lit(OPTION), F.lit(2))
    out = df.withColumn("_tl_k", keys).withColumn("_tl_v", vals)
    last = F.filter(F.arrays_zip("_tl_k", "_tl_v"), lambda e, i: ~F.array_contains(
        F.slice("_tl_k", i + 2, F.size("_tl_k")), e["_tl_k"]))
    pairs = F.transform(last, lambda e: F.struct(e["_tl_k"], F.when(e["_tl_v"] == "", "true").otherwise(e["_tl_v"])))
    out = out.withColumn("options", F.map_from_entries(pairs)).drop("_tl_k", "_tl_v")
    for k, t in (types or {}).items():
        out = out.withColumn(k.replace("-", "_"), F.col("options")[k].cast(t))
    return out


def seed_summary(df: DataFrame, config_cols, metric_col: str = "metric") -> DataFrame:
    """Aggregate the runs of a configuration over seeds."""
    m = F.col(metric_col)
    return df.groupBy(*_list(config_cols)).agg(
        F.count(F.lit(1)).cast("long").alias("n_runs"), F.avg(m).alias("mean"),
        F.stddev_samp(m).alias("std"), F.min(m).alias("min"), F.max(m).alias("max"))


# ---------------------------------------------------------------- schedule
def lr_at(step, total, peak: float, warmup) -> Column:
    """Linear warm-up to ``peak`` then cosine decay to 0 at ``total``."""
    s = step if isinstance(step, Column) else F.col(step)
    tot = total if isinstance(total, Column) else F.lit(total)
    wu = warmup if isinstance(warmup, Column) else F.lit(warmup)
    decay = 0.5 * (1 + F.cos(F.lit(math.pi) * (s - wu) / F.greatest(tot - wu, F.lit(1))))
    return F.lit(peak) * F.when(s < wu, s / wu).otherwise(decay)


def parse_warmup(spec, epochs: int | None = None, total_steps: int | None = None):
    """Warm-up spec: digits -> that many epochs (as a fraction of all epochs
    when ``epochs`` is given); a float string -> fraction of training; any
    other string (``'500ba'``, ``'1ep'``) is a duration kept as is."""
    s = str(spec).strip()
    if re.fullmatch(r"\d+", s):
        if epochs:
            frac = int(s) / epochs
            return int(frac * total_steps) if total_steps else frac
        return int(s)
    if re.fullmatch(r"\d*\.\d+(e-?\d+)?|\d+e-?\d+", s):
        frac = float(s)
        return int(frac * total_steps) if total_steps else frac
    return s
