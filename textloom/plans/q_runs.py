"""Registered queries: run-log analytics (R1-R10) on ``events``.

Binding: run = ``event_type``; step = order of (ts, event_id) within the run;
metric = ``value``; epoch = day of year of ``ts``; seed = ``user_id % 3``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import runs as rn
from textloom.plans.registry import query
from textloom.plans.tables import table

EV = """ev AS (SELECT event_id, ts, user_id, event_type AS run, value,
  CAST(dayofyear(ts) AS INTEGER) AS epoch,
  CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS BIGINT) AS step
  FROM events)"""


def run_log(spark, sf):
    """The step-numbered log, written once (reliable checkpoint): every run
    analysis reads it several times (big side, per-run stats, hot keys)."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "run")
    ev = ev.withColumn("epoch", F.dayofyear("ts"))
    return rn.run_steps(ev, ["run"], "ts", "event_id").checkpoint(eager=True)


@query("run_steps", f"WITH {EV} SELECT event_id, run, step FROM ev")
def q_steps(spark, sf):
    return run_log(spark, sf).select("event_id", "run", "step")


@query("train_pct", f"""
WITH {EV} SELECT run, step, round(step / max(step) OVER (PARTITION BY run), 9) AS train_pct FROM ev
""")
def q_train_pct(spark, sf):
    out = rn.train_pct(run_log(spark, sf), ["run"])
    return out.select("run", "step", F.round("train_pct", 9).alias("train_pct"))


@query("rolling_mean", f"""
WITH {EV} SELECT run, step,
  round(CASE WHEN count(value) OVER w = 25 THEN avg(value) OVER w END, 9) AS value_smooth
FROM ev WINDOW w AS (PARTITION BY run ORDER BY step ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)
""")
def q_rolling(spark, sf):
    # small blocks so the halo logic is exercised at every scale
    out = rn.rolling_mean(run_log(spark, sf), ["run"], "value", 25, bucket_rows=500)
    return out.select("run", "step", F.round("value_smooth", 9).alias("value_smooth"))


@query("throughput", f"""
WITH {EV} SELECT run, step,
  round(25 * 64 / (epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6, 25) OVER w), 6) AS samples_per_sec
FROM ev WINDOW w AS (PARTITION BY run ORDER BY step)
""")
def q_throughput(spark, sf):
    out = rn.throughput(run_log(spark, sf), ["run"], 25, batch_size=64, bucket_rows=500)
    return out.select("run", "step", F.round("samples_per_sec", 6).alias("samples_per_sec"))


@query("run_duration", """
SELECT event_type AS run, round((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6, 6) AS seconds
FROM events GROUP BY event_type
""")
def q_duration(spark, sf):
    out = rn.run_duration(table(spark, sf, "events").withColumnRenamed("event_type", "run"),
                          ["run"])
    return out.select("run", F.round("seconds", 6).alias("seconds"))


@query("overlay_runs", f"""
WITH {EV}
SELECT run AS label, step, value FROM ev
""")
def q_overlay(spark, sf):
    return rn.overlay_log(run_log(spark, sf).select("run", "step", "value"))


_EPOCHS = f"""{EV},
ep AS (SELECT run, epoch, arg_max(value, step) AS metric FROM ev GROUP BY run, epoch)"""


@query("eval_by_epoch", f"WITH {_EPOCHS} SELECT run, epoch, metric FROM ep")
def q_eval_epoch(spark, sf):
    return rn.eval_by_epoch(run_log(spark, sf), ["run"])


@query("early_stop", f"""
WITH {_EPOCHS},
a AS (SELECT run, epoch, metric,
       max(metric) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
                         AND 1 PRECEDING) AS prev_best FROM ep),
b AS (SELECT run, epoch, CASE WHEN prev_best IS NULL OR metric > prev_best THEN epoch END AS nb FROM a),
c AS (SELECT run, epoch, last_value(nb IGNORE NULLS) OVER (PARTITION BY run ORDER BY epoch
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM b),
s AS (SELECT run, epoch, best, CASE WHEN epoch - best > 1 THEN epoch END AS stop FROM c)
SELECT run, CAST(min(stop) AS BIGINT) AS stop_epoch,
       CAST(coalesce(arg_min(best, stop) FILTER (WHERE stop IS NOT NULL), arg_max(best, epoch))
            AS BIGINT) AS best_epoch
FROM s GROUP BY run
""")
def q_early_stop(spark, sf):
    return rn.early_stop(rn.eval_by_epoch(run_log(spark, sf), ["run"]), ["run"], patience=1)


@query("parse_runs", """
SELECT event_id, event_type AS run, user_id AS user, value, true AS no_early_stopping, true AS wandb FROM events
""")
def q_parse_runs(spark, sf):
    ev = table(spark, sf, "events")
    # bare flags in the middle and at the end, a repeated option, runs of spaces
    line = F.concat_ws(" ", F.lit("python train.py --user 0 --run"), "event_type", F.lit("--no-early-stopping --user"),
                       F.col("user_id").cast("string"), F.lit("  --value"),
                       F.col("value").cast("string"), F.lit("--wandb"))
    out = rn.parse_runs(ev.select("event_id", line.alias("line")), "line",
                        {"run": "string", "user": "long", "value": "double",
                         "no-early-stopping": "boolean", "wandb": "boolean"})
    return out.select("event_id", "run", "user", "value", "no_early_stopping", "wandb")


@query("seed_summary", f"""
WITH {EV},
r AS (SELECT run, user_id % 3 AS seed, arg_max(value, step) AS metric FROM ev GROUP BY run, user_id % 3)
SELECT run, CAST(count(*) AS BIGINT) AS n_runs, round(avg(metric), 9) AS mean,
       round(stddev_samp(metric), 9) AS std, min(metric) AS min, max(metric) AS max
FROM r GROUP BY run
""")
def q_seed_summary(spark, sf):
    log = run_log(spark, sf).withColumn("seed", F.pmod("user_id", F.lit(3)))
    per_run = log.groupBy("run", "seed").agg(F.max_by("value", "step").alias("metric"))
    out = rn.seed_summary(per_run, ["run"])
    return out.select("run", "n_runs", F.round("mean", 9).alias("mean"),
                      F.round("std", 9).alias("std"), "min", "max")


@query("lr_schedule", f"""
WITH {EV}, t AS (SELECT run, max(step) + 1 AS total FROM ev GROUP BY run),
w AS (SELECT ev.run, step, total, CAST(floor(0.06 * total) AS BIGINT) AS wu FROM ev JOIN t USING (run))
SELECT run, step, round(CASE WHEN step < wu THEN step / wu
  ELSE 0.5 * (1 + cos(pi() * (step - wu) / greatest(total - wu, 1))) END, 9) AS lr FROM w
""")
def q_lr(spark, sf):
    log = run_log(spark, sf)
    from textloom.operators.bounded import skew_safe_lookup
    totals = log.groupBy("run").agg((F.max("step") + 1).alias("total"),
                                    F.count(F.lit(1)).alias("w"))
    j = skew_safe_lookup(log, totals.select("run", "total"), ["run"], totals.select("run", "w"))
    j = j.withColumn("wu", F.floor(F.col("total") * 0.06).cast("long"))
    return j.select("run", "step", F.round(rn.lr_at(F.col("step"), F.col("total"), 1.0,
                                                    F.col("wu")), 9).alias("lr"))
