"""Summaries over rolling windows, from a mergeable state per day.

The state of a metric is how often each pair of value and target occurred, per key and step of time: a day's state is as
large as the metric's domain, whatever the number of samples. States are added up; a window's exact percentiles, deficits
and targets follow from the sum of the states it covers. So a sample is counted once, however many windows it belongs to,
and a stream keeps states instead of samples."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casegauge import CASE
from casegauge.operators.summary import DAY, Metric, metric_columns
from casegauge.sources.tables import overwrite_partition

STEP, BATCH = "_step", "_batch"


def step_states(df: DataFrame, ts: str, metrics: Sequence[Metric], step_days: int = 1, keys: Sequence[str] = CASE) -> DataFrame:
    """keys, `_step` (its start in seconds), `metric`, `value`, `target`, `n`: one row per pair of value and target.

    Null values and targets are counted as such. Rows without a time are left out."""
    step = step_days * DAY
    start = (F.floor(F.col(ts) / step) * step).cast("long").alias(STEP)
    common = df.select(F.array(*[F.col(c) for m in metrics for c in (m.value, m.target)])).schema[0].dataType.elementType
    pair = lambda m: F.struct(F.col(m.value).cast(common).alias("value"), F.col(m.target).cast(common).alias("target")).alias(m.name)
    rows = df.where(F.col(ts).isNotNull()).select(*keys, start, *[pair(m) for m in metrics])
    long = rows.unpivot([*keys, STEP], [m.name for m in metrics], "metric", "pair")
    return (long.select(*keys, STEP, "metric", "pair.value", "pair.target").groupBy(*keys, STEP, "metric", "value", "target")
            .agg(F.count(F.lit(1)).alias("n")))


def summary_of_states(states: DataFrame, days: int, metrics: Sequence[Metric], step_days: int = 1, keys: Sequence[str] = CASE) -> DataFrame:
    """One row per key and window: the columns of `case_summary` with `window_end`. A window covers `days` days up to its
    end, which is left out, and moves by `step_days`. States of one step may come in several rows (of batches, say)."""
    step, width = step_days * DAY, days * DAY
    added = states.groupBy(*keys, STEP, "metric", "value", "target").agg(F.sum("n").alias("n"))
    ends = F.sequence(F.col(STEP) + step, F.col(STEP) + width, F.lit(step).cast("long"))
    aggs = [F.sum(F.when(F.col("metric") == metrics[0].name, F.col("n"))).alias("n_count")]
    for m in metrics:
        aggs += _state_aggs(m)
    wide = added.withColumn("window_end", F.explode(ends)).groupBy(*keys, "window_end").agg(*aggs)
    targets = {m.target_name: F.col(f"_{m.name}_tar").alias(m.target_name) for m in metrics}
    return wide.select(*keys, "window_end", *[c for m in metrics for c in metric_columns(m, False)], *targets.values(), "n_count")


def _state_aggs(m: Metric) -> list[Column]:
    mine = lambda c: F.when(F.col("metric") == m.name, c)
    n, d = F.col("n"), dataclasses.replace(m, value="value", target="target").deficit
    target = {"min": F.min, "max": F.max}[m.target_agg](mine(F.col("target")))
    probs = F.array(*[F.lit(float(p)) for p in m.probs.values()])
    return [F.percentile(mine(F.col("value")), probs, mine(n)).alias(f"_{m.name}_p"), target.alias(f"_{m.name}_tar"),
            F.sum(mine(d * n)).cast("long").alias(f"{m.name}d_area"), F.max(mine(d)).cast("int").alias(f"{m.name}d_max"),
            F.coalesce(F.sum(mine(F.when(d > 0, n))), F.lit(0)).cast("long").alias(f"{m.name}d_freq")]


def rolling_summary(df: DataFrame, ts: str, days: int, metrics: Sequence[Metric], step_days: int = 1, keys: Sequence[str] = CASE) -> DataFrame:
    """The summary of every `days`-day window, one window per `step_days`; half-open: [end - days, end)."""
    return summary_of_states(step_states(df, ts, metrics, step_days, keys), days, metrics, step_days, keys)


def rolling_sink(store: str, ts: str, days: int, metrics: Sequence[Metric], target: str, step_days: int = 1,
                 keys: Sequence[str] = CASE) -> Callable[[DataFrame, int], None]:
    """Batch sink: windows that a batch can touch are made anew from states, never from samples.

    The states of a batch lie by step and batch in `store`, so a repeated batch replaces its own. Then the states of the steps
    within reach are read (literal bounds on the partition column: other folders are not listed) and the windows over the
    batch's steps replace their partitions of `target`."""
    step, width = step_days * DAY, days * DAY

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = step_states(batch, ts, metrics, step_days, keys)
        overwrite_partition(own.withColumn(BATCH, F.lit(number)), store, [STEP, BATCH])
        stored = spark.read.schema(f"{own.schema.toDDL()}, {BATCH} int").parquet(store)
        span = stored.where(F.col(BATCH) == number).agg(F.min(STEP), F.max(STEP)).first()
        if span[0] is None:
            return
        near = stored.where(F.col(STEP).between(span[0] - width + step, span[1] + width - step)).drop(BATCH)
        done = summary_of_states(near, days, metrics, step_days, keys)
        overwrite_partition(done.where((F.col("window_end") > span[0]) & (F.col("window_end") <= span[1] + width)), target, ["window_end"])

    return each
