"""Windowed summaries per case: percentiles, deficits, cycle strength, load.

A `Metric` describes one measured column; a list of them generates the whole aggregate list, so
every summary is a single scan and a single shuffle on the keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge import CASE
from casegauge.functions.metrics import excess_over, shortfall
from casegauge.functions.times import at_least, before
from casegauge.operators.quantiles import null_safe_join, percentile_array, ranked_percentiles

# Time-percentile labels and their probabilities.
HIGH_IS_BAD = {"t95": 0.9584, "t90": 0.9167, "t85": 0.8572, "t75": 0.75, "t50": 0.5}
LOW_IS_BAD = {"t95": 0.0416, "t90": 0.0832, "t85": 0.1428, "t75": 0.25, "t50": 0.5}

WEEKLY_BIN, DAILY_BIN, SLOTS = 2, 14, 2016
DAY = 86400


@dataclass(frozen=True)
class Metric:
    """`value` is a small-domain integer column, `target` its target column."""

    name: str
    value: str
    target: str
    target_name: str
    low_is_bad: bool = False
    target_agg: str = "min"
    cycle_scale: float = 100.0
    cycle_digits: int = 2
    damped_by_ping: bool = False
    short: str | None = None

    @property
    def deficit(self) -> Column:
        return (shortfall if self.low_is_bad else excess_over)(self.value, self.target)

    @property
    def probs(self) -> dict[str, float]:
        return LOW_IS_BAD if self.low_is_bad else HIGH_IS_BAD


def score_metric(level: str) -> Metric:
    return Metric(f"sp{level}", f"sp{level}", "star", "star", cycle_scale=1.0, cycle_digits=4, damped_by_ping=True)


def distance_metric(level: str) -> Metric:
    return Metric(f"dp{level}", f"dp{level}", "dtar", "dtar")


LEVELS = ("99", "95", "90", "75")
STANDARD = (*[score_metric(x) for x in LEVELS], *[distance_metric(x) for x in LEVELS],
            Metric("icy", "icy_pct", "icy_tar", "icy_tar", low_is_bad=True),
            Metric("ict", "ict_pct", "ict_tar", "ict_tar", low_is_bad=True))
WITH_IO = (*STANDARD, Metric("io", "ioratio", "ioratio_tar", "io_tar", target_agg="max"))


def time_window(df: DataFrame, ts: str, start: int, end: int, bounds: str = "()") -> DataFrame:
    """Rows inside a window; `()` excludes both ends, `[)` keeps the start.

    The bounds are seconds; the column may be a number of seconds, a date or a timestamp. They become plain comparisons on
    the column, so they prune partitions and reach the scan.
    """
    return df.where(at_least(df, ts, start, strict=bounds[0] == "(") & before(df, ts, end, strict=bounds[1] == ")"))


def recent(df: DataFrame, ts: str, now: int, seconds: int = 300) -> DataFrame:
    """Samples newer than `now - seconds`; the column as in `time_window`."""
    return df.where(at_least(df, ts, now - seconds, strict=True))


def slot_numbers(df: DataFrame, ts: str, start: int | None = None, step: int = 600) -> DataFrame:
    """ts + slot: rank of the timestamp among all timestamps, or the elapsed steps from `start`.

    The global rank runs over distinct timestamps only: their number is bounded by the window
    length over the sampling step, not by the data.
    """
    stamps = df.select(ts).distinct()
    if start is not None:
        return stamps.withColumn("slot", F.floor((F.col(ts) - start) / step).cast("int") + 1)
    return stamps.withColumn("slot", F.row_number().over(W.orderBy(ts)))


def fourier_basis(slot="slot", period: int = SLOTS, bins: Sequence[int] = (WEEKLY_BIN, DAILY_BIN)) -> list[Column]:
    """cos/sin columns of the wanted frequency bins for a slot number starting at 1."""
    out = []
    for b in bins:
        angle = (F.col(slot) - 1) * F.lit(-2.0 * math.pi * b / period)
        out += [F.cos(angle).alias(f"cos{b}"), F.sin(angle).alias(f"sin{b}")]
    return out


def with_basis(df: DataFrame, ts: str, period: int = SLOTS, **slots) -> DataFrame:
    """Samples joined to the Fourier basis on their timestamp."""
    basis = slot_numbers(df, ts, **slots).select(ts, "slot", *fourier_basis("slot", period))
    return df.join(basis, ts)


def cycle_strength(value, b: int) -> Column:
    """Aggregate: magnitude of one frequency bin over the sum of the series."""
    v = F.col(value).cast("double")
    re, im, total = F.sum(v * F.col(f"cos{b}")), F.sum(v * F.col(f"sin{b}")), F.sum(v)
    return F.when(total > 0, F.try_divide(F.sqrt(re * re + im * im), total)).otherwise(F.lit(0.0))


def _metric_aggs(m: Metric) -> list[Column]:
    d = m.deficit
    target = {"min": F.min, "max": F.max}[m.target_agg](m.target)
    return [percentile_array(m.value, list(m.probs.values())).alias(f"_{m.name}_p"),
            target.alias(f"_{m.name}_tar"),
            F.sum(d).cast("long").alias(f"{m.name}d_area"),
            F.max(d).cast("int").alias(f"{m.name}d_max"),
            F.count_if(d > 0).cast("long").alias(f"{m.name}d_freq")]


def metric_columns(m: Metric, cycles: bool) -> list[Column]:
    """A metric's columns from its aggregates."""
    cols = [F.col(f"_{m.name}_p")[i].cast("int").alias(f"{m.name}_{label}") for i, label in enumerate(m.probs)]
    cols += [F.col(f"{m.name}d_{x}") for x in ("area", "max", "freq")]
    area, n, tar = F.col(f"{m.name}d_area").cast("double"), F.col("n_count"), F.col(f"_{m.name}_tar")
    if m.low_is_bad:
        mean = F.try_divide(F.lit(100.0) * area, (n * (F.lit(100) - tar)).cast("double"))
    else:
        mean = F.try_divide(F.try_divide(area, n.cast("double")), tar.cast("double")) * 100.0
    mean = F.when(F.col(f"{m.name}d_freq") > 0, F.round(mean, 2)).otherwise(F.lit(0.0))
    cols.append(mean.alias(f"avg_{m.name}d"))
    if cycles:
        quiet = F.try_divide(F.col("zero_ping_count").cast("double"), n.cast("double")) > 0.2
        for b, label in ((WEEKLY_BIN, "cw"), (DAILY_BIN, "cd")):
            c = F.col(f"_{m.name}_c{b}")
            if m.damped_by_ping:
                c = F.when(quiet, F.lit(0.0)).otherwise(c)
            cols.append(F.round(c * m.cycle_scale, m.cycle_digits).alias(f"{m.name}_{label}"))
    return cols


def case_summary(df: DataFrame, metrics: Sequence[Metric] = STANDARD, keys: Sequence[str] = CASE,
                 cycles: bool = False, ping: str | None = None) -> DataFrame:
    """One row per key: truncated time percentiles, deficit area/max/frequency, mean deficit %,
    and, with `cycles`, weekly and daily cycle strength (input from `with_basis`)."""
    keys = list(keys)
    aggs = [F.count(F.lit(1)).alias("n_count")]
    if cycles or ping:
        aggs.append(F.count_if(F.col(ping or "ping_bps") < 1).cast("long").alias("zero_ping_count"))
    for m in metrics:
        aggs += _metric_aggs(m)
        if cycles:
            aggs += [cycle_strength(m.value, b).alias(f"_{m.name}_c{b}") for b in (WEEKLY_BIN, DAILY_BIN)]
    wide = df.groupBy(*keys).agg(*aggs)
    cols = [c for m in metrics for c in metric_columns(m, cycles)]
    targets = {m.target_name: F.col(f"_{m.name}_tar").alias(m.target_name) for m in metrics}
    if cycles or ping:
        zp = F.round(F.try_divide(F.col("zero_ping_count").cast("double"), F.col("n_count").cast("double")) * 100.0, 2)
        cols += [F.col("zero_ping_count"), zp.alias("zp_ratio")]
    return wide.select(*keys, *cols, *targets.values(), "n_count")


def load_stats(df: DataFrame, keys: Sequence[str] = CASE, load="total_bps", ping="ping_bps",
               p2t="p2t_bps_pct") -> DataFrame:
    """95th percentile of load, ping volume in mega units, least ping share.

    Loads have no small domain, so the percentile is ranked instead of held in one buffer."""
    keys = list(keys)
    peak = ranked_percentiles(df, keys, load, [0.95], ["_p"])
    rest = df.groupBy(*keys).agg(F.round(F.sum(F.col(ping)).cast("double") / 1024 / 1024, 4).alias("ping_mbps"),
                                 F.min(p2t).alias("p2t_bps_pct_min"))
    return null_safe_join(rest, peak, keys, "left").select(*keys, F.round("_p", 4).alias("peak95_kbps"), "ping_mbps", "p2t_bps_pct_min")


def average_load(df: DataFrame, keys: Sequence[str] = CASE, load="total_bps", scale=8.0) -> DataFrame:
    """scale * sum / count per case, rounded to 3 places."""
    mean = F.try_divide(F.lit(float(scale)) * F.sum(load).cast("double"), F.count(F.lit(1)).cast("double"))
    return df.groupBy(*keys).agg(F.round(mean, 3).alias("stat_bps"))


def io_rollup_summary(df: DataFrame, keys: Sequence[str] = CASE,
                      counters: Sequence[str] = ("nsd_demand", "eu_demand", "ra_load", "hits", "connections", "disk"),
                      ratios: Sequence[str] = ("in_out_ratio", "b2f_ratio"), mixed: Sequence[str] = ("m_cpu",),
                      prob: float = 0.9584) -> DataFrame:
    """High percentile and mean per case. The mean carries the label `t50`, as consumers expect.

    Ratios are ranked in thousandths. All values are unbounded, hence the ranked percentile, for
    all columns at once over (column, value) pairs."""
    keys = list(keys)
    thousandth = lambda c: (F.col(c) * 1000).cast("long")
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("v")) for c in counters]
    pairs += [F.struct(F.lit(c).alias("name"), thousandth(c).alias("v")) for c in (*ratios, *mixed)]
    long = df.select(*keys, F.explode(F.array(*pairs)).alias("m")).select(*keys, "m.name", "m.v")
    p = ranked_percentiles(long, [*keys, "name"], "v", [prob], ["p"])
    pick = lambda c: F.max(F.when(F.col("name") == c, F.col("p")))
    top = p.groupBy(*keys).agg(*[pick(c).cast("long").alias(f"{c}_t95") for c in counters],
                               *[F.round(pick(c) / 1000, 3).alias(f"{c}_t95") for c in (*ratios, *mixed)])
    mean = df.groupBy(*keys).agg(*[F.avg(c).cast("long").alias(f"{c}_t50") for c in (*counters, *mixed)],
                                 *[F.round(F.avg(c), 3).alias(f"{c}_t50") for c in ratios],
                                 F.count(F.lit(1)).alias("case_count"))
    return null_safe_join(mean, top, keys, "left").select(*keys, *[c for c in top.columns if c not in keys],
                                                          *[c for c in mean.columns if c not in keys])
