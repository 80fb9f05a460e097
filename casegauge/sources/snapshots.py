"""Choosing, checking and retiring snapshots (partitions) of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from casegauge.functions.times import at_least


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest snapshot. The maximum is one row, joined back at run time; on a partition
    column it prunes the scan dynamically."""
    newest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(newest), column, "left_semi")


def enrich_latest(fact: DataFrame, dim: DataFrame, key: str, snapshot: str, how: str = "inner") -> DataFrame:
    """Facts joined to the newest snapshot of a dimension."""
    return fact.join(latest_partition(dim, snapshot).drop(snapshot), key, how)


def asof_partition(parts: DataFrame, column: str, target, strict: bool = False) -> DataFrame:
    """One row: the newest snapshot at or before (strictly before) the target."""
    ok = F.col(column) < target if strict else F.col(column) <= target
    return parts.agg(F.max(F.when(ok, F.col(column))).alias(column))


def retain(df: DataFrame, column: str, now: int, ttl: int, inclusive: bool = True) -> DataFrame:
    """Rows not older than ttl; the column holds seconds, dates or timestamps. `inclusive` keeps a row exactly at the limit.
    For the partitions of a table see `partitions.retain_partitions`."""
    return df.where(at_least(df, column, now - ttl, strict=not inclusive))


def missing_partitions(present: DataFrame, keys: Sequence[str], column: str, step: int) -> DataFrame:
    """Expected but absent steps between the first and last one present, per key."""
    keys = list(keys)
    span = present.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    expected = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.lit(step).cast("long"))).alias(column))
    return expected.join(present.select(*keys, column).distinct(), [*keys, column], "left_anti")


def last_hours(present: DataFrame, column: str, now: int, hours: int = 6, step: int = 3600) -> DataFrame:
    """Absent steps among the last `hours` before now (the backfill list)."""
    spark = present.sparkSession
    top = now // step * step - step
    expected = spark.range(top - (hours - 1) * step, top + 1, step).select(F.col("id").alias(column))
    return expected.join(present.select(column).distinct(), column, "left_anti")


def thin_snapshots(dates: DataFrame, column: str, today, recent_days: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """Keep the first snapshot of every ISO week and all of the last days.

    Input: distinct snapshot dates; their number is bounded by the calendar."""
    keys = list(keys)
    day = F.col(column)
    monday = F.date_trunc("week", day)
    first = dates.groupBy(*keys, monday.alias("_week")).agg(F.min(column).alias("_first"))
    tagged = dates.withColumn("_week", monday).join(first, [*keys, "_week"])
    keep = (day == F.col("_first")) | (F.datediff(F.lit(today).cast("date"), day) <= recent_days)
    return tagged.where(keep).drop("_week", "_first")


def last_good_snapshot(df: DataFrame, column: str, min_rows: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest snapshot (per key) with more than min_rows rows: a short feed is passed over."""
    keys = list(keys)
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_rows)
    best = counts.groupBy(*keys).agg(F.max(column).alias(column))
    return df.join(best, [*keys, column], "left_semi")
