"""Joins of rows with a small figure per key (a total, a target, a date) that keep a hot key spread over tasks.

A grouped total is partitioned by its key already, so a plain join with it brings all rows of a key into one task, and
adaptive execution cannot divide that task, because one of its sides is no shuffle. Here the join has one more column,
made from the keys, on both sides. It changes no result, but neither side is partitioned that way yet: both are shuffled
for the join, and the skew rule cuts the partition of a hot key into pieces, each of which meets the one row of the
total. A total that turns out small is broadcast by its measured size, and nothing of the large side is moved."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def split_join(rows: DataFrame, totals: DataFrame, keys: Sequence[str], how: str = "inner", nulls: bool = False) -> DataFrame:
    """`rows` with the other columns of `totals`, which has at most one row for each value of the keys; `how` is inner or left.

    Null keys meet each other only with `nulls`. The keys come from `rows`; other names must differ."""
    keys = list(keys)
    left = rows.withColumn("_spread", _mark(keys))
    right = totals.withColumn("_spread", _mark(keys)).withColumnsRenamed({c: f"_of_{c}" for c in [*totals.columns, "_spread"]})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) if nulls else F.col(k) == F.col(f"_of_{k}") for k in keys]
    on = functools.reduce(lambda a, b: a & b, [*same, F.col("_spread") == F.col("_of__spread")])
    added = [F.col(f"_of_{c}").alias(c) for c in totals.columns if c not in keys]
    return left.join(right, on, how).select(*[F.col(c) for c in rows.columns], *added)


def _mark(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 20)).cast("int")


def with_totals(rows: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """`rows` with totals over the rows of their keys, by name. Null is a key like others, as in a grouping."""
    grouped = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return split_join(rows, grouped, keys, nulls=True)
