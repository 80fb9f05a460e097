"""Exact, interpolated percentiles.

Two forms with the same result:

* `percentile_array`: Spark's `percentile`. Its buffer is a value -> count map that is combined
  on the map side, so a hot key costs one map of *distinct* values. Right for metrics with a small
  domain (scores, miles, percents as integers), whatever the number of rows.
* `ranked_percentiles`: for metrics without such a bound (loads, bytes). Values are counted per
  (key, value) and laid into order-preserving cells; only cells that hold a wanted rank are looked into. A cell
  with many distinct values is cut into finer cells, again and again, until those that hold a wanted rank are small. So
  no task holds a whole key, nor all values of a narrow range.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge.functions.metrics import as_col
from casegauge.operators.spread import split_join
from casegauge.sources.tables import stored

CELLS_PER_DOUBLING = 16
FINER = 1024  # parts of a cell that is cut
MOST = 4096  # distinct values of a cell that is not cut


def percentile_array(value, probs: Sequence[float]) -> Column:
    """All probabilities of one column from a single aggregation buffer."""
    return F.percentile(as_col(value), F.array(*[F.lit(float(p)) for p in probs]))


def _cell(v: Column) -> Column:
    """Order-preserving cell number, 16 cells per doubling of |v|; zero, infinities and NaN (the largest) have their own."""
    size = F.floor(F.log2(F.abs(v)) * CELLS_PER_DOUBLING).cast("int") + 20_000
    inner = F.when(v > 0, size).when(v < 0, -size).otherwise(0)
    last = F.lit(100_000)
    return F.when(F.isnan(v), last + 1).when(v == float("inf"), last).when(v == float("-inf"), -last).otherwise(inner)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null: null meets null, as in a grouping. The keys come from the left side."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def ranked_percentiles(df: DataFrame, keys: Sequence[str], value, probs: Sequence[float],
                       names: Sequence[str], most: int = MOST) -> DataFrame:
    """keys + one double column per probability; null values are ignored as in `percentile`, null keys are keys.

    Every level looks at the cells of the level before that hold a wanted rank and more than `most` distinct values. A
    cell spans a sixteenth of a doubling, and each level cuts it by 1024, so five levels part even neighbouring doubles.
    Cells are known by their key, the path of the cells around them (`_in`) and their place in the last one (`_part`)."""
    keys = list(keys)
    cell = [*keys, "_in", "_part"]
    values = (df.select(*keys, as_col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    values = stored(values.select("*", F.lit("").alias("_in"), _cell(F.col("_v")).alias("_part")), "counts")

    picks, around = [], None
    while True:
        cells = stored(_wanted(values, keys, around, probs), "cells")
        picks.append(_picked(values, cells.where(F.col("_distinct") <= most), keys))
        around = cells.where(F.col("_distinct") > most)
        if not around.limit(1).count():
            break
        finer = F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * FINER).cast("int")
        inside = split_join(values, around.select(*cell, "_low", "_high"), cell, nulls=True)
        values = stored(inside.select(*keys, "_v", "_c", F.concat_ws("/", "_in", F.col("_part").cast("string")).alias("_in"),
                                      F.least(finer, F.lit(FINER - 1)).alias("_part")), "counts")
        around = around.select(*keys, F.concat_ws("/", "_in", F.col("_part").cast("string")).alias("_in"), F.col("_before").alias("_ahead"), "_total")

    picked = functools.reduce(DataFrame.unionByName, picks)
    aggs = [F.max("_total").alias("_total")]
    for i, _ in enumerate(probs):
        for side in ("lo", "hi"):
            hit = (F.col("_hit.i") == i) & (F.col("_hit.side") == side)
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}{i}"))
    out = picked.groupBy(*keys).agg(*aggs)
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos, lo, hi = _position(p), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        mixed = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        cols.append(F.when(lo == hi, lo).otherwise(mixed).alias(name))
    return out.select(*keys, *cols)


def _position(p: float) -> Column:
    return (F.col("_total") - 1) * F.lit(float(p))


def _wanted(values: DataFrame, keys: list[str], around: DataFrame | None, probs: Sequence[float]) -> DataFrame:
    """The cells that hold a wanted rank: rows in front of them (`_before`), distinct values, range, and ranks inside (`_want`).

    Running sums go over the cells of one key, or of one cell that was cut: a bounded number of rows."""
    cells = values.groupBy(*keys, "_in", "_part").agg(
        F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    ahead = W.partitionBy(*keys, "_in").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    if around is None:
        cells = cells.withColumn("_total", F.sum("_n").over(W.partitionBy(*keys, "_in")))
    else:
        cells = null_safe_join(cells, around, [*keys, "_in"]).withColumn("_before", F.col("_before") + F.col("_ahead")).drop("_ahead")
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), (rank(_position(p)) - F.col("_before")).cast("long").alias("at"))
                       for i, p in enumerate(probs) for side, rank in (("lo", F.floor), ("hi", F.ceil))])
    cells = cells.withColumn("_want", F.filter(wanted, lambda w: (w["at"] >= 0) & (w["at"] < F.col("_n"))))
    return cells.where(F.size("_want") > 0)


def _picked(values: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """The values at the wanted ranks of small cells."""
    cell = [*keys, "_in", "_part"]
    inside = W.partitionBy(*cell).orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    hit = F.filter("_want", lambda w: (w["at"] >= F.col("_first")) & (w["at"] < F.col("_first") + F.col("_c")))
    return (split_join(values, cells.select(*cell, "_total", "_want"), cell, nulls=True)
            .withColumn("_first", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
            .select(*keys, "_v", "_total", F.explode(hit).alias("_hit")))
