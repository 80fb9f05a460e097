"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casegauge.llm.common import dropped, stored
from casegauge.operators.spread import split_join


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    around = _neighbours(edges)
    low = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return split_join(around.where("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    others = split_join(down, low, ["a"]).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Pairs of numbers `a`, `b` -> `node`, `root` (the smallest node that it reaches) for every node with
    an edge to another. Each round is written to the shared folder. Each step is a partial aggregate and a join that
    leaves the edges of a hot node spread over tasks."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    old = state(now)
    while old[0]:
        before, now = now, stored(_small(_large(now)), "stars")
        dropped(before)
        new = state(now)
        if new == old:
            break
        old = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
