"""Exact percentiles of hot keys, narrow ranges and odd values."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from casegauge.operators import quantiles as Q

PROBS, NAMES = [0.0, 0.0416, 0.5, 0.95, 0.9584, 1.0], ["a", "b", "c", "d", "e", "f"]


def plain(df, keys=("k",), probs=PROBS, names=NAMES):
    out = df.groupBy(*keys).agg(Q.percentile_array("v", probs).alias("p")).where("p is not null")
    return out.select(*keys, *[F.col("p")[i].alias(n) for i, n in enumerate(names)])


@pytest.mark.parametrize("most", [1, 7, Q.MOST])
def test_finer_cells_give_the_same(spark, most):
    rng = random.Random(most)
    rows = [("narrow", 1e6 + rng.random() * 2e4) for _ in range(3000)] + [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(1500)]
    rows += [("ulp", math.nextafter(1.0, 2.0) if i % 2 else 1.0) for i in range(9)] + [("ulps", 1.0 + i * 2 ** -52) for i in range(900)]
    rows += [("tiny", i * 5e-324) for i in range(500)] + [("zero", 0.0), ("zero", -0.0), ("zero", 5e-324), ("zero", -5e-324)]
    rows += [("same", 3.25)] * 400 + [("null", None), (None, 1.0), (None, 2.0), ("odd", float("inf")), ("odd", float("-inf")), ("odd", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    odd = df.where("k = 'odd'")
    rest = df.where("k <> 'odd' or k is null")
    assertDataFrameEqual(Q.ranked_percentiles(rest, ["k"], "v", PROBS, NAMES, most), plain(rest), rtol=0, atol=0)
    assertDataFrameEqual(Q.ranked_percentiles(odd, ["k"], "v", [0.0, 0.5, 1.0], NAMES[:3], most), plain(odd, probs=[0.0, 0.5, 1.0], names=NAMES[:3]))
    assert Q.ranked_percentiles(df.limit(0), ["k"], "v", PROBS, NAMES, most).count() == 0


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), ("x", 3.0)], "k string, v double")
    r = Q.ranked_percentiles(df, ["k"], "v", [0.0, 0.5, 1.0], ["a", "b", "c"]).first()
    assert (r.a, r.b) == (1.0, 3.0) and math.isnan(r.c)


def test_a_hot_key_in_a_narrow_range_stays_spread(spark, monkeypatch):
    """One key, 600 000 distinct values within two percent: the fullest task of every step holds less than a tenth."""
    rows, parts = 600_000, 48
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(parts),
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    fullest = []

    def watched(df, label, store=Q.stored):
        out = store(df.withColumn("_task", F.spark_partition_id()), label)
        fullest.append(out.groupBy("_task").count().agg(F.max("count")).first()[0] or 0)
        return out.drop("_task")

    monkeypatch.setattr(Q, "stored", watched)
    picked = Q._picked

    def last(values, cells, keys):
        out = watched(picked(values, cells, keys), "picked")
        sizes = cells.agg(F.max("_distinct")).first()[0] or 0
        fullest.append(sizes)
        return out

    monkeypatch.setattr(Q, "_picked", last)
    try:
        df = spark.range(0, rows, 1, parts).select(F.lit("hot").alias("k"), (1e6 + F.pmod(F.xxhash64("id"), F.lit(20_000_000)) / 1000).alias("v"))
        got = Q.ranked_percentiles(df, ["k"], "v", PROBS, NAMES)
        assertDataFrameEqual(got, plain(df))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(fullest) >= 6 and max(fullest) < rows / 10
