"""A hot key's rows stay spread over tasks when they meet a figure of their key."""

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from casegauge.operators import joins as J
from casegauge.operators.assignment import duration_share
from casegauge.operators.clusters import region_criticality
from casegauge.operators.lists import items_with_totals
from casegauge.operators.region import region_summary
from casegauge.operators.regression import valid_points
from casegauge.operators.spread import split_join, with_totals

ROWS, PARTS = 600_000, 48


@pytest.fixture()
def skew(spark):
    """Joins are shuffled, and partitions of more than 32 kB are cut."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(PARTS),
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=ROWS):
    """A third of the rows on one key, the others on 5000."""
    i = F.col("id")
    return spark.range(0, n, 1, PARTS).select(F.when(i % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)) + 1).alias("k"),
                                              i, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("v"))


def largest_task(df):
    """Rows that the fullest task puts out, and all rows. The checksum keeps the columns in the rows: tasks are cut by bytes."""
    sums = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)).alias("all"))
    r = sums.where(F.col("all").isNotNull()).agg(F.max("n"), F.sum("n")).first()
    return r[0], r[1]


def spread(df, rows=ROWS):
    most, total = largest_task(df)
    return total == rows and most < rows / 10


def test_a_plain_join_back_is_not_split(skew):
    df = hot(skew)
    most, total = largest_task(df.join(df.groupBy("k").agg(F.sum("v").alias("t")), "k"))
    assert total == ROWS and most >= ROWS / 3  # what the helper is for


def test_totals(skew):
    df = hot(skew)
    out = with_totals(df, ["k"], t=F.sum("v"), n=F.count(F.lit(1)))
    assert spread(out)
    assert out.where("k = 0").agg(F.min("n"), F.max("n")).first() == (ROWS // 3, ROWS // 3)


def test_operators_keep_a_hot_key_spread(skew):
    df = hot(skew)
    assert spread(items_with_totals(df, ["k"]))
    assert spread(J.share_of_total(df, ["k"], "v", "share", "total"))
    assert spread(J.attach_target(df, hot(skew, 90_000).withColumnRenamed("v", "targetvalue"), ["k"]))
    assert spread(valid_points(df.select("k", F.col("v").alias("distance"), F.col("id").cast("double").alias("latency")).where("id < 0 or true")
                               .withColumn("latency", F.lit(5.0)), ["k"]))


def test_assignment_and_criticality_plans_shuffle_for_the_join(skew):
    """The total is no longer partitioned as the join needs it, so that adaptive execution may cut the other side."""
    log = hot(skew, 1000).select(F.col("k").alias("mpgid"), F.lit(1).alias("mrid"), F.lit("u").alias("mpd_uuid"), F.lit(0).cast("long").alias("ts"), F.lit("NS").alias("mpg_type"),
                                 F.col("v").alias("region"), F.lit(1).alias("link"), F.lit(2).alias("cnt"), *[F.lit(1).alias(c) for c in ("min_s", "max_s", "min_r", "max_r")],
                                 F.lit(600.0).alias("dftime"))
    dim = skew.createDataFrame([(i, "1", 1, "c", "c", 1.0, 1.0, "private") for i in range(1000)],
                               "region long, day string, ecor int, continent string, country string, latitude double, longitude double, prp string")
    clusters = skew.createDataFrame([("1:2", "A", 1.0, 1)], "region_list string, geoname string, load double, nmpg long")
    members = skew.createDataFrame([("1:2", 1), ("1:2", 2)], "region_list string, region long")
    allow = skew.createDataFrame([(1, 1), (1, 2), (2, 2)], "maprule int, region long")
    regions = skew.createDataFrame([(1, 1.0, 1.0, 1), (2, 3.0, 1.0, 1)], "region long, bit_gbps double, flit_gfps double, numvips int")
    samples = hot(skew, 1000).select(F.col("k").alias("maprule"), F.lit("A").alias("geoname"), F.lit("n").alias("netname"), F.col("v").alias("region"), *[
        F.lit(1.0).alias(c) for c in ("score", "nsd_demand", "eu_demand", "ra_load", "case_percent_pre_norm_load", "case_percent_load", "recorded_load_percentage")])
    for df in (duration_share(log, dim), region_criticality(clusters, members, allow, regions), region_summary(samples, dim, None, ["maprule", "geoname", "netname"])):
        text = df._jdf.queryExecution().executedPlan().toString()
        marked = [line for line in text.splitlines() if "SortMergeJoin" in line and "_spread" in line]
        assert marked
        # both inputs of such a join are shuffled by a hash that has the extra column
        assert sum("_spread" in line for line in text.splitlines() if "Exchange hashpartitioning" in line) >= 2 * len(marked)
        assert df.count() > 0


def test_nulls_names_and_kinds(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c"), (3, 4, "d")], "x int, y int, v string")
    totals = spark.createDataFrame([(1, None, 10), (1, 2, 20), (None, None, 30)], "x int, y int, t int")
    got = lambda df: sorted((r.v, r.t) for r in df.collect())
    assert got(split_join(rows, totals, ["x", "y"], nulls=True)) == [("a", 10), ("b", 20), ("c", 30)]
    assert got(split_join(rows, totals, ["x", "y"])) == [("b", 20)]
    assert split_join(rows, totals, ["x", "y"]).columns == ["x", "y", "v", "t"]
    left = split_join(rows, totals, ["x", "y"], "left", nulls=True)
    assert [(r.v, r.t) for r in left.orderBy("v").collect()] == [("a", 10), ("b", 20), ("c", 30), ("d", None)]
    assertDataFrameEqual(with_totals(rows, ["x"], n=F.count("*")).select("v", "n"),
                         spark.createDataFrame([("a", 2), ("b", 2), ("c", 1), ("d", 1)], "v string, n long"))
    assert with_totals(rows.limit(0), ["x"], n=F.count("*")).count() == 0


def test_one_key_and_day_of_an_asof_join_is_cut(skew, monkeypatch):
    """A third of the asked times and of the right rows lies in one key and one day; half of it at one instant."""
    n = 300_000
    i = F.col("id")
    time = F.when(i % 3 == 0, F.when(i % 2 == 0, F.lit(1000.5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(86_400_000)) / 1000)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10 ** 10)) / 1000)
    left = skew.range(0, n, 1, PARTS).select(F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (i % 50).cast("string"))).alias("k"), time.alias("t"), i)
    right = left.where(i % 2 == 1).select("k", F.col("t").alias("rt"), F.col("id").alias("v"))
    fullest = []

    def watched(df, label, store=J.stored):
        out = store(df, label)
        fullest.append(out.groupBy("k", "_slice").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(J, "stored", watched)
    out = J.asof_join(left, right, ["k"], "t", "rt", ["v"])
    most, total = largest_task(out.fillna({"rt": 0.0, "v": 0}))
    assert total == n and most < n / 10 and max(fullest) < n / 10
    bad = out.where("rt >= t").count()
    assert bad == 0 and out.where("k = 'hot' and rt is null").count() <= 2
