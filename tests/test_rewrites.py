"""Rewrites against their plain forms, on random and on skewed rows."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from casegauge.functions.geo import EARTH_RADIUS_MILES
from casegauge.operators import joins as J
from casegauge.operators.lists import explode_list, first_items, items_with_totals, joined_lists
from casegauge.operators.quantiles import percentile_array, ranked_percentiles
from casegauge.operators.summary import io_rollup_summary
from casegauge.operators.topn import top_n_per_key


def skewed(spark, n=3000, seed=1):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(10**6) / 100 - 2000, i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, v double, id long").repartition(7)


def test_ranked_percentiles_equal_the_built_in(spark):
    df = skewed(spark).unionByName(spark.createDataFrame([("one", 5.0, 0), ("nul", None, 0), ("two", 0.0, 0), ("two", -0.0, 1), ("hot", None, 2)], "k string, v double, id long"))
    probs = [0.0, 0.0416, 0.5, 0.9584, 1.0]
    names = ["a", "b", "c", "d", "e"]
    want = df.groupBy("k").agg(percentile_array("v", probs).alias("p")).where("p is not null").select("k", *[F.col("p")[i].alias(n) for i, n in enumerate(names)])
    assertDataFrameEqual(ranked_percentiles(df, ["k"], "v", probs, names), want)


def test_io_summary_equals_plain_aggregates(spark):
    df = skewed(spark).select(F.lit(1).alias("maprule"), F.col("k").alias("geoname"), F.lit("n").alias("netname"), F.col("id").alias("ra_load"),
                              F.round(F.col("v"), 3).alias("io"), (F.col("v") / 7).alias("cpu"))
    got = io_rollup_summary(df, counters=["ra_load"], ratios=["io"], mixed=["cpu"])
    want = df.groupBy("maprule", "geoname", "netname").agg(
        F.percentile("ra_load", 0.9584).cast("long").alias("ra_load_t95"),
        F.round(F.percentile((F.col("io") * 1000).cast("long"), 0.9584) / 1000, 3).alias("io_t95"),
        F.round(F.percentile((F.col("cpu") * 1000).cast("long"), 0.9584) / 1000, 3).alias("cpu_t95"),
        F.avg("ra_load").cast("long").alias("ra_load_t50"), F.avg("cpu").cast("long").alias("cpu_t50"), F.round(F.avg("io"), 3).alias("io_t50"),
        F.count("*").alias("case_count"))
    assertDataFrameEqual(got, want.select(got.columns))


def test_wildcard_join_equals_or_join(spark):
    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    t = spark.createDataFrame([(rng.randrange(3), pick("GLOBAL", "US", "DE", ""), pick("ANY", "n1", "n2", "")) for _ in range(60)],
                              "maprule int, geoname string, netname string").distinct()
    c = spark.createDataFrame([(i, rng.randrange(3), pick("", "US", "DE", "GLOBAL"), pick("", "n1", "ANY")) for i in range(200)],
                              "id int, mapruleid int, geo string, aslist string")
    t.createOrReplaceTempView("wt")
    c.createOrReplaceTempView("wc")
    want = spark.sql("""select * from wt a, wc b where a.maprule = b.mapruleid and (a.geoname = b.geo or a.geoname = 'GLOBAL' and b.geo = '')
                        and (a.netname = b.aslist or a.netname = 'ANY' and b.aslist = '')""")
    assert want.count() > 50
    assertDataFrameEqual(J.wildcard_join(t, c).select(want.columns), want)


def test_baseline_pivot_join_equals_self_joins(spark):
    rng = random.Random(4)
    rows = [(r, f"G{g}", f"N{n}", rng.randrange(4) * 1.0, rng.randrange(3) * 1.0) for r in range(6) for g in range(8) for n in range(3) if rng.random() < 0.7]
    s = spark.createDataFrame(rows, "maprule int, geoname string, netname string, x double, y double")
    s.createOrReplaceTempView("bs")
    want = spark.sql("""select b.*, g.x g_x, d.x d_x, g.y g_y, d.y d_y from bs b join (select * from bs where maprule = 1) g using (geoname, netname)
                        join (select * from bs where maprule = 4) d using (geoname, netname) where b.x > 0 or b.y > 0""")
    got = J.baseline_join(s, {"g": 1, "d": 4}, ["x", "y"])
    assert want.count() > 10
    assertDataFrameEqual(got.select(sorted(got.columns)), want.select(sorted(got.columns)))


def points(rng, n):
    fixed = [(90.0, 0.0), (-90.0, 50.0), (89.9, 170.0), (0.0, 180.0), (0.0, -179.9), (0.0, 0.0), (0.0, 0.0)]
    return fixed + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]


@pytest.mark.parametrize("miles", [120.0, 500.0, 4000.0, 13000.0])
def test_distance_join_equals_brute_force(spark, miles):
    rng = random.Random(5)
    a, b = points(rng, 80), points(rng, 80)
    l = spark.createDataFrame([(i, *p) for i, p in enumerate(a)], "i int, lat double, lon double")
    r = spark.createDataFrame([(j, *p) for j, p in enumerate(b)], "j int, rg_lat double, rg_lon double")

    def apart(p, q):
        la, lb, dl = math.radians(p[0]), math.radians(q[0]), math.radians(q[1] - p[1])
        s = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(dl / 2) ** 2
        return 2 * EARTH_RADIUS_MILES * math.atan2(math.sqrt(s), math.sqrt(max(0.0, 1 - s)))

    want = sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if apart(p, q) < miles)
    got = sorted((x.i, x.j) for x in J.distance_join(l, r, miles).select("i", "j").collect())
    assert got == want and want


def test_left_distance_join_keeps_lonely_rows(spark):
    l = spark.createDataFrame([(1, 0.0, 0.0), (2, 60.0, 60.0)], "i int, lat double, lon double")
    r = spark.createDataFrame([(7, 0.1, 0.1)], "j int, rg_lat double, rg_lon double")
    assert sorted((x.i, x.j) for x in J.distance_join(l, r, 100.0, how="left").collect()) == [(1, 7), (2, None)]


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_equals_brute_force(spark, strict):
    rng = random.Random(6)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(4)}"
    left = [(i, key(), rng.randrange(2000)) for i in range(300)]
    right = list({(key(), rng.randrange(2000)): None for _ in range(120)})
    l = spark.createDataFrame(left, "id int, k string, t int")
    r = spark.createDataFrame([(k, t, f"{k}@{t}") for k, t in right], "k string, rt int, v string")
    got = {x.id: (x.rt, x.v) for x in J.asof_join(l, r, ["k"], "t", "rt", ["v"], strict).collect()}
    for i, k, t in left:
        best = max((rt for rk, rt in right if rk == k and (rt < t if strict else rt <= t)), default=None)
        assert got[i] == ((best, f"{k}@{best}") if best is not None else (None, None))
    assert len(got) == len(left)


def test_asof_join_of_nulls_and_ties(spark):
    l = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, None, 5), (4, "a", None), (5, "b", 9)], "id int, k string, t int")
    r = spark.createDataFrame([("a", 3, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 4, "n"), ("b", 9, "same")], "k string, rt int, v string")
    got = {x.id: (x.rt, x.v) for x in J.asof_join(l, r, ["k"], "t", "rt", ["v"]).collect()}
    assert got == {1: (3, "y"), 2: (3, "y"), 3: (4, "n"), 4: (None, None), 5: (None, None)}
    assert {x.id: x.v for x in J.asof_join(l, r, ["k"], "t", "rt", ["v"], strict=False).collect()}[5] == "same"
    assert J.asof_join(l, r.limit(0), ["k"], "t", "rt", ["v"]).where("rt is null").count() == 5
    assert J.asof_join(l.limit(0), r, ["k"], "t", "rt", ["v"]).count() == 0


def test_share_of_total(spark):
    df = skewed(spark).groupBy("k", "id").agg(F.count("*").alias("n"))
    got = J.share_of_total(df, ["k"], "n", "share", "total")
    assert got.count() == 3000 and got.where("k = 'hot'").select("total").distinct().first().total == 1000


def test_long_and_joined_lists_hold_every_item(spark):
    df = skewed(spark).select("k", "id")
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.id)
    long = items_with_totals(df, ["k"], "n")
    assert sorted((r.k, r.id, r.n) for r in long.collect()) == sorted((k, i, len(x)) for k, x in want.items() for i in x)
    out = joined_lists(df, ["k"], {"ids": F.col("id")}, [F.col("id")])
    assert {r.k: (r["items"], [int(i) for i in r.ids.split(":")]) for r in out.collect()} == {k: (len(x), sorted(x)) for k, x in want.items()}
    assertDataFrameEqual(explode_list(out, ["k"], "ids", "id").select("k", F.col("id").cast("long")), df)
    first = first_items(df, ["k"], "id", 5, "first")
    assert {r.k: (r["items"], r["first"]) for r in first.collect()} == {k: (len(x), ":".join(map(str, sorted(x)[:5]))) for k, x in want.items()}


def test_top_n_on_a_hot_key(spark):
    out = top_n_per_key(skewed(spark), ["k"], [F.col("v").desc(), "id"], 5)
    w = {}
    for r in skewed(spark).collect():
        w.setdefault(r.k, []).append((-r.v, r.id))
    assert sorted((r.k, r.id) for r in out.collect()) == sorted((k, i) for k, x in w.items() for _, i in sorted(x)[:5])
