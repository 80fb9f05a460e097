"""Sums over near sites against all pairs, and the work that a crowd makes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from casegauge.functions.geo import EARTH_RADIUS_MILES
from casegauge.operators import clusters as C, nearby as N


def miles_apart(p, q):
    la, lb, dl = math.radians(p[0]), math.radians(q[0]), math.radians(q[1] - p[1])
    s = min(1.0, math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(dl / 2) ** 2)
    return 2 * EARTH_RADIUS_MILES * math.atan2(math.sqrt(s), math.sqrt(1 - s))


def points(rng, n, crowd=0, around=(40.0, 10.0), width=0.5):
    fixed = [(90.0, 0.0), (-90.0, 50.0), (89.9, 170.0), (0.0, 180.0), (0.0, -179.9), (0.0, 0.0), (0.0, 0.0)]
    close = [(around[0] + rng.uniform(-width, width), around[1] + rng.uniform(-width, width)) for _ in range(crowd)]
    return fixed + close + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]


def frames(spark, a, b):
    l = spark.createDataFrame([(i, *p) for i, p in enumerate(a)], "i int, lat double, lon double")
    r = spark.createDataFrame([(*p, k % 7, k / 8) for k, p in enumerate(b)], "rg_lat double, rg_lon double, n long, w double")
    return l.repartition(4), r.repartition(3)


@pytest.mark.parametrize("miles", [0.5, 30.0, 500.0, 4000.0, 13000.0])
@pytest.mark.parametrize("few", [4, N.FEW])
def test_sums_equal_brute_force(spark, miles, few):
    rng = random.Random(int(miles))
    a, b = points(rng, 50, 60, width=miles / 100), points(rng, 50, 60, width=miles / 60)
    l, r = frames(spark, a, b)
    got = {x.i: (x.total, x.weight) for x in N.nearby_sums(l, r, miles, {"total": "n", "weight": "w"}, few=few).collect()}
    for i, p in enumerate(a):
        near = [k for k, q in enumerate(b) if miles_apart(p, q) < miles]
        assert got[i] == (sum(k % 7 for k in near), sum(k / 8 for k in near)), i
    assert len(got) == len(a)


def test_a_crowded_cell_costs_its_cells(spark, monkeypatch):
    """A third of the sites of both sides lies in one cell of the first grid: a million near pairs, few comparisons."""
    rng = random.Random(1)
    a, b = points(rng, 2000, 1000, width=2.0), points(rng, 2000, 1000, width=2.0)
    l, r = frames(spark, a, b)
    work = []

    def watched(df, label, store=N.stored):
        out = store(df, label)
        if label == "pairs":
            few = out.where("_case = 'few'").agg(F.sum(F.col("_nl") * F.col("_nr"))).first()[0] or 0
            work.append((out.count(), few))
        return out

    monkeypatch.setattr(N, "stored", watched)
    got = {x.i: x.total for x in N.nearby_sums(l, r, 500.0, {"total": "n"}).collect()}
    assert sum(got[i] for i in range(7, 1007)) >= 1000 * 1000 * 2
    assert sum(few for _, few in work) < 300_000 and sum(n for n, _ in work) < 60_000
    for i in (7, 500, 1006, 1500):
        assert got[i] == sum(k % 7 for k, q in enumerate(b) if miles_apart(a[i], q) < 500.0)


def test_edges(spark):
    l = spark.createDataFrame([(1, 10.0, 10.0), (2, None, 10.0), (3, 10.0, 10.0), (4, -50.0, 0.0)], "i int, lat double, lon double")
    r = spark.createDataFrame([(10.0, 10.0, 2, 0.5), (10.0, 10.1, None, 0.25), (None, 3.0, 9, 9.0)], "rg_lat double, rg_lon double, n long, w double")
    got = {x.i: (x.n, x.w) for x in N.nearby_sums(l, r, 100.0, {"n": "n", "w": "w"}).collect()}
    assert got == {1: (2, 0.75), 2: (0, 0.0), 3: (2, 0.75), 4: (0, 0.0)}
    assert {x.n for x in N.nearby_sums(l, r.limit(0), 100.0, {"n": "n"}).collect()} == {0}
    assert N.nearby_sums(l.limit(0), r, 100.0, {"n": "n"}).count() == 0
    far = spark.createDataFrame([(10.0, 10.0 + math.degrees(1) * 100.0 / EARTH_RADIUS_MILES / math.cos(math.radians(10.0)) * 1.01, 1, 1.0)], r.schema)
    assert {x.n for x in N.nearby_sums(l, far, 100.0, {"n": "n"}).collect()} == {0}


def test_criticality_by_positions_equals_pairs(spark, monkeypatch):
    """Public regions brought by their positions give what the pairs of clusters and regions give: regions at one position, repeated
    ones, some at two positions, some on a cluster's own list, some without a capacity; and no pair is handed to the sums."""
    rnd = random.Random(5)
    c = spark.createDataFrame([(i, rnd.choice(["A", "A:B", "C"]), float(rnd.randint(1, 9)), rnd.randint(1, 3), rnd.uniform(-20, 20), rnd.uniform(-20, 20)) for i in range(60)],
                              "id long, geoname string, load double, nmpg long, cl_lat double, cl_lon double")
    spots = [(rnd.uniform(-20, 20), rnd.uniform(-20, 20)) for _ in range(12)]
    rows = [(r, *rnd.choice(spots), float(rnd.randint(0, 5)), float(rnd.randint(0, 5)), rnd.choice([0, 1, 7]), int(rnd.random() < 0.3)) for r in range(1, 120)]
    rows += [(*rows[0][:6], 0), rows[5], (rows[7][0], *spots[3], 2.0, 2.0, 2, 0), (400, *spots[1], 3.0, 3.0, None, 0), (401, None, None, 1.0, 1.0, 1, 0)]
    regions = spark.createDataFrame(rows, "region long, rg_lat double, rg_lon double, bit_gbps double, flit_gfps double, numvips int, private int")
    allow = spark.createDataFrame([(rnd.randint(0, 4), rnd.randint(1, 130)) for _ in range(300)] + [(1, 400), (2, 400), (4, 401)], "maprule int, region long")
    members = spark.createDataFrame([(rnd.randrange(60), rnd.randint(1, 125)) for _ in range(150)], "id long, region long")
    o = {"key": "id", "groups": {"W": [0, 1]}, "others": "S"}
    want = C.region_criticality(c, members.unionByName(C.public_pairs(c, regions, 600.0, "id")), allow, regions, **o)
    taken, pairs = [], C.public_pairs
    monkeypatch.setattr(C, "public_pairs", lambda *a: taken.append(pairs(*a)) or taken[-1])
    got = C.region_criticality(c, members, allow, regions, public_miles=600.0, **o)
    rounded = lambda df: {(r.rule_group, r.region): [round(v, 3) if isinstance(v, float) else v for v in r] for r in df.collect()}
    a, b = rounded(want), rounded(got)
    assert a.keys() == b.keys() and len(a) > 100 and got.columns == want.columns
    assert all(x == y or all(p == q or abs(p - q) < 0.0021 for p, q in zip(x, y) if isinstance(p, float)) and x[:3] == y[:3] and x[-1] == y[-1] for x, y in zip((a[k] for k in sorted(a)), (b[k] for k in sorted(a))))
    assert {r.region for r in taken[0].select("region").distinct().collect()} <= {1, 6, 8, 400, 401}
