"""Partners of sets that differ in few items, against all pairs."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casegauge.operators import set_pairs as P


def brute(sets, weights, limit):
    out = {}
    for a, x in sets.items():
        found = [x ^ y for b, y in sets.items() if b != a and x & y and len(x ^ y) < limit]
        out[a] = (len(found), sum(sum((weights[i] for i in d), Decimal(0)) for d in found))
    return out


def answer(spark, sets, weights, limit):
    rows = [(k, i, float(weights[i])) for k, s in sets.items() for i in s]
    df = spark.createDataFrame(rows, "cluster string, region long, cap double").repartition(5)
    return {r.cluster: (r.partners, Decimal(str(round(r.differing, 3)))) for r in P.set_differences(df, "cluster", "region", "cap", limit).collect()}


def same(got, want):
    assert set(got) == set(want)
    for k, (n, w) in want.items():
        assert got[k][0] == n and abs(got[k][1] - w) < Decimal("0.001"), k


WEIGHTS = {i: Decimal(i * 37 % 101) / 8 for i in range(400)}


@pytest.mark.parametrize("limit", [1, 2, 5, 10])
def test_small_and_large_sets(spark, limit):
    rng = random.Random(limit)
    sets = {}
    for i in range(220):
        base = rng.choice([range(0, 14), range(5, 40), range(30, 34)])
        sets[f"c{i}"] = set(rng.sample(base, rng.randint(1, min(len(base), 24))))
    sets["twin a"], sets["twin b"] = {1, 2, 3}, {1, 2, 3}
    want = brute(sets, WEIGHTS, limit)
    assert sum(n for n, _ in want.values()) > 0
    same(answer(spark, sets, WEIGHTS, limit), want)


def test_near_copies_of_long_sets(spark):
    rng = random.Random(8)
    sets = {}
    for g in range(6):
        core = set(rng.sample(range(400), 60))
        for i in range(12):
            s = set(core)
            for _ in range(rng.randint(0, 7)):
                s ^= {rng.randrange(400)}
            sets[f"g{g}.{i}"] = s
    want = brute(sets, WEIGHTS, 10)
    assert 0 < sum(n for n, _ in want.values()) < len(sets) ** 2
    same(answer(spark, sets, WEIGHTS, 10), want)


def test_one_very_common_region(spark):
    """Two thirds of 3000 small sets hold region 0. All of them are partners, yet no join is made on it: the work grows with
    the sets."""
    rng = random.Random(3)
    sets = {f"c{i}": set(rng.sample(range(1, 400), rng.randint(1, 4))) | ({0} if i % 3 else set()) for i in range(3000)}
    rows = [(k, i, float(WEIGHTS[i])) for k, s in sets.items() for i in s]
    df = spark.createDataFrame(rows, "cluster string, region long, cap double").repartition(5)
    ordered = P._ordered_sets(df, "cluster", "region", "cap")
    counted = P._small_partners(ordered, 9)
    assert counted.count() == len(sets)
    probe = ["c1", "c2", "c3", "c2999"]
    got = {r.cluster: (r.partners, Decimal(str(round(r.differing, 3)))) for r in P.set_differences(df, "cluster", "region", "cap").collect()}
    for a in probe:
        found = [sets[a] ^ y for b, y in sets.items() if b != a and sets[a] & y and len(sets[a] ^ y) < 10]
        assert got[a] == (len(found), sum((WEIGHTS[i] for d in found for i in d), Decimal(0)).quantize(Decimal("0.001")))
    # Mixed with long sets, the common region is the last item of every set that holds it, and never a key of the pair join.
    longer = spark.createDataFrame([(f"l{i}", r, 1.0) for i in range(40) for r in {0, *rng.sample(range(1, 60), 11)}], "cluster string, region long, cap double")
    both = P._ordered_sets(df.unionByName(longer), "cluster", "region", "cap")
    assert both.where(F.array_contains("_items", F.lit(0)) & (F.element_at("_items", -1) != 0)).count() == 0
    text = P._large_partners(both, 9)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "l_token" in text


def test_edges(spark):
    schema = "cluster string, region long, cap double"
    assert P.set_differences(spark.createDataFrame([], schema), "cluster", "region", "cap").count() == 0
    rows = [("a", 1, 2.0), ("a", 1, 2.0), ("a", 2, None), ("b", 2, None), ("alone", 9, 1.0), (None, 1, 2.0), ("a", None, 5.0)]
    got = {r.cluster: (r.partners, r.differing) for r in P.set_differences(spark.createDataFrame(rows, schema), "cluster", "region", "cap").collect()}
    assert got == {"a": (1, 2.0), "b": (1, 2.0), "alone": (0, 0.0)}
    with pytest.raises(ValueError):
        P.set_differences(spark.createDataFrame(rows, schema), "cluster", "region", "cap", limit=17)
