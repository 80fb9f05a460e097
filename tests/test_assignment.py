"""Duration sums move their rows once; crowded groups take the form that keeps them spread; no table outlives its use."""

import random
from pathlib import Path

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from casegauge.operators import assignment as A
from casegauge.session import passing
from casegauge.sources.tables import stored

FOLDER = "/root/testdata/sf0.001"
LOG = ("mpgid int, mrid int, mpg_type string, region int, link int, cnt int, min_s int, max_s int, min_r int, max_r int, "
       "dftime double, mpd_uuid string, ts int")


@pytest.fixture()
def log(spark):
    """Odd rows: null groups, rules, runs, types, times and counts, and rows that come twice."""
    rng = random.Random(5)
    some = lambda *values: rng.choice([*values, None])
    rows = [(some(1, 2, 3), some(1, 2), some("NS", "X"), rng.randrange(4), some(1, 2), some(0, 1, 3, 7), rng.randrange(9), some(3, 70000), rng.randrange(9),
             some(5, 300), some(600.0, 300.0), some("u", "v"), some(0, 600)) for _ in range(700)]
    return spark.createDataFrame(rows + rows[:60], LOG)


@pytest.fixture()
def regions(spark):
    return spark.createDataFrame([(i, i, "EU", "X", 0.0, 1.0 * i, p, "1") for i, p in enumerate(["private", "public", None, "private"])],
                                 "region int, ecor int, continent string, country string, latitude double, longitude double, prp string, day string")


def plain(log, weighted):
    """The sums by Python loops."""
    total, sums = {}, {}
    rows = log.collect()
    at = lambda r: (r.mpgid, r.mrid, r.mpd_uuid, r.ts)
    for r in rows:
        if r.cnt is not None:
            total[at(r)] = total.get(at(r), 0) + r.cnt
    for r in rows:
        own = sums.setdefault((r.region, r.mpd_uuid, r.mpgid, r.mrid, r.mpg_type, r.link), {})
        if r.cnt is None or r.dftime is None or not total[at(r)]:
            continue
        d = round(r.cnt / total[at(r)], 5) * r.dftime
        for name, value in [("mpd_dftime", 1), *[(w, r[w]) for w in weighted]]:
            if value is not None:
                own[name] = own.get(name, 0.0) + value * d
    return {k: tuple(None if (x := own.get(n)) is None else round(x, 3) for n in ("mpd_dftime", *weighted)) for k, own in sums.items()}


@pytest.mark.parametrize("calm", [1 << 20, 150, 0])
def test_calm_and_crowded_groups_have_the_same_sums(spark, monkeypatch, log, regions, calm):
    """No group, some groups or all groups are crowded."""
    monkeypatch.setattr(A, "CALM", calm)
    weighted = ["min_s", "max_s", "min_r", "max_r"]
    out = A.duration_share(log, regions)
    got = {(r.region, r.mpd_uuid, r.mpgid, r.mrid, r.mpg_type, r.link): tuple(None if r[c] is None else round(r[c], 3) for c in ("mpd_dftime", *weighted))
           for r in out.collect()}
    want = plain(log, weighted)
    assert out.count() == len(got) == len(want) > 100 and got.keys() == want.keys()
    assert all(g == pytest.approx(w, abs=2e-3) for k, w in want.items() for g, w in zip(got[k], w) if w is not None or g is not None)
    narrow = A.duration_share(log, regions, weighted=())
    assertDataFrameEqual(narrow.select("region", "link", F.round("mpd_dftime", 2).alias("d")), out.select("region", "link", F.round("mpd_dftime", 2).alias("d")))


def test_rows_of_the_log_move_once(spark):
    """Calm groups: one shuffle between the stored log and the sums, by group."""
    text = entry.queries()["duration_share"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_COL") == 1
    lines = text.splitlines()
    window = max(i for i, line in enumerate(lines) if "Window [" in line)
    moved = next(i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line)
    assert not [line for line in lines[:moved] if "Exchange hashpartitioning" in line] and window < moved


def test_tables_go_when_they_have_been_used(spark):
    here = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    old = set()
    names = lambda: sorted(p.name.rsplit("-", 1)[0] for p in here.glob("casegauge-*/*") if p not in old)
    for name, kept in (("assignment_stats", "assignment-sum"), ("assignment_worst_100", "assignment-sum"), ("mapping_entropy", "durations")):
        old = set(here.glob("casegauge-*/*"))
        out = entry.queries()[name](spark, FOLDER)
        assert names() == [kept] and out.count() > 0
    old = set(here.glob("casegauge-*/*"))
    with passing(spark) as keep:
        with passing(spark) as inner:
            stored(spark.range(3), "a")
            b = inner(stored(spark.range(4), "b"))
        assert names() == ["b"]
        c = keep(stored(b, "c"))
    assert names() == ["c"] and c.count() == 4
    with pytest.raises(ValueError), passing(spark):
        stored(spark.range(3), "d")
        raise ValueError
    assert names() == ["c"]
