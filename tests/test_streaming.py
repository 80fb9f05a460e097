"""Streams: late rows, repeated rows and files, idempotent sinks."""

import random

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from casegauge.operators.rolling import rolling_sink, rolling_summary, step_states, summary_of_states
from casegauge.operators.summary import Metric, case_summary
from casegauge.streaming import samples as ST

SCHEMA = "id long, sec long, maprule int, geoname string, netname string, region long, score double, nsd_demand int, ra_load long"


def rows(spark, items):
    return spark.createDataFrame([(i, sec, 1, "A", "n", 1, 2.0, d, 10) for i, sec, d in items], SCHEMA)


def drop_file(spark, items, folder, name):
    """One CSV file with a chosen name."""
    lines = "\n".join(f"{i},{sec},1,A,n,1,2.0,{d},10" for i, sec, d in items)
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(lines + "\n")


def timed(df):
    return df.withColumn("ts", F.timestamp_seconds("sec"))


H = 3600


def test_late_rows(spark, tmp_path):
    """Up to six hours late is counted, later is dropped; closed hours are written once."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stream = lambda: ST.hourly_rollup(timed(ST.stream_samples(spark, str(src), SCHEMA)), "ts")
    drop_file(spark, [(1, 10 * H, 1), (2, 10 * H + 60, 1), (3, 20 * H, 1)], src, "s.1.csv")
    ST.run_available(stream(), out, state)
    # the watermark is now 14 h: hour 10 is closed, hour 14 is open
    drop_file(spark, [(4, 20 * H - 6 * H + 60, 1), (5, 10 * H + 120, 1)], src, "s.2.csv")
    ST.run_available(stream(), out, state)
    drop_file(spark, [(6, 40 * H, 1)], src, "s.3.csv")
    ST.run_available(stream(), out, state)
    got = {(r.hour_start.hour, r.samples, r.ra_load) for r in spark.read.parquet(out).collect()}
    assert got == {(10, 2, 20), (14, 1, 10), (20, 1, 10)}


def test_files_once_with_time_from_their_name(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stream = lambda: ST.stream_samples(spark, str(src), SCHEMA, name_pattern=r"joined\.(\d+)\.csv", names=["file_ts"])
    drop_file(spark, [(1, 0, 1)], src, "joined.1700000000.csv")
    ST.run_available(stream(), out, state)
    ST.run_available(stream(), out, state)
    drop_file(spark, [(2, 0, 1)], src, "joined.1700000600.csv")
    ST.run_available(stream(), out, state)
    assert sorted((r.id, r.file_ts) for r in spark.read.parquet(out).collect()) == [(1, "1700000000"), (2, "1700000600")]


def test_repeated_rows_count_once(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stream = lambda: ST.dedup_samples(timed(ST.stream_samples(spark, str(src), SCHEMA)), "ts", ["id"])
    drop_file(spark, [(1, 10 * H, 1), (2, 10 * H, 1)], src, "a.csv")
    ST.run_available(stream(), out, state)
    drop_file(spark, [(1, 10 * H, 1), (2, 10 * H, 1), (3, 11 * H, 1)], src, "b.csv")
    ST.run_available(stream(), out, state)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_batch_sink_is_idempotent(spark, tmp_path):
    """A repeated batch has one effect; a later batch of the same partition adds to it."""
    out = str(tmp_path / "out")
    sink = ST.replace_partitions(out, ["day"])
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    for _ in range(2):
        sink(batch, 0)
    sink(spark.createDataFrame([(9, "b")], "id int, day string"), 1)
    assert sorted((r.id, r.day) for r in ST.batch_rows(spark, out, "id int, day string").collect()) == [(1, "a"), (2, "b"), (9, "b")]


def random_files(src, items, files, seed=3):
    """The rows in many files, in random time order."""
    rng = random.Random(seed)
    rng.shuffle(items)
    for f in range(files):
        lines = "\n".join(f"{i},{sec},1,A,n,1,2.0,{d},10" for i, sec, d in items[f::files])
        src.mkdir(exist_ok=True)
        (src / f"s.{f}.csv").write_text(lines + "\n")


def test_rebuilt_hours_do_not_depend_on_files(spark, tmp_path):
    """One file, and the same rows in seven files and batches in random time order: the same hours; late rows are counted."""
    items = [(i, i * 397, i % 9) for i in range(1000)]
    got = []
    for name, files in (("one", 1), ("many", 7)):
        src = tmp_path / name
        random_files(src, list(items), files)
        store, out, ledger, state = (str(tmp_path / f"{name}-{x}") for x in ("store", "out", "ledger", "state"))
        ST.run_batches(timed(ST.stream_samples(spark, str(src), SCHEMA, per_trigger=1)), state, ST.rebuild_hours(store, out, ledger, "ts"))
        got.append(sorted((r["_hour"], r.samples, r.nsd_demand, r.ra_load) for r in spark.read.parquet(out).collect()))
        seen = spark.read.parquet(ledger).agg(F.sum("rows"), F.sum("late"), F.countDistinct("_batch")).first()
        assert seen[0] == 1000 and (seen[1] > 0) == (files > 1) and seen[2] == files
    want = {}
    for _, sec, d in items:
        h = sec - sec % H
        want[h] = (want.get(h, (0, 0))[0] + 1, want.get(h, (0, 0))[1] + d)
    assert got[0] == got[1] == sorted((h, n, d, 10 * n) for h, (n, d) in want.items())


def test_first_rows_are_kept_whatever_the_order(spark, tmp_path):
    items = [(i % 300, (i % 300) * 997, 1) for i in range(900)]
    for name, files in (("one", 1), ("many", 6)):
        src = tmp_path / name
        random_files(src, list(items), files)
        out, state = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-state")
        ST.run_batches(timed(ST.stream_samples(spark, str(src), SCHEMA, per_trigger=1)), state, ST.keep_first(out, "ts", ["id"]))
        assert sorted(r.id for r in ST.batch_rows(spark, out, "id long").collect()) == list(range(300))


def test_partitioned_sink_keeps_the_rows_of_all_batches(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    random_files(src, [(i, (i * 7919) % (5 * 86400), 1) for i in range(400)], 6)
    stream = ST.stream_samples(spark, str(src), SCHEMA, per_trigger=1).select("id", F.date_format(F.timestamp_seconds("sec"), "yyyyMMdd").alias("day"))
    for run in (1, 2):
        ST.run_batches(stream, str(tmp_path / f"state{run}"), ST.replace_partitions(out, ["day"]))
    assert sorted(r.id for r in ST.batch_rows(spark, out, "id long, day string").collect()) == list(range(400))


D = 86400
DEMAND = Metric("dem", "nsd_demand", "target", "target")


def plain_rolling(df, days, metrics):
    """Every sample copied to each of its windows."""
    first = F.floor(F.col("sec") / D) * D + D
    spread = df.withColumn("window_end", F.explode(F.sequence(first, first + (days - 1) * D, F.lit(D).cast("long"))))
    return case_summary(spread, metrics, ["maprule", "geoname", "netname", "window_end"])


def rolling_rows(spark, n=400):
    items = [(i, (i * 7919) % (12 * D), i % 50) for i in range(n)]
    return rows(spark, items).withColumns({"target": F.lit(10), "floor": F.lit(30)})


def test_states_give_the_summary_of_samples(spark):
    low = Metric("low", "nsd_demand", "floor", "floor", low_is_bad=True, target_agg="max")
    df = rolling_rows(spark).unionByName(rolling_rows(spark, 9).withColumns({"nsd_demand": F.lit(None).cast("int"), "id": F.col("id") + 1000}))
    got = rolling_summary(df, "sec", 3, [DEMAND, low])
    want = plain_rolling(df, 3, [DEMAND, low])
    assertDataFrameEqual(got.select(want.columns), want)
    states = step_states(df, "sec", [DEMAND, low])
    halves = states.withColumn("n", F.col("n") * 2).unionByName(states.withColumn("n", -F.col("n")))  # two parts that add up
    assertDataFrameEqual(summary_of_states(halves.groupBy(*[c for c in states.columns if c != "n"]).agg(F.sum("n").alias("n")), 3, [DEMAND, low]).select(want.columns), want)
    assert rolling_summary(df.limit(0), "sec", 3, [DEMAND]).count() == 0


def test_samples_are_not_copied_to_windows(spark):
    """The copies to windows are made above the last count of a day's values."""
    lines = rolling_summary(rolling_rows(spark), "sec", 14, [DEMAND])._jdf.queryExecution().executedPlan().toString().splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert sum("HashAggregate" in line and "_step" in line for line in lines[generate:]) >= 3
    assert not any("Generate" in line for line in lines[generate + 1:])


def test_rolling_summary_of_a_stream_equals_the_batch(spark, tmp_path):
    states, out = str(tmp_path / "states"), str(tmp_path / "out")
    each = rolling_sink(states, "sec", 3, [DEMAND], out)
    full = rolling_rows(spark).select("maprule", "geoname", "netname", "sec", "nsd_demand", "target", "id")
    for b in range(4):
        for _ in range(2 if b == 1 else 1):  # batch 1 is delivered twice
            each(full.where(F.col("id") % 4 == b).drop("id"), b)
    got = spark.read.parquet(out).withColumn("window_end", F.col("window_end").cast("long"))
    want = plain_rolling(full, 3, [DEMAND])
    assertDataFrameEqual(got.select(want.columns), want)
    assert spark.read.parquet(states).agg(F.sum("n")).first()[0] == 400
    assert "sec" not in spark.read.parquet(states).columns  # no samples are kept


def test_store_then_recompute_equals_the_batch(spark, tmp_path):
    compute = lambda df: plain_rolling(df, 3, [DEMAND])
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    each = ST.store_then_recompute(store, "sec", compute, out, "window_end", 3 * D, D)
    full = rolling_rows(spark).select("maprule", "geoname", "netname", "sec", "nsd_demand", "target", "id")
    for b in range(3):
        each(full.where(F.col("id") % 3 == b).drop("id"), b)
    got = spark.read.parquet(out).withColumn("window_end", F.col("window_end").cast("long"))
    want = compute(full)
    assertDataFrameEqual(got.select(want.columns), want)


def test_a_batch_is_compared_with_its_own_days_only(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = ST.keep_first(out, "ts", ["id"])
    for day in range(5):
        sink(timed(rows(spark, [(100 * day + i, day * D + i, 1) for i in range(10)])), day)
    late = timed(rows(spark, [(203, 2 * D + 3, 1), (299, 2 * D + 99, 1)]))
    days = [r[0] for r in late.select(F.date_format("ts", "yyyyMMdd")).distinct().collect()]
    known = ST.known_ids(spark, out, late, ["id"], days, 5)
    scan = next(line for line in known._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and days[0] in scan.split("PartitionFilters")[1]
    assert len(known.select("id").collect()) == 10 and known.rdd.getNumPartitions() >= 1
    assert known.select(F.input_file_name()).distinct().count() == known.select("_day").distinct().count() == 1
    sink(late, 5)
    assert sorted(r.id for r in ST.batch_rows(spark, out, "id long").collect() if 200 <= r.id < 300) == [*range(200, 210), 299]


def test_a_late_batch_reads_the_parts_of_its_hours_only(spark, tmp_path):
    store, out, ledger = (str(tmp_path / x) for x in ("store", "out", "ledger"))
    sink = ST.rebuild_hours(store, out, ledger, "ts")
    for b in range(4):
        sink(timed(rows(spark, [(1000 * b + i, b * D + i * 600, 1) for i in range(144)])), b)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}
    sink(timed(rows(spark, [(9001, D + 3 * H + 5, 7), (9002, D + 3 * H + 6, 7)])), 4)
    schema = spark.read.parquet(store).drop("_day", "_batch").schema.toDDL() + ", _day long, _batch int"
    touched = ST.touched_parts(spark, store, schema, 4)
    scan = next(line for line in touched._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert str(D) in scan.split("PartitionFilters")[1] and str(D + 3 * H) in scan.split("PushedFilters")[1]
    assert {r["_hour"] for r in touched.collect()} == {D + 3 * H} and touched.count() == 2  # one part of batch 1, one of batch 4
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}
    assert len(set(after) - set(before)) == 1 and len(set(before) - set(after)) == 1  # one hour was replaced
    hour = [r for r in spark.read.parquet(out).collect() if r["_hour"] == D + 3 * H]
    assert [(r.samples, r.nsd_demand, r.avg_score) for r in hour] == [(8, 20, 2.0)]


def test_hourly_stream_equals_batch(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    items = [(i, i * 97, i % 9) for i in range(1000)]
    for f in range(3):
        drop_file(spark, items[f * 334:(f + 1) * 334], src, f"s.{f}.csv")
    ST.run_available(ST.hourly_rollup(timed(ST.stream_samples(spark, str(src), SCHEMA, per_trigger=1)), "ts"), out, state)
    got = {(int(r.hour_start.timestamp()) // H, r.samples, r.nsd_demand) for r in spark.read.parquet(out).withColumn("hour_start", F.col("hour_start")).collect()}
    want = {}
    for i, sec, d in items:
        n, s = want.get(sec // H, (0, 0))
        want[sec // H] = (n + 1, s + d)
    closed = {(h, *v) for h, v in want.items() if (h + 1) * H <= 999 * 97 - 6 * H}
    assert {(n, s) for _, n, s in got} == {(n, s) for _, n, s in closed} and len(got) == len(closed)
