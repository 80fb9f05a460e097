"""Partitions by folder names; appends that happen once or not at all."""

import pytest
from pyspark.sql import functions as F

from casegauge.sources import partitions as P, snapshots as S
from casegauge.sources.tables import overwrite_partition

SCHEMA = "v long, day string, hour string"


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"202401{1 + i % 9:02d}", f"{i % 3:02d}") for i in range(60)] + [(99, None, "a b/c=d"), (100, "20240105", "07")]
    overwrite_partition(spark.createDataFrame(rows, SCHEMA), path, ["day", "hour"])
    return path


def damage(path):
    """Make every data file unreadable: whoever opens one fails."""
    import pathlib
    for f in pathlib.Path(path).rglob("part-*"):
        f.write_bytes(b"no data")
    for f in pathlib.Path(path).rglob(".part-*.crc"):
        f.unlink()


def test_values_come_from_folder_names(spark, table):
    want = {(r.day, r.hour) for r in spark.read.schema(SCHEMA).parquet(table).collect()}
    damage(table)
    parts = P.partition_values(spark, table, "day string, hour string")
    assert {(r.day, r.hour) for r in parts.collect()} == want and (None, "a b/c=d") in want
    assert P.partition_values(spark, table, "day int, hour string").agg(F.max("day")).first()[0] == 20240109
    missing = S.missing_partitions(parts.where("day is not null").select(F.unix_date(F.to_date("day", "yyyyMMdd")).cast("long").alias("d"), F.lit(1).alias("k")).where("d <> 19728"),
                                   ["k"], "d", 1)
    assert [r.d for r in missing.collect()] == [19728]
    assert P.partition_values(spark, table + "-none", "day string").count() == 0


def test_newest_partition_is_chosen_before_reading(spark, table):
    newest = P.read_latest(spark, table, SCHEMA, "day string, hour string", "day")
    assert {r.day for r in newest.collect()} == {"20240109"}
    scan = next(line for line in newest._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "20240109" in scan.split("PartitionFilters")[1]
    assert newest.select(F.input_file_name()).distinct().count() <= 3
    before = P.read_latest(spark, table, SCHEMA, "day string, hour string", "day", upto="20240105", strict=True)
    assert {r.day for r in before.collect()} == {"20240104"}
    assert {r.day for r in P.read_latest(spark, table, SCHEMA, "day string, hour string", "day", upto="20240105").collect()} == {"20240105"}
    assert P.read_latest(spark, table, SCHEMA, "day string, hour string", "day", upto="2000").count() == 0


def test_some_partitions(spark, table):
    chosen = spark.createDataFrame([("20240105", "07"), (None, "a b/c=d")], "day string, hour string")
    assert sorted(r.v for r in P.read_partitions(spark, table, SCHEMA, chosen, ["day", "hour"]).collect()) == [99, 100]
    assert P.read_partitions(spark, table, SCHEMA, chosen.select("day"), ["day"]).where("day is null").count() == 1


@pytest.mark.parametrize("inclusive, first", [(True, 3), (False, 4)])
def test_retention_drops_folders_without_reading(spark, tmp_path, inclusive, first):
    path = str(tmp_path / "t")
    overwrite_partition(spark.range(100).select("id", (F.col("id") % 10 * 86400).alias("ts")), path, ["ts"])
    damage(path)
    gone = P.retain_partitions(spark, path, "ts long", "ts", now=10 * 86400, ttl=7 * 86400, inclusive=inclusive)
    assert gone == sorted(f"ts={d * 86400}" for d in range(first))
    left = P.partition_values(spark, path, "ts long")
    assert sorted(r.ts // 86400 for r in left.collect()) == list(range(first, 10))
    assert P.retain_partitions(spark, path, "ts long", "ts", now=10 * 86400, ttl=7 * 86400, inclusive=inclusive) == []


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = (spark.createDataFrame([(i, f"d{i % 3}") for i in r], "v int, day string") for r in (range(9), range(9, 12)))
    assert [P.append_once(a, path, ["day"], "k1"), P.append_once(a, path, ["day"], "k1"), P.append_once(b, path, ["day"], "k2")] == [True, False, True]
    rows = spark.read.schema("v int, day string").parquet(path).collect()
    assert sorted((r.v, r.day) for r in rows) == [(i, f"d{i % 3}") for i in range(12)]
    assert P.append_once(a.limit(0), path, ["day"], "none") and not P.append_once(a, path, ["day"], "none")
    with pytest.raises(ValueError):
        P.append_once(a, path, ["day"], "../k")


def files(path):
    import pathlib
    return sorted(f.name for f in pathlib.Path(path).rglob("part-*"))


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    P.append_once(spark.createDataFrame([(1, "a")], "v int, day string"), path, ["day"], "first")
    before = files(path)
    bad = spark.range(1000).select(F.when(F.col("id") == 977, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("int").alias("v"), F.lit("a").alias("day"))
    with pytest.raises(Exception):
        P.append_once(bad, path, ["day"], "second")
    assert files(path) == before and not (tmp_path / "t" / "_commits" / "second.plan").exists()
    assert P.append_once(bad.where("id < 900"), path, ["day"], "second")
    assert spark.read.schema("v int, day string").parquet(path).count() == 901


@pytest.mark.parametrize("sudden", [True, False])
def test_a_broken_move_is_undone(spark, tmp_path, monkeypatch, sudden):
    """`sudden`: the driver dies, so that nothing is tidied up before the next append."""
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, f"d{i}") for i in range(6)], "v int, day string")
    P.append_once(rows, path, ["day"], "first")
    moved, move, undo = [], P.Folder.move, P._undo

    def failing(self, source, target):
        if source.startswith(P.STAGING) and len(moved) == 3:
            raise OSError("lost")
        moved.append(target)
        move(self, source, target)

    before = files(path)
    with monkeypatch.context() as m:
        m.setattr(P.Folder, "move", lambda self, s, t: failing(self, s, t) if s.startswith(P.STAGING) else move(self, s, t))
        if sudden:
            m.setattr(P, "_undo", lambda folder, key: None)
            m.setattr(P.Folder, "delete", lambda self, name: None)
        with pytest.raises(OSError):
            P.append_once(rows, path, ["day"], "second")
    assert (files(path) != before) == sudden
    assert P.undo_unfinished(spark, path) == (["second"] if sudden else [])
    assert files(path) == before
    assert P.append_once(rows, path, ["day"], "second") and spark.read.schema("v int, day string").parquet(path).count() == 12
