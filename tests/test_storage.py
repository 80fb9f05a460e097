"""Feeds, delimited tables and sinks."""

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from casegauge import schemas
from casegauge.sources import tables as T

FEED = StructType([StructField("casename", StringType()), StructField("maprule", IntegerType()), StructField("p95", IntegerType())])


def write(tmp_path, *lines, name="feed.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_banner_lines_and_leading_stamp(spark, tmp_path):
    path = write(tmp_path, "stamp,casename,maprule,p95", "-----,--------,-------,---", "2024-01-01,C1,5,30", "2024-01-01,C2,6,")
    df = T.ingest_feed(spark, path, FEED, "maprule")
    assert sorted(tuple(r) for r in df.collect()) == [("C1", 5, 30), ("C2", 6, None)]
    assert [tuple(r) for r in T.strict_rows(df).collect()] == [("C1", 5, 30)]


@pytest.mark.parametrize("bad", ["2024-01-01,C1,5,30,9", "2024-01-01,C1,5", "2024-01-01,C1,5,x", "2024-01-01,C1,5x,1", "2024-01-01,C1,,1", "noise"])
def test_ragged_or_unparsable_rows_fail(spark, tmp_path, bad):
    path = write(tmp_path, "2024-01-01,C2,6,1", bad)
    with pytest.raises(Exception):
        T.ingest_feed(spark, path, FEED, "maprule").collect()


def test_fail_fast_reader(spark, tmp_path):
    assert T.read_strict(spark, write(tmp_path, "a,1,2", "b,2,"), FEED).count() == 1
    with pytest.raises(Exception):
        T.read_strict(spark, write(tmp_path, "a,1,2", "b,2,3,4", name="bad.csv"), FEED).collect()


def test_file_names(spark, tmp_path):
    write(tmp_path, "a,1,2", name="mapview.20240105.07.csv")
    df = spark.read.schema(FEED).csv(str(tmp_path)).select("*", "_metadata")
    r = T.tag_from_filename(df, r"\.(\d{8})\.(\d{2})\.csv", ["datestamp", "hour"]).first()
    assert (r.datestamp, r.hour) == ("20240105", "07")


def test_string_partitions_stay_strings(spark, tmp_path):
    df = spark.createDataFrame([(1, "05"), (2, "17")], "v int, hour string")
    T.write_delimited(df, str(tmp_path / "t"), sep=" ", parts=["hour"])
    back = T.read_table(spark, str(tmp_path / "t"), "v int, hour string", " ")
    assert sorted((r.v, r.hour) for r in back.collect()) == [(1, "05"), (2, "17")]


def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    T.overwrite_partition(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    T.overwrite_partition(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    T.append_partition(spark.createDataFrame([(4, "a")], "v int, p string"), path, ["p"])
    assert sorted((r.v, r.p) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b"), (4, "a")]


def test_fields_default_network(spark):
    df = spark.createDataFrame([("1|US 5",), ("1 US|n1|5",), ("maprule geo net load",)], "line string")
    out = T.split_fields(df, "line", ["maprule", "geoname", "netname", "load"], "netname", "load")
    assert sorted(tuple(r) for r in out.collect()) == [("1", "US", "ANY", "5"), ("1", "US", "n1", "5")]


def test_schemas():
    assert len(schemas.REGION_SAMPLE.fields) == 14
    assert schemas.REGION_SAMPLE.fieldNames()[-1] == "ts" and schemas.REGION_SAMPLE["hour"].dataType == StringType()
