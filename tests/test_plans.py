"""Physical plans: pushed filters, no products, no Python in the hot path."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from casegauge.operators import joins as J, summary as S
from casegauge.operators.topn import top_n_per_key
from casegauge.plans import catalog
from casegauge.plans.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


READS_ONLY = [n for n in catalog.QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", READS_ONLY)
def test_no_products_and_no_python(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(entry.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "MapInPandas" not in p and "FlatMapGroupsInPandas" not in p
    assert "ArrowEvalPython" not in p or name == "distance_latency_p_value"


def test_filters_and_columns_reach_the_scan(spark):
    li = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_quantity")
    p = S.time_window(li, "l_orderkey", 100, 200).select("l_suppkey")
    text = p._jdf.queryExecution().toString()
    assert "GreaterThan(l_orderkey,100)" in text and "LessThan(l_orderkey,200)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text


def test_partitions_are_pruned(spark, tmp_path):
    spark.range(20).select((F.col("id") % 5).alias("ts"), "id").write.partitionBy("ts").parquet(str(tmp_path / "t"))
    p = plan(S.time_window(spark.read.parquet(str(tmp_path / "t")), "ts", 1, 3, "[)"))
    assert "PartitionFilters: [isnotnull(ts" in p and "(ts" in p.split("PartitionFilters")[1][:120]


@pytest.mark.parametrize("name, column, bounds", [
    ("time_window_filter", "o_orderdate", 4), ("window_samples", "l_shipdate", 2), ("summary_at_period", "l_shipdate", 2), ("recent_samples", "l_shipdate", 2), ("period_compare", "l_shipdate", 4),
    ("retain", "ts", 1), ("recent_events", "ts", 1), ("coverage_by_geo", "o_orderdate", 1), ("coverage_detail", "o_orderdate", 1)])
def test_time_bounds_reach_the_scan(spark, name, column, bounds):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(entry.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line.split("PushedFilters: [")[1].split("ReadSchema")[0] for line in text.splitlines() if "PushedFilters: [" in line]
    assert sum(p.replace("OrEqual", "").count(f"Than({column},") for p in pushed) == bounds


@pytest.mark.parametrize("name, scans", [("target_per_case", 2), ("in_out_ratio_weighted", 8), ("coverage_by_geo", 3), ("duration_share", 8)])
def test_inputs_are_not_computed_twice(spark, name, scans):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert text.count("FileScan") <= scans
    assert sum("lineitem.parquet" in line and "FileScan" in line for line in text.splitlines()) <= 1


def test_bounds_of_dates_timestamps_and_numbers(spark):
    df = spark.sql("""select id * 43200 as n, timestamp_seconds(id * 43200) as t, cast(timestamp_seconds(id * 43200) as timestamp_ntz) as z,
                      date_from_unix_date(cast(id as int)) as d from range(10)""")
    for bounds in ("()", "[)", "(]", "[]"):
        for start, end in ((86400, 3 * 86400), (86401, 3 * 86400 + 5), (0, 0)):
            inside = lambda s: (s >= start if bounds[0] == "[" else s > start) and (s <= end if bounds[1] == "]" else s < end)
            for c in ("n", "t", "z"):
                assert S.time_window(df, c, start, end, bounds).count() == sum(inside(i * 43200) for i in range(10)), (c, bounds, start)
            assert S.time_window(df, "d", start, end, bounds).count() == sum(inside(i * 86400) for i in range(10)), (bounds, start)


def test_wildcard_join_hashes_on_three_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = Inputs(spark, FOLDER)
        p = plan(J.wildcard_join(x.objectives().select("maprule", "geoname", "netname"), x.overview()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in p.splitlines() if "SortMergeJoin" in line and "_rule" in line]
    assert joins and all("_geoname" in line and "_netname" in line for line in joins)


def test_top_n_is_limited_before_the_shuffle(spark):
    li = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    p = plan(top_n_per_key(li, ["l_suppkey"], [F.col("l_extendedprice").desc()], 3))
    assert p.count("WindowGroupLimit") == 2 and "Partial" in p


def test_summary_is_one_shuffle(spark):
    p = plan(S.case_summary(spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.lit(1).alias("maprule"), F.col("l_returnflag").alias("geoname"), F.col("l_linestatus").alias("netname"),
        F.col("l_linenumber").alias("sp95"), F.lit(3).alias("star")), [S.score_metric("95")]))
    assert p.count("Exchange hashpartitioning") == 1 and p.count("FileScan") == 1


def test_aggregation_does_not_inherit_a_coarser_partitioning(spark):
    """After a join on one column, grouping by more shuffles again, between partial and final sums."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li, s = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "supplier"))
        p = plan(li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_suppkey", "l_returnflag").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_suppkey" in p and any("l_returnflag" in x for x in p.splitlines() if "Exchange hashpartitioning" in x)


def test_assignments_move_once(spark, tmp_path):
    """Of the joins, groupings and lists of the statistics, one shuffle has the rows of the summary with their sums."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        text = plan(entry.queries()["assignment_stats"](spark, FOLDER))
        narrow = plan(entry.queries()["mapping_entropy"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxToStringFields")
    assert text.count("REPARTITION_BY_COL") == 1 and text.count("collect_list") >= 1
    grouping = [line for line in text.splitlines() if "ObjectHashAggregate(" in line]
    assert len(grouping) == 2 and all("keys=[_at" in line for line in grouping)
    between = text[text.index(grouping[0]):text.index(grouping[1])]
    assert "Exchange" not in between
    assert "SortMergeJoin [mpd_uuid" not in text + narrow and "min_s" not in narrow
