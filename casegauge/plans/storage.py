"""Reading, writing and choosing snapshots. Written tables live below the scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from casegauge import CASE, schemas
from casegauge.operators.joins import asof_join
from casegauge.plans.inputs_sql import with_inputs
from casegauge.plans.registry import query
from casegauge.session import scratch_dir
from casegauge.sources import partitions as PT, snapshots as P, tables as T

DAYS = "select distinct event_type, cast(ts as date) d from events"
EVENT_SEC = "cast(floor(epoch(ts)) as bigint)"


def event_days(x):
    return x.table("events").select("event_type", F.col("ts").cast("date").alias("d"))


def feed_lines(x):
    """Customers as the text of a query service: two banner lines, a timestamp in front of each row."""
    k = F.col("c_custkey")
    target = F.when(k % 17 == 0, F.lit("")).otherwise((k % 90).cast("string"))
    data = F.concat_ws(",", F.lit("2024-01-01 00:00:00"), F.concat(F.lit("C"), k.cast("string")), (k % 6).cast("string"),
                       F.col("c_mktsegment"), F.col("c_nationkey").cast("string"), target)
    lines = x.table("customer").select(data.alias("value"))
    banner = x.table("region").select(F.explode(F.array(F.lit("current_timestamp,casename,maprule,netname,p95,targetvalue"),
                                                        F.lit("-----------------,--------,-------,-------,---,-----------"))).alias("value"))
    return banner.unionByName(lines)


FEED = StructType([StructField("casename", StringType()), StructField("maprule", IntegerType()), StructField("netname", StringType()),
                   StructField("p95", IntegerType()), StructField("targetvalue", IntegerType())])
FEED_SQL = """select 'C' || c_custkey casename, cast(c_custkey % 6 as int) maprule, c_mktsegment netname, c_nationkey p95,
    case when c_custkey % 17 = 0 then null else cast(c_custkey % 90 as int) end targetvalue from customer"""


def written_feed(x):
    path = scratch_dir(x.spark, "feed")
    feed_lines(x).write.text(path)
    return T.ingest_feed(x.spark, path, FEED, "maprule")


@query("ingest_feed", FEED_SQL)
def _(x):
    return written_feed(x)


@query("strict_rows", f"select * from ({FEED_SQL}) where targetvalue is not null")
def _(x):
    return T.strict_rows(written_feed(x))


@query("delimited_table", with_inputs("region_sample", "select * from region_sample"))
def _(x):
    """Space-separated table by day, read back with its declared schema."""
    path = scratch_dir(x.spark, "delimited")
    T.write_delimited(x.region_sample(), path, sep=" ", parts=["datestamp"])
    s = schemas.REGION_SAMPLE
    # The partition column comes last: its value is in the folder name, not in the files.
    fields = [f for f in s.fields if f.name != "datestamp"] + [s["datestamp"]]
    return T.read_table(x.spark, path, StructType(fields), " ")


def loads_by_day(x):
    return x.region_sample().groupBy("datestamp", *CASE, "region").agg(F.sum("ra_load").alias("ra_load"))


BY_DAY = "select datestamp, maprule, geoname, netname, region, cast(sum(ra_load) as bigint) ra_load from region_sample group by all"


@query("overwrite_partition", with_inputs("region_sample", """select datestamp, maprule, geoname, netname, region,
    case when datestamp >= '20240120' then ra_load*2 else ra_load end ra_load from by_day""", {"by_day": BY_DAY}))
def _(x):
    """Write all days, then rebuild the days from the 20th on, twice: the second time changes nothing."""
    path = scratch_dir(x.spark, "overwrite")
    rows = loads_by_day(x)
    T.overwrite_partition(rows, path, ["datestamp"])
    redo = rows.where("datestamp >= '20240120'").withColumn("ra_load", F.col("ra_load") * 2)
    for _ in range(2):
        T.overwrite_partition(redo, path, ["datestamp"])
    schema = StructType([f for f in rows.schema.fields if f.name != "datestamp"] + [rows.schema["datestamp"]])
    return x.spark.read.schema(schema).parquet(path)


@query("append_partition", with_inputs("region_sample", "select * from by_day union all select * from by_day where datestamp >= '20240120'", {"by_day": BY_DAY}))
def _(x):
    path = scratch_dir(x.spark, "append")
    rows = loads_by_day(x)
    T.append_partition(rows, path, ["datestamp"])
    T.append_partition(rows.where("datestamp >= '20240120'"), path, ["datestamp"])
    schema = StructType([f for f in rows.schema.fields if f.name != "datestamp"] + [rows.schema["datestamp"]])
    return x.spark.read.schema(schema).parquet(path)


@query("load_text_append", "select n_nationkey, n_name, n_regionkey, 'a' batch from nation union all select n_nationkey, n_name, n_regionkey, 'b' from nation")
def _(x):
    """Delimited files appended to a table batch by batch."""
    table = scratch_dir(x.spark, "bulk")
    schema = "n_nationkey int, n_name string, n_regionkey int, batch string"
    for batch in ("a", "b"):
        source = scratch_dir(x.spark, "text")
        T.write_delimited(x.table("nation").withColumn("batch", F.lit(batch)), source, sep=",")
        T.load_text_append(x.spark, source, schema, table, ["batch"])
    return x.spark.read.schema(schema).parquet(table)


@query("write_delimited", "select s_suppkey, s_name, s_nationkey from supplier")
def _(x):
    path = scratch_dir(x.spark, "tsv")
    T.write_delimited(x.table("supplier").select("s_suppkey", "s_name", "s_nationkey"), path, header=True)
    return x.spark.read.schema("s_suppkey bigint, s_name string, s_nationkey int").option("sep", "\t").option("header", True).csv(path)


@query("tag_from_filename", "select event_id, event_type, 'events' feed from events")
def _(x):
    return T.tag_from_filename(x.table("events").select("event_id", "event_type", "_metadata"), r"/(\w+)\.parquet(?:/|$)", ["feed"],
                               full_path=True).drop("_metadata")


@query("latest_partition", with_inputs("regions", "select * from regions where \"day\" = (select max(\"day\") from regions)"))
def _(x):
    return P.latest_partition(x.regions(), "day").select(x.regions().columns)


@query("asof_partition", """with days as (select distinct cast(ts as date) d from events), months as (select distinct d from days where dayofweek(d) = 0)
    select d, (select max(m.d) from months m where m.d <= days.d) at_or_before, (select max(m.d) from months m where m.d < days.d) before from days""")
def _(x):
    """For every day the newest Sunday snapshot at or before it, and strictly before it."""
    days = event_days(x).select("d").distinct().withColumns({"day": F.unix_date("d").cast("long"), "k": F.lit(0)})
    sundays = days.where(F.dayofweek("d") == 1).select("k", F.col("day").alias("sunday"))
    both = asof_join(days, sundays, ["k"], "day", "sunday", [], strict=False).withColumnRenamed("sunday", "a")
    both = asof_join(both, sundays, ["k"], "day", "sunday", [], strict=True)
    as_date = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return both.select("d", as_date("a").alias("at_or_before"), as_date("sunday").alias("before"))


@query("asof_single_partition", """select max(cast(ts as date)) d from events where cast(ts as date) <= date '2024-01-16'""")
def _(x):
    return P.asof_partition(event_days(x), "d", F.lit("2024-01-16").cast("date"))


@query("retain", f"select event_id, {EVENT_SEC} t from events where {EVENT_SEC} >= 1706486400 - 15*86400")
def _(x):
    rows = P.retain(x.table("events"), "ts", 1706486400, 15 * 86400)
    return rows.select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))


def days_table(x, label, rows):
    """The loads in a table with a folder for each day, as epoch seconds."""
    path = scratch_dir(x.spark, label)
    second = F.unix_timestamp(F.to_timestamp("datestamp", "yyyyMMdd"))
    T.overwrite_partition(rows.withColumn("ts", second).drop("datestamp"), path, ["ts"])
    return path


DAY_ROWS = "maprule int, geoname string, netname string, region bigint, ra_load bigint, ts bigint"
BY_SECOND = {"by_day": BY_DAY, "by_second": """select maprule, geoname, netname, region, ra_load,
    cast(epoch(strptime(datestamp, '%Y%m%d')) as bigint) ts from by_day"""}


@query("retain_partitions", with_inputs("region_sample", "select * from by_second where ts >= 1706486400 - 15*86400", BY_SECOND))
def _(x):
    """Folders older than 15 days are dropped by their names."""
    path = days_table(x, "retained", loads_by_day(x))
    PT.retain_partitions(x.spark, path, "ts bigint", "ts", 1706486400, 15 * 86400)
    return x.spark.read.schema(DAY_ROWS).parquet(path)


@query("newest_folder", with_inputs("region_sample", "select * from by_second where ts = (select max(ts) from by_second where ts < 1706140800)", BY_SECOND))
def _(x):
    """The newest day before 2024-01-25, found among folder names."""
    path = days_table(x, "newest", loads_by_day(x))
    return PT.read_latest(x.spark, path, DAY_ROWS, "ts bigint", "ts", upto=1706140800, strict=True)


@query("append_once", with_inputs("region_sample", "select * from by_second union all select * from by_second where ts >= 1705708800", BY_SECOND))
def _(x):
    """Two batches, both delivered twice, the second one a part of the first."""
    path, second = scratch_dir(x.spark, "once"), F.unix_timestamp(F.to_timestamp("datestamp", "yyyyMMdd"))
    rows = loads_by_day(x).withColumn("ts", second).drop("datestamp")
    for key, batch in (("all", rows), ("all", rows), ("late", rows.where("ts >= 1705708800")), ("late", rows)):
        PT.append_once(batch, path, ["ts"], key)
    return x.spark.read.schema(DAY_ROWS).parquet(path)


@query("missing_folders", with_inputs("region_sample", """select unnest(range(min(ts), max(ts) + 1, 86400)) ts from by_second
    except select distinct ts from by_second where ts % 259200 <> 0""", BY_SECOND))
def _(x):
    """Days without a folder, after every third one is dropped."""
    path = days_table(x, "missing", loads_by_day(x))
    days = PT.partition_values(x.spark, path, "ts bigint").select("ts", F.lit("t").alias("k"))
    span = days.agg(F.min("ts"), F.max("ts")).first()
    PT.drop_partitions(x.spark, path, "ts bigint", F.col("ts") % 259200 == 0)
    left = PT.partition_values(x.spark, path, "ts bigint").select("ts")
    expected = x.spark.range(span[0], span[1] + 1, 86400).select(F.col("id").alias("ts"))
    return expected.join(left, "ts", "left_anti")


@query("missing_partitions", f"""with h as (select distinct event_type, {EVENT_SEC} // 600 * 600 slot from events),
    e as (select event_type, unnest(range(min(slot), max(slot) + 1, 600)) slot from h group by 1) select * from e except select * from h""")
def _(x):
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return P.missing_partitions(x.table("events").select("event_type", (t - t % 600).alias("slot")), ["event_type"], "slot", 600)


@query("backfill_hours", f"""with h as (select distinct {EVENT_SEC} // 3600 * 3600 "hour" from events where event_type = 'error')
    select * from (select unnest(range(1706569200 - 240*3600, 1706569200, 3600)) "hour") except select * from h""")
def _(x):
    """Hours without an error event among the 240 before 2024-01-29 23:00."""
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    errors = x.table("events").where("event_type = 'error'").select((t - t % 3600).alias("hour"))
    return P.last_hours(errors, "hour", 1706569200, hours=240)


@query("thin_snapshots", f"""with f as ({DAYS}) select event_type, d from
    (select *, min(d) over (partition by event_type, date_trunc('week', d)) m from f) where d = m or date '2024-01-30' - d <= 7""")
def _(x):
    return P.thin_snapshots(event_days(x).distinct(), "d", "2024-01-30", 7, ["event_type"])


@query("last_good_snapshot", """with b as (select event_type, max(d) d from (select event_type, cast(ts as date) d from events
    group by 1, 2 having count(*) > 66) group by 1)
    select e.event_id, e.event_type, b.d from events e join b on e.event_type = b.event_type and cast(e.ts as date) = b.d""")
def _(x):
    """Newest day of each type with enough rows."""
    e = x.table("events").select("event_id", "event_type", F.col("ts").cast("date").alias("d"))
    return P.last_good_snapshot(e, "d", 66, ["event_type"])
