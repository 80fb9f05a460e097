"""Streaming forms over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.operators.rolling import rolling_sink
from casegauge.operators.summary import Metric
from casegauge.plans.inputs_sql import REGION_OF, rounded, with_inputs
from casegauge.plans.registry import query
from casegauge.plans.summaries import metric_sql
from casegauge.session import scratch_dir
from casegauge.streaming import samples as ST


def streamed_events(x):
    """The events table as a stream; as a pattern, the path may be one file or a folder of files."""
    return ST.stream_samples(x.spark, f"{x.folder}/event[s].parquet", x.table("events").schema, format="parquet")


def samples(x, df):
    u, v = F.col("user_id"), F.col("value")
    return df.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (u % 5).cast("int").alias("maprule"), F.col("event_type").alias("geoname"),
                     F.when(u % 2 == 0, F.lit("ANY")).otherwise(F.lit("N1")).alias("netname"), x.region_of(u).alias("region"),
                     ((v * 100).cast("long").cast("double") / 128).alias("score"), v.cast("int").alias("nsd_demand"), (v * 100).cast("long").alias("ra_load"))


SAMPLES = f"""select event_id, ts, cast(user_id % 5 as int) maprule, event_type geoname, case when user_id % 2 = 0 then 'ANY' else 'N1' end netname,
    {REGION_OF} region, cast(cast(trunc(value*100) as bigint) as double)/128 score, cast(trunc(value) as int) nsd_demand, cast(trunc(value*100) as bigint) ra_load from events"""


@query("stream_hourly", f"""with s as ({SAMPLES}) select cast(floor(epoch(date_trunc('hour', ts))) as bigint) hour_start, maprule, geoname, netname, region,
    cast(sum(ra_load) as bigint) ra_load, cast(sum(nsd_demand) as bigint) nsd_demand, {rounded('avg(score)', 4)} avg_score, count(*) samples
    from s where date_trunc('hour', ts) + interval 1 hour <= date_trunc('milliseconds', (select max(ts) from s)) - interval 6 hour group by 1, 2, 3, 4, 5""")
def _(x):
    """Hours that are closed at the end of the stream, six hours of lateness allowed; late rows are counted in."""
    store, out, ledger = (scratch_dir(x.spark, n) for n in ("hourly-store", "hourly", "hourly-ledger"))
    ST.run_batches(samples(x, streamed_events(x)), scratch_dir(x.spark, "hourly-state"), ST.rebuild_hours(store, out, ledger, "ts"))
    newest = x.spark.read.parquet(ledger).agg(F.max("newest")).first()[0]
    rows = x.spark.read.parquet(out).withColumn("_end", F.timestamp_seconds(F.col("_hour") + 3600))
    closed = rows.where(F.col("_end") <= F.date_trunc("millisecond", F.lit(newest)) - F.make_interval(hours=F.lit(6)))
    return closed.select(F.col("_hour").cast("long").alias("hour_start"), *CASE, "region", "ra_load", "nsd_demand",
                         F.round("avg_score", 4).alias("avg_score"), "samples")


@query("stream_dedup", f"select event_id, maprule, geoname, region, ra_load from ({SAMPLES})")
def _(x):
    """Each sample delivered twice, kept once."""
    twice = samples(x, streamed_events(x)).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = scratch_dir(x.spark, "dedup")
    ST.run_batches(twice, scratch_dir(x.spark, "dedup-state"), ST.keep_first(out, "ts", ["event_id"]))
    return ST.batch_rows(x.spark, out, "event_id bigint, maprule int, geoname string, region bigint, ra_load bigint")


@query("stream_partitioned_sink", f"select event_id, maprule, geoname, strftime(ts, '%Y%m%d') datestamp from ({SAMPLES})")
def _(x):
    """Batches lie by day and batch; the stream is run twice and the result stays."""
    out = scratch_dir(x.spark, "replace")
    rows = samples(x, streamed_events(x)).select("event_id", "maprule", "geoname", F.date_format("ts", "yyyyMMdd").alias("datestamp"))
    for run in (1, 2):
        ST.run_batches(rows, scratch_dir(x.spark, f"replace-state{run}"), ST.replace_partitions(out, ["datestamp"]))
    return ST.batch_rows(x.spark, out, "event_id bigint, maprule int, geoname string, datestamp string")


DEMAND = Metric("dem", "nsd_demand", "target", "target")


@query("stream_rolling_summary", with_inputs("", f"""select maprule, geoname, netname, window_end, {', '.join(metric_sql(DEMAND))}, min(target) target, count(*) n_count from
    (select *, 100 target, unnest(range(cast(floor(epoch(ts)) as bigint)//86400*86400 + 86400, cast(floor(epoch(ts)) as bigint)//86400*86400 + 3*86400 + 1, 86400)) window_end
     from ({SAMPLES})) group by 1, 2, 3, 4"""))
def _(x):
    """Three-day percentiles of every day, made from the day states that a batch can touch."""
    states, out = scratch_dir(x.spark, "states"), scratch_dir(x.spark, "rolling")
    rows = samples(x, streamed_events(x)).select(*CASE, F.unix_timestamp("ts").alias("sec"), "nsd_demand", F.lit(100).alias("target"))
    ST.run_batches(rows, scratch_dir(x.spark, "rolling-state"), rolling_sink(states, "sec", 3, [DEMAND], out))
    return x.spark.read.parquet(out).withColumn("window_end", F.col("window_end").cast("long"))
