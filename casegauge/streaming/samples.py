"""Streams of sample files: hourly rollups with late data, deduplication, rolling summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casegauge import CASE
from casegauge.sources.tables import overwrite_partition, tag_from_filename

LATE, LATE_SECONDS = "6 hours", 6 * 3600
BATCH = "_batch"


def stream_samples(spark: SparkSession, folder: str, schema: StructType | str, format: str = "csv", glob: str | None = None,
                   name_pattern: str | None = None, names: Sequence[str] = (), per_trigger: int | None = None, **options) -> DataFrame:
    """Every file of a folder once; the file names may carry columns such as the sample time.

    A batch takes all files that are there, unless `per_trigger` names a number; how files are cut into batches
    does not change what the sinks below end up with."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(folder)
    return tag_from_filename(df, name_pattern, names) if name_pattern else df


def _hour_columns() -> list[Column]:
    return [F.sum("ra_load").alias("ra_load"), F.sum("nsd_demand").alias("nsd_demand"), F.avg("score").alias("avg_score"),
            F.count(F.lit(1)).alias("samples")]


def hour_parts(samples: DataFrame, time: str, keys: Sequence[str] = (*CASE, "region")) -> DataFrame:
    """`_day`, `_hour` (seconds), keys and the sums and counts that parts of an hour are merged from."""
    second = F.unix_timestamp(time)
    rows = samples.withColumns({"_hour": second - second % 3600, "_day": second - second % 86400})
    return rows.groupBy("_day", "_hour", *keys).agg(
        F.sum("ra_load").alias("ra_load"), F.sum("nsd_demand").alias("nsd_demand"), F.sum("score").alias("score_sum"),
        F.count("score").alias("scores"), F.count(F.lit(1)).alias("samples"))


def merged_hours(parts: DataFrame, keys: Sequence[str] = (*CASE, "region")) -> DataFrame:
    """Parts of hours added up to `ra_load`, `nsd_demand`, `avg_score`, `samples` per hour and key."""
    mean = F.try_divide(F.sum("score_sum").cast("double"), F.sum("scores").cast("double"))
    return parts.groupBy("_hour", *keys).agg(F.sum("ra_load").alias("ra_load"), F.sum("nsd_demand").alias("nsd_demand"),
                                             mean.alias("avg_score"), F.sum("samples").alias("samples"))


def hourly_rollup(samples: DataFrame, time: str, keys: Sequence[str] = (*CASE, "region"), late: str = LATE,
                  width: str = "1 hour") -> DataFrame:
    """Sums, means and counts per tumbling hour and key, for streams that arrive in time order. Rows later than
    `late` are dropped; an hour is emitted once, when no row for it can be accepted any more. State: one row per
    open (hour, key). Where files may come in any order, use `rebuild_hours`."""
    w = F.window(time, width)
    return (samples.withWatermark(time, late).groupBy(w.alias("_w"), *keys).agg(*_hour_columns())
            .select(F.col("_w.start").alias("hour_start"), *keys, "ra_load", "nsd_demand", "avg_score", "samples"))


def rebuild_hours(store: str, target: str, ledger: str, time: str, keys: Sequence[str] = (*CASE, "region"),
                  late_seconds: int = LATE_SECONDS) -> Callable[[DataFrame, int], None]:
    """Batch sink: hourly sums, means and counts in which every row counts, however late it is.

    A batch is reduced to parts of hours: sums and counts per hour and key, no samples. The parts lie by day and batch in
    `store`. Then the parts of the hours that the batch touches, and no others, are merged and replace their partitions
    (`_hour`, seconds) of the target: a late batch reads the few parts of its hours. The ledger gets one row per batch and hour:
    its rows, how many of them were more than `late_seconds` behind the newest row of the batches before, and the newest
    time. A repeated batch has one effect."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        second = F.unix_timestamp(time)
        entries = "_hour long, rows long, late long, newest timestamp, _batch int"
        before = spark.read.schema(entries).parquet(ledger).where(F.col(BATCH) < number).agg(F.max("newest")).first()[0] if number else None
        late = F.lit(False) if before is None else F.col(time) < F.lit(before) - F.make_interval(secs=F.lit(late_seconds))
        seen = batch.groupBy((second - second % 3600).alias("_hour")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"), F.max(time).alias("newest"))
        parts = hour_parts(batch, time, keys)
        overwrite_partition(parts.withColumn(BATCH, F.lit(number)), store, ["_day", BATCH])
        overwrite_partition(seen.withColumn(BATCH, F.lit(number)), ledger, [BATCH])
        touched = touched_parts(spark, store, f"{parts.schema.toDDL()}, {BATCH} int", number)
        overwrite_partition(merged_hours(touched, keys), target, ["_hour"])

    return each


def touched_parts(spark: SparkSession, store: str, schema: str, number: int) -> DataFrame:
    """All parts of the hours that a batch has parts of. Hours and days are literals (a bounded list: the calendar's), so
    only their folders are listed and other hours are skipped inside the files."""
    parts = spark.read.schema(schema).parquet(store)
    hours = [r[0] for r in parts.where(F.col(BATCH) == number).select("_hour").distinct().collect()]
    days = {None if h is None else h - h % 86400 for h in hours}
    return parts.where(_among("_day", days) & _among("_hour", hours)).drop(BATCH, "_day")


def _among(column: str, values) -> Column:
    """A column's value is one of the listed ones; null may be listed."""
    known = sorted(v for v in values if v is not None)
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if None in set(values) else found


def dedup_samples(samples: DataFrame, time: str, ids: Sequence[str], late: str = LATE) -> DataFrame:
    """Drops repeats of a sample that arrive within the watermark, and rows behind it: for streams in time order.
    Where files may come in any order, use `keep_first`."""
    return samples.withWatermark(time, late).dropDuplicatesWithinWatermark(list(ids))


def keep_first(store: str, time: str, ids: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch sink that keeps one row for each identifier, however late its repeats come. Repeats have the same time, so
    a batch is compared with the days it touches only: they are literals (the calendar bounds their number), so the
    folders of other days are not read, whatever the length of the store. Rows lie by day and batch (`batch_rows` reads them)."""

    def each(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(list(ids)).withColumn("_day", F.date_format(time, "yyyyMMdd"))
        if number:
            days = [r[0] for r in fresh.select("_day").distinct().collect()]
            fresh = fresh.join(known_ids(batch.sparkSession, store, fresh, ids, days, number), [*ids, "_day"], "left_anti")
        overwrite_partition(fresh.withColumn(BATCH, F.lit(number)), store, ["_day", BATCH])

    return each


def known_ids(spark: SparkSession, store: str, like: DataFrame, ids: Sequence[str], days: Sequence[str], before: int) -> DataFrame:
    """Identifiers that earlier batches have stored for some days."""
    fields = ", ".join([*(f"`{n}` {t}" for n, t in like.select(*ids).dtypes), "_day string", f"{BATCH} int"])
    return spark.read.schema(fields).parquet(store).where(_among("_day", days) & (F.col(BATCH) < before)).select(*ids, "_day")


def run_available(df: DataFrame, path: str, checkpoint: str, parts: Sequence[str] = ()) -> StreamingQuery:
    """Process all files present and stop; results are appended exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if parts:
        writer = writer.partitionBy(*parts)
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_batches(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand every micro-batch to `each`, all files present, then stop."""
    q = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def replace_partitions(path: str, parts: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch sink: a repeated batch replaces its own rows and leaves those of other batches, also in the partitions
    that they share. Rows lie below the partition columns and the batch (`batch_rows` reads them)."""
    return lambda batch, number: overwrite_partition(batch.withColumn(BATCH, F.lit(number)), path, [*parts, BATCH])


def batch_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of a batch sink, without its own columns."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(fields).parquet(path).select(*fields.fieldNames())


def store_then_recompute(store: str, ts: str, compute: Callable[[DataFrame], DataFrame], target: str, part: str,
                         reach: int, step: int) -> Callable[[DataFrame, int], None]:
    """Batch sink for results without an incremental form, such as exact percentiles over days.

    The batch is added to the sample store, partitioned by time step and batch id, so a repeated
    batch replaces its own rows. Then only the windows the batch can touch are recomputed, from the
    store partitions within `reach` of it, and replace their partitions of the target. `step` is the
    distance between windows."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stepped = batch.withColumns({"_step": F.floor(F.col(ts) / step).cast("long"), "_batch": F.lit(batch_id)})
        overwrite_partition(stepped, store, ["_step", "_batch"])
        rows = spark.read.parquet(store)
        span = rows.where(F.col("_batch") == batch_id).agg(F.min("_step"), F.max("_step")).first()
        if span[0] is None:
            return
        first, last = span[0] * step, span[1] * step
        near = rows.where(F.col("_step").between(span[0] - reach // step, span[1] + reach // step)).drop("_batch", "_step")
        done = compute(near).where((F.col(part) > first) & (F.col(part) <= last + reach))
        overwrite_partition(done, target, [part])

    return each
