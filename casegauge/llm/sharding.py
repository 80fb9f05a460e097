"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one gives every row its shard (a seeded rendezvous hash of identifier and shard count: with one
more shard, rows move only into the new one) and scatters it uniformly, by another seeded hash, into
buckets of a shard that fit in memory. Pass two brings each bucket together, shuffles it (Spark's
`shuffle` of an array is Fisher-Yates) and numbers its rows after those of the buckets before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegauge.llm.common import packed, stored, unpacked

BUCKET_BYTES = 16 << 20


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with the key is largest. Ties cannot decide: the shard number is compared next."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*draws) if shards > 1 else draws[0]).getField("s")


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17,
            bucket_bytes: int = BUCKET_BYTES, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `shard`, `slot` (its place in the shard, gapless from 0), `size` (UTF-8 bytes of the
    text plus 1), `text_crc32`, `law` ('key') and `grown_shard` (its shard with one shard more).

    The shard depends on identifier and shard count alone; a null identifier is a key like any other.
    The bucket also depends on the row's place in the stored pass, so that an identifier which many rows
    repeat is spread over all buckets of its shard. A null text has size 1 and the checksum of an empty
    text. An empty table gives an empty result. `carry` names the columns passed on (None: all); a result
    column replaces an input column of its name."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = docs[id_col].cast("string")
    placed = packed(docs, carry, shard=rendezvous(key, shards, seed), grown=rendezvous(key, shards + 1, seed),
                    size=F.octet_length(text).cast("long") + 1, crc=F.crc32(text.cast("binary")),
                    tie=F.monotonically_increasing_id())
    scattered = stored(placed.withColumn("draw", F.xxhash64(F.lit(seed + 1), "tie")), "scatter")

    total = scattered.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    rows = scattered.withColumn("bucket", F.pmod("draw", F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # one row for each bucket
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))

    dealt = rows.repartition(shards * buckets, "shard", "bucket").join(starts, ["shard", "bucket"])
    packs = dealt.groupBy("shard", "bucket", "start").agg(
        F.array_sort(F.collect_list(F.struct("draw", "tie", "row", "size", "crc", "grown"))).alias("pack"))
    out = packs.select("shard", "start", F.posexplode(F.shuffle("pack", seed)).alias("pos", "x"))
    return unpacked(out.select("shard", (F.col("start") + F.col("pos")).alias("slot"), "x", F.col("x.row").alias("row")), carry,
                    docs.columns, size=F.col("x.size"), text_crc32=F.col("x.crc"), law=F.lit("key"), shard=F.col("shard"),
                    slot=F.col("slot"), grown_shard=F.col("x.grown"))


def write_shards(docs: DataFrame, path: str, shards: int, format: str = "parquet", **options) -> None:
    """Write the shuffled rows, one folder for each shard; each task writes the buckets that it holds."""
    sharded(docs, shards, **options).write.partitionBy("shard").format(format).mode("overwrite").save(path)
