"""Top-n rows per key with running and relative shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 30, rank: str = "rank") -> DataFrame:
    """The first n rows per key. Every task cuts its rows to n per key before the shuffle, so a hot
    key moves at most n rows per task."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_n_shares(df: DataFrame, keys: Sequence[str], load: str, share: str, tie: str, n: int = 30) -> DataFrame:
    """Top n by load with the running share, its maximum, and the load ratio in percent of the kept
    rows' total (-1 where that total is 0). Windows see at most n rows per key."""
    top = top_n_per_key(df, keys, [F.col(load).desc(), F.col(tie)], n)
    by = W.partitionBy(*keys)
    running = by.orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    out = top.withColumn("cum_share", F.sum(share).over(running)).withColumn("_total", F.sum(load).over(by))
    ratio = F.try_divide(F.lit(100.0) * F.col(load).cast("double"), F.col("_total").cast("double"))
    return out.withColumns({
        "load_ratio": F.when(F.col("_total") > 0, F.round(ratio, 4)).otherwise(F.lit(-1.0)),
        "max_cum_share": F.round(F.max("cum_share").over(by), 4),
        "cum_share": F.round("cum_share", 4),
    }).drop("_total")
