"""Load by serving region: hourly and daily summaries, region view, case view, provider rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casegauge import CASE
from casegauge.functions.metrics import guarded_ratio
from casegauge.functions.text import case_label
from casegauge.operators.joins import attach_target, share_of_total
from casegauge.operators.lists import joined_lists
from casegauge.operators.spread import with_totals
from casegauge.sources.snapshots import latest_partition

MIN_SHARE = 0.00005

# Columns of the region dimension that the summaries carry along.
REGION_INFO = ("name", "ecor", "continent", "country", "city", "latitude", "longitude", "asnum", "provider",
               "region_capacity", "ecor_capacity", "prp", "numghosts")


def _info(dim: DataFrame, names: Sequence[str] = REGION_INFO) -> list[Column]:
    return [F.round(n, 3).alias(n) if n in ("latitude", "longitude") else F.col(n) for n in names if n in dim.columns]


def case_region_detail(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Averages, maxima and sums per (case, region), one row per pair."""
    avg4 = lambda c: F.round(F.avg(c), 4)
    return samples.groupBy(*keys, "region").agg(
        F.round(F.avg("score"), 2).alias("avg_region_score"),
        F.round(F.max("score"), 2).alias("max_region_score"),
        avg4("nsd_demand").alias("avg_region_nsd_demand"), F.sum("nsd_demand").alias("region_nsd_demand"),
        avg4("eu_demand").alias("avg_region_eu_demand"), F.sum("eu_demand").alias("region_eu_demand"),
        F.sum("ra_load").alias("region_ra_load"),
        avg4("case_percent_pre_norm_load").alias("avg_case_percent_pre_norm_load"),
        avg4("case_percent_load").alias("avg_case_percent_load"),
        avg4("recorded_load_percentage").alias("avg_recorded_load_percentage"),
        F.max(F.greatest("case_percent_load", F.lit(0.0))).alias("_max_share"))


def region_summary(samples: DataFrame, regions: DataFrame, targets: DataFrame | None, keys: Sequence[str],
                   target_keys: Sequence[str] = CASE, snapshot: str = "day") -> DataFrame:
    """Per (case, region): its own figures, case totals, shares of the case in percent, region
    attributes of the newest snapshot and the case's target. Regions missing from the dimension and
    shares below 0.00005 percent are left out.

    The case totals are rolled up from the (case, region) aggregate, not from a second pass over
    the samples; `keys` may hold the hour, so many hours are summarised at once."""
    keys = list(keys)
    detail = case_region_detail(samples, keys)
    out = with_totals(
        detail, keys, case_ra_load=F.sum("region_ra_load"), case_nsd_demand=F.sum("region_nsd_demand"),
        case_eu_demand=F.sum("region_eu_demand"), case_sum_max_region_percent_load=F.round(F.sum("_max_share"), 4),
        case_uniq_region=F.count(F.lit(1))).drop("_max_share")
    out = out.withColumns({
        "case_percent_load": guarded_ratio("region_ra_load", "case_ra_load", 100, 4),
        "case_percent_nsd_demand": guarded_ratio("region_nsd_demand", "case_nsd_demand", 100, 4),
        "case_percent_eu_demand": guarded_ratio("region_eu_demand", "case_eu_demand", 100, 4),
    }).where(F.col("case_percent_load") >= MIN_SHARE)
    dim = latest_partition(regions, snapshot).select("region", *_info(regions))
    out = out.join(dim, "region")
    if targets is not None:
        out = attach_target(out, targets, target_keys)
    return out


def case_region_share(samples: DataFrame, load="ra_load", keys: Sequence[str] = CASE, member="region") -> DataFrame:
    """Load per (case, region), the case's total and the region's share in percent."""
    detail = samples.groupBy(*keys, member).agg(F.sum(load).alias("region_load"))
    return share_of_total(detail, keys, "region_load", "share", "case_load", digits=2)


def share_info() -> Column:
    """`case(share:load:total)`."""
    return F.concat(case_label(), F.lit("("), F.col("share").cast("string"), F.lit(":"),
                    F.col("region_load").cast("string"), F.lit(":"), F.col("case_load").cast("string"), F.lit(")"))


def region_view(samples: DataFrame, regions: DataFrame, keys: Sequence[str] = (), snapshot="day") -> DataFrame:
    """Per region: its attributes and the sorted set of `case(share:load:total)` descriptions.

    `keys` may add partition columns such as the hour."""
    shares = case_region_share(samples, keys=[*keys, *CASE])
    shares = shares.select(*keys, "region", share_info().alias("info"))
    view = joined_lists(shares, [*keys, "region"], {"distribution": F.col("info")}, [F.col("info")], sep=",",
                        count_name="cases")
    dim = latest_partition(regions, snapshot).select("region", *_info(regions))
    return view.join(dim, "region")


def case_view(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per case: totals and the sorted set of region descriptions, from `region_summary`."""
    def part(tag, value, total):
        pct = F.round(F.try_divide(F.lit(100.0) * F.col(value).cast("double"), F.col(total).cast("double")), 2)
        pct = F.when(F.col(total) > 0, pct).otherwise(F.lit(0.0))
        return [F.lit(f":{tag}_"), F.col(value), F.lit("_"), pct, F.lit("_")]

    attributes = [x for c in REGION_INFO if c in summary.columns for x in (F.lit(":"), F.col(c))]
    pieces = [F.col("region"), F.lit("("), F.col("avg_region_score"),
              *part("NSD", "region_nsd_demand", "case_nsd_demand"), *part("EU", "region_eu_demand", "case_eu_demand"),
              *part("LOAD", "region_ra_load", "case_ra_load"), *attributes, F.lit(")")]
    rows = summary.withColumn("info", F.concat(*[p.cast("string") for p in pieces]))
    group = [*keys, "score_target", "case_ra_load", "case_nsd_demand", "case_eu_demand", "case_uniq_region"]
    return joined_lists(rows, group, {"distribution": F.col("info")}, [F.col("info")], sep=",", count_name="regions")


def provider_rollup(regions: DataFrame, group: str, first_of: Sequence[str], sets: Sequence[str],
                    hosts: str = "numghosts", snapshot="day") -> DataFrame:
    """Newest region snapshot rolled up to a coarser key. Single-valued attributes use the least
    value (a deterministic choice); set-valued ones are sorted distinct lists of dimension values."""
    now = latest_partition(regions, snapshot)
    return now.groupBy(group).agg(
        *[F.min(c).alias(c) for c in first_of],
        *[F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(f"{c}_set") for c in sets],
        F.sum(hosts).alias(hosts), F.count(F.lit(1)).alias("regions"))


def provider_distribution(samples: DataFrame, regions: DataFrame, group: str, keys: Sequence[str] = CASE,
                          snapshot="day") -> DataFrame:
    """Per coarser key: cases with positive load as `case(share%:load:total)`.

    Loads are aggregated per (case, region) before the dimension join and again per (case, group)."""
    detail = case_region_share(samples, keys=keys)
    dim = latest_partition(regions, snapshot).select("region", group)
    by_group = detail.join(dim, "region").groupBy(group, *keys, "case_load").agg(F.sum("region_load").alias("load"))
    pct = F.round(F.try_divide(F.lit(100.0) * F.col("load").cast("double"), F.col("case_load").cast("double")), 2)
    info = F.concat(case_label(), F.lit("("), pct.cast("string"), F.lit("%:"), F.col("load").cast("string"),
                    F.lit(":"), F.col("case_load").cast("string"), F.lit(")"))
    rows = by_group.where(F.col("load") > 0).withColumn("info", info)
    return joined_lists(rows, [group], {"distribution": F.col("info")}, [F.col("info")], sep=",",
                        count_name="cases")
