"""Ratio, cost, coverage and target operators over traffic tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casegauge.functions.metrics import guarded_ratio, severity_index, target_ratio
from casegauge.operators.joins import wildcard_join
from casegauge.operators.spread import split_join
from casegauge.sources.snapshots import latest_partition
from casegauge.sources.tables import stored


def pivot_percentiles(df: DataFrame, keys: Sequence[str], levels: dict[str, str], level="config_percentile",
                      value="metric_value") -> DataFrame:
    """Long (percentile, value) rows to one column per percentile, 0 where missing.

    The level is a decimal, compared with decimals: 0.99 must not depend on binary rounding."""
    picks = [F.max(F.when(F.col(level) == F.lit(p).cast("decimal(8,6)"), F.col(value)).otherwise(F.lit(0))).alias(name)
             for name, p in levels.items()]
    return df.groupBy(*keys).agg(*picks)


def machine_traffic(traffic: DataFrame, machines: DataFrame, counters: Sequence[str], rule="maprule_id",
                    on: Sequence[str] = ("ghostip", "ts"), by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Machine counters summed per (rule, region). Counters are first summed per machine and rule,
    so the join moves one row per (machine, rule) instead of every traffic record."""
    on, by = list(on), list(by)
    rows = traffic if where is None else traffic.where(where)
    per_machine = rows.groupBy(*on, rule, *by).agg(*[F.sum(c).alias(c) for c in counters])
    located = per_machine.join(machines.select(*on, "region"), on)
    return located.groupBy(rule, "region", *by).agg(*[F.sum(c).alias(c) for c in counters])


def region_share_view(view: DataFrame, keys: Sequence[str] = ("mapruleid", "geo", "aslist")) -> DataFrame:
    """One row per (case, region): name and share, the highest where repeated."""
    return view.groupBy(*keys, "regionid").agg(F.max("casename").alias("casename"), F.max("percentage").alias("percentage"))


def coverage_pct(view: DataFrame, by: Sequence[str] = ("casename",)) -> DataFrame:
    """Sum of the region shares of a case."""
    return _coverage(region_share_view(view), by)


def _coverage(shares: DataFrame, by: Sequence[str] = ("casename",)) -> DataFrame:
    return shares.groupBy(*by).agg(F.sum("percentage").alias("coverage_pct"))


def _case_traffic(targets: DataFrame, shares: DataFrame, traffic: DataFrame) -> DataFrame:
    cases = wildcard_join(targets, shares)
    keyed = traffic.withColumnsRenamed({"maprule_id": "maprule", "region": "regionid"})
    return cases.join(keyed, ["maprule", "regionid"])


def pooled_io_ratio(targets: DataFrame, view: DataFrame, traffic: DataFrame) -> DataFrame:
    """100 * bytes in / bytes, pooled over the regions of a case."""
    rows = _case_traffic(targets, region_share_view(view), traffic)
    return rows.groupBy("casename").agg(
        F.sum("bytes").alias("_b"), F.sum("bytes_in").alias("_i"), F.max("targetvalue").alias("targetvalue"),
        F.sum((F.lit(100.0) * F.col("percentage")).cast("int")).alias("coverage_pct")).select(
        "casename", guarded_ratio("_i", "_b", 100, 4).alias("in_out_ratio"), "targetvalue", "coverage_pct")


def weighted_io_ratio(targets: DataFrame, view: DataFrame, traffic: DataFrame, min_bytes: int | None = None) -> DataFrame:
    """Ratio per region, weighted with the region's share of the case's coverage; optionally only
    regions with more than `min_bytes` bytes. The view is reduced to region shares once; they are stored, as both the
    traffic and the coverage are taken from them."""
    t = traffic if min_bytes is None else traffic.where(F.col("bytes") > min_bytes)
    shares = stored(region_share_view(view), "shares")
    rows = split_join(_case_traffic(targets, shares, t), _coverage(shares), ["casename"])
    ratio = F.try_divide(F.lit(100.0) * F.col("bytes_in").cast("double"), F.col("bytes").cast("double"))
    part = F.try_divide(ratio * F.col("percentage"), F.col("coverage_pct"))
    return rows.groupBy("casename").agg(
        F.round(F.sum(F.when(F.col("bytes") > 0, part).otherwise(F.lit(0.0))), 4).alias("in_out_ratio"),
        F.max("targetvalue").alias("targetvalue"), F.max("coverage_pct").cast("int").alias("coverage_pct"))


def region_rates(traffic: DataFrame, regions: DataFrame, rates: DataFrame) -> DataFrame:
    """Traffic per (rule, region) with the bandwidth rate of the region's location."""
    return traffic.join(regions, "region").join(rates, "location").select("region", "maprule_id", "bytes", "nominalrate")


def weighted_cost(targets: DataFrame, view: DataFrame, rated: DataFrame) -> DataFrame:
    """Cost, byte-weighted and plain mean rate (in thousandths) and coverage per case."""
    rows = _case_traffic(targets, region_share_view(view), rated)
    cost, total = F.sum(F.col("bytes") * F.col("nominalrate")), F.sum("bytes")
    mean = F.try_divide(F.lit(1000.0) * cost, total.cast("double")).cast("int")
    return rows.groupBy("casename").agg(
        F.min("targetvalue").alias("targetvalue"), cost.cast("long").alias("total_cost"),
        F.when(total > 0, mean).otherwise(F.lit(0)).alias("wavg_rate_x1000"),
        (F.lit(1000.0) * F.avg("nominalrate")).cast("int").alias("avg_rate_x1000"),
        (F.lit(100.0) * F.sum("percentage")).cast("int").alias("coverage_pct"))


def load_share(overview: DataFrame, targets: DataFrame) -> DataFrame:
    """Load in mega units, ping part, and ping share in hundredths of a percent, for cases with a target."""
    mega = F.col("ra_load_total").cast("double") / 1024 / 1024
    cases = overview.select("casename", "mapruleid", "geo", "aslist", mega.cast("int").alias("total_bps"),
                            (mega * F.col("ping_perc") / 100).cast("int").alias("ping_bps"))
    keys = targets.select("maprule", "geoname", "netname").distinct()
    share = F.try_divide(F.lit(10000.0) * F.col("ping_bps"), F.col("total_bps").cast("double")).cast("int")
    return wildcard_join(keys, cases).select(
        "casename", "maprule", "geoname", "netname", "total_bps", "ping_bps",
        F.when(F.col("total_bps") > 0, share).otherwise(F.lit(0)).alias("p2t_bps_pct"))


def io_case_rollup(samples: DataFrame, traffic: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Demand and load of a case with the machine counters of its (rule, region) pairs.

    Both sides are summed to (rule, region) grain before they meet; the counters count once per
    sample row, as in the row-level join."""
    counters = ("bytes", "bytes_in", "hits", "connections", "flytes", "cpu", "disk")
    per_region = samples.groupBy(*keys, "region").agg(
        *[F.sum(c).alias(c) for c in ("nsd_demand", "eu_demand", "ra_load")], F.count(F.lit(1)).alias("_n"))
    rows = per_region.join(traffic.drop("ts").withColumnRenamed("maprule_id", "maprule"), ["maprule", "region"])
    s = {c: F.sum(F.col(c) * F.col("_n")) for c in counters}
    return rows.groupBy(*keys).agg(
        F.sum("nsd_demand").alias("nsd_demand"), F.sum("eu_demand").alias("eu_demand"), F.sum("ra_load").alias("ra_load"),
        *[e.alias(f"_{c}") for c, e in s.items()]).select(
        *keys, "nsd_demand", "eu_demand", "ra_load",
        guarded_ratio("_bytes_in", "_bytes", 100, 3).alias("in_out_ratio"),
        F.col("_hits").alias("hits"), F.col("_connections").alias("connections"),
        guarded_ratio("_bytes", "_flytes", 100, 3).alias("b2f_ratio"),
        F.round(F.col("_cpu").cast("double") / 1000000, 3).alias("m_cpu"), F.col("_disk").alias("disk"))


def coverage_by(df: DataFrame, by: Sequence[str], snapshot: str | None = "day") -> DataFrame:
    """Demand-weighted coverage percentages of the newest day; null where nothing is covered. Without `snapshot` the rows are
    those of one day: a caller who knows the newest day from the source does not compute the table for its maximum."""
    w = F.col("sum_demand") * F.col("has_pp_pct")
    rows = (df if snapshot is None else latest_partition(df, snapshot)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("asns"), F.sum("sum_demand").alias("_d"),
        F.sum(w * F.col("in_country_pct")).alias("_c"), F.sum(w * F.col("in_asn_pct")).alias("_a"),
        F.sum(w).alias("_h"), F.sum(w * F.col("weighted_distance")).alias("_m"))
    return rows.select(
        *by, "asns", F.round("_d", 2).alias("tot_demands"),
        guarded_ratio("_c", "_h", 100, 2, None).alias("in_country_pct"),
        guarded_ratio("_a", "_h", 100, 2, None).alias("in_asn_pct"),
        guarded_ratio("_h", "_d", 100, 2, None).alias("has_pp_pct"),
        guarded_ratio("_m", "_h", 1, 2, None).alias("avg_distance"))


def violation_flags() -> dict[str, Column]:
    """Ten 0/1 flags: the high percentile (or low one for shares) and the median against the target."""
    over = lambda v, t: (F.col(v) > F.col(t)).cast("int")
    under = lambda v, t: (F.col(v) < F.col(t)).cast("int")
    flag = lambda c: F.coalesce(c, F.lit(0))
    return {
        "scr95": flag(over("score95_q95", "score_tar")), "scr50": flag(over("score95_med", "score_tar")),
        "dis95": flag(over("dis95_q95", "dis_tar")), "dis50": flag(over("dis95_med", "dis_tar")),
        "ict05": flag(under("ict_q05", "ict_tar")), "ict50": flag(under("ict_med", "ict_tar")),
        "icy05": flag(under("icy_q05", "icy_tar")), "icy50": flag(under("icy_med", "icy_tar")),
        "ior95": flag(over("ioratio_q95", "ioratio_tar")), "ior50": flag(over("ioratio_med", "ioratio_tar")),
    }


def fresh_rows(df: DataFrame, now: int, end_date="enddate", within: int = 86400) -> DataFrame:
    """Rows whose end date (yyyy-MM-dd) is less than a day old."""
    return df.where(F.lit(now) - F.unix_timestamp(end_date, "yyyy-MM-dd") < within)


def violation_share(df: DataFrame, weight: str, sets: Sequence[Sequence[str]], columns: Sequence[str],
                    positive_load_only: bool = False) -> DataFrame:
    """Share of networks in violation, plain and load-weighted, for several groupings in one pass."""
    rows = df.where(F.col(weight) > 0) if positive_load_only else df
    flags = violation_flags()
    rows = rows.select(*columns, F.col(weight).cast("double").alias("_w"), *[c.alias(f"_{n}") for n, c in flags.items()])
    aggs = [F.round(F.avg(f"_{n}"), 2).alias(f"{n}f") for n in flags]
    aggs += [F.round(F.try_divide(F.sum(F.col(f"_{n}") * F.col("_w")), F.sum("_w")), 2).alias(f"{n}fw") for n in flags]
    return rows.groupingSets([list(s) for s in sets], *columns).agg(*aggs)


def target_profile(df: DataFrame, cap: float = 10.0) -> DataFrame:
    """Metric over target per case, capped: high and median score and distance, the complements of
    the in-country and in-continent shares, the non-ping part of the load and the ping share."""
    off = lambda c: F.lit(100) - F.col(c)
    non_ping = F.lit(1.0) - F.try_divide(F.col("ping_mbps") + 0.001, F.col("total_mbps") + 0.001)
    return df.select(
        "maprule", "geoname", "netname",
        target_ratio("sp95_t95", "star", cap).alias("score_hi"), target_ratio("sp95_t50", "star", cap).alias("score_med"),
        target_ratio("dp95_t95", "dtar", cap).alias("dist_hi"), target_ratio("dp95_t50", "dtar", cap).alias("dist_med"),
        target_ratio(off("icy_t95"), off("icy_tar"), cap).alias("ocy_hi"),
        target_ratio(off("icy_t50"), off("icy_tar"), cap).alias("ocy_med"),
        target_ratio(off("ict_t95"), off("ict_tar"), cap).alias("oct_hi"),
        target_ratio(off("ict_t50"), off("ict_tar"), cap).alias("oct_med"),
        target_ratio(non_ping, F.lit(0.05), cap).alias("nonping"),
        target_ratio("p2t_bps_pct_min", F.lit(9500.0), cap).alias("ping_share"))


def severity(df: DataFrame, continent_geos: Sequence[str], geo="geoname") -> DataFrame:
    """Severity index of score, distance and geography deficits; for the listed geos the continent
    deficit (and target) stands in for the country deficit."""
    swap = F.col(geo).isin(list(continent_geos))
    cy = F.when(swap, F.col("avg_ictd")).otherwise(F.col("avg_icyd"))
    return df.select("maprule", "geoname", "netname",
                     F.round(severity_index("avg_sp95d"), 6).alias("sev_score"),
                     F.round(severity_index("avg_dp95d"), 6).alias("sev_distance"),
                     F.round(severity_index(cy), 6).alias("sev_geo"),
                     F.when(swap, F.col("ict_tar")).otherwise(F.col("icy_tar")).alias("geo_target"))


def deficiency_total(df: DataFrame, keys: Sequence[str] = ("geoname", "maprule", "netname")) -> DataFrame:
    """The four mean deficits and their sum."""
    parts = ["avg_sp95d", "avg_dp95d", "avg_icyd", "avg_ictd"]
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.select(*keys, *parts, F.round(total, 2).alias("deficiency"))


def clean_summary(df: DataFrame, drop: Sequence[str], geo="geoname", rule="maprule") -> DataFrame:
    """Nulls to 0, only two-letter geos and positive rules, without the named columns."""
    return df.na.fill(0).where((F.length(geo) == 2) & (F.col(rule) > 0)).drop(*drop)


