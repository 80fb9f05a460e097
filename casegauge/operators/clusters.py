"""Client groups clustered by the regions they can reach, and what those clusters depend on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge.functions.geo import centroid_aggs, centroid_columns, haversine_miles
from casegauge.functions.metrics import class_map, split_by_class
from casegauge.functions.text import EMPTY_LIST
from casegauge.operators.joins import distance_join, explode_join
from casegauge.operators.lists import first_items, items_with_totals, joined_lists
from casegauge.operators.nearby import nearby_sums
from casegauge.operators.spread import split_join
from casegauge.sources.tables import stored

NEAR_MILES, SAME_COUNTRY_MILES = 500.0, 1000.0
MIN_LOAD = 0.0001


def serving_regions(regions: DataFrame, classes: dict[str, str], other: str = "O", unit: float = 1000.0) -> DataFrame:
    """Regions of the wanted service classes with capacities in thousands and a private flag."""
    gbps = lambda c: F.round(F.col(c).cast("double") / unit, 3)
    rows = regions.where(F.col("peak_bitcap_mbps").isNotNull() & F.col("peak_flitcap_mfps").isNotNull())
    rows = rows.select("region", F.col("latitude").alias("rg_lat"), F.col("longitude").alias("rg_lon"),
                       gbps("peak_bitcap_mbps").alias("bit_gbps"), gbps("peak_flitcap_mfps").alias("flit_gfps"),
                       F.col("country").alias("rg_country"), "numvips",
                       class_map("network", classes, other).alias("service"),
                       (F.col("prp") == "private").cast("int").alias("private"))
    return rows.where(F.col("service").isin(list(classes.values())))


def reachable_regions(groups: DataFrame, regions: DataFrame, near: float = NEAR_MILES,
                      same_country: float = SAME_COUNTRY_MILES, min_gbps: float = 1.0) -> DataFrame:
    """(group, region) pairs on the group's allow list: near, or less near in the same country, and
    with enough capacity. An equi-join on the listed ids; the distance is a filter."""
    pairs = explode_join(groups, "allowed", regions.where(F.col("bit_gbps") > min_gbps), "region")
    pairs = pairs.withColumn("distance", haversine_miles("lat", "lon", "rg_lat", "rg_lon"))
    return pairs.where((F.col("distance") < near)
                       | ((F.col("country") == F.col("rg_country")) & (F.col("distance") < same_country)))


def group_regions(pairs: DataFrame, carry: Sequence[str] = ("country", "load", "lat", "lon")) -> DataFrame:
    """Per group: sorted region list (no longer than its allow list), mean distance, capacities per
    class, vips and count."""
    cap = lambda c, code: F.round(F.sum(split_by_class(c, "service", code)), 2)
    return pairs.groupBy("mpgid", *carry).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("region")), lambda r: r.cast("string")), ":").alias("region_list"),
        F.round(F.avg("distance"), 2).alias("avg_distance"), cap("bit_gbps", "W").alias("cap_w"),
        cap("bit_gbps", "S").alias("cap_s"), F.sum("numvips").alias("nvips"), F.count(F.lit(1)).alias("nreg"))


def cluster_by_set(grouped: DataFrame) -> DataFrame:
    """Groups with the same region list merged: load, load-weighted distance, member count, sorted
    countries, weighted centroid. Only sums travel, whatever the size of a cluster."""
    w = F.col("load")
    merged = grouped.groupBy("region_list").agg(
        F.round(F.try_divide(F.sum(F.col("avg_distance") * w), F.sum(w)), 2).alias("avg_distance"),
        F.max("cap_w").alias("cap_w"), F.max("cap_s").alias("cap_s"), F.max("nvips").alias("nvips"),
        F.max("nreg").alias("nreg"), F.sum(w).alias("_load"), F.count(F.lit(1)).alias("nmpg"),
        F.array_join(F.array_sort(F.collect_set("country")), ":").alias("geoname"),
        *centroid_aggs("lat", "lon", "load")).where(F.col("_load") > MIN_LOAD)
    return merged.select("region_list", "geoname", "avg_distance", *centroid_columns("cl_"), "cap_w", "cap_s",
                         "nvips", "nreg", F.round("_load", 6).alias("load"), "nmpg")


def distinct_members(grouped: DataFrame, member: str) -> DataFrame:
    return grouped.select("region_list", member).where(F.col(member).isNotNull()).distinct()


def cluster_members(grouped: DataFrame, member: str, count_name: str = "n_members") -> DataFrame:
    """The distinct members (groups, networks, addresses) of every cluster, one row each, with their number."""
    return items_with_totals(distinct_members(grouped, member), ["region_list"], count_name)


def cluster_addresses(grouped: DataFrame, addresses: DataFrame, member: str = "mpgid", address: str = "nsip", n: int = 5) -> DataFrame:
    """Per cluster: the number of distinct addresses of its groups and the first n in one string; the marker word and 0
    where its groups have none. `addresses` has one row per group and address."""
    rows = grouped.select("region_list", member).distinct().join(addresses.select(member, address), member)
    lists = first_items(rows.select("region_list", address).where(F.col(address).isNotNull()).distinct(), ["region_list"], address, n,
                        f"first_{address}s", count_name=f"n_{address}s")
    return split_join(grouped.select("region_list").distinct(), lists, ["region_list"], "left").select(
        "region_list", F.coalesce(f"n_{address}s", F.lit(0).cast("long")).alias(f"n_{address}s"),
        F.coalesce(f"first_{address}s", F.lit(EMPTY_LIST)).alias(f"first_{address}s"))


def weighted_centroid(df: DataFrame, keys: Sequence[str], lat="lat", lon="lon", weight="load") -> DataFrame:
    """Load-weighted centroid per key, for keys with a load above 0.0001."""
    return (df.groupBy(*keys).agg(*centroid_aggs(lat, lon, weight)).where(F.col("_w") > MIN_LOAD)
            .select(*keys, *centroid_columns("cl_")))


def region_sites(regions: DataFrame) -> DataFrame:
    """Regions at one position as one site: summed capacity, vips and count."""
    return regions.groupBy("rg_lat", "rg_lon").agg(
        F.sum("bit_gbps").alias("site_bit"), F.sum("flit_gfps").alias("site_flit"),
        F.sum("numvips").alias("site_vips"), F.count(F.lit(1)).alias("site_regions"))


def attach_public(clusters: DataFrame, regions: DataFrame, miles: float = NEAR_MILES) -> DataFrame:
    """Public regions near the centroid: capacity, vips and count; a cluster without any keeps its
    row with zeros. Whole cells of clusters and regions are matched, so neither crowded regions nor crowded
    clusters form pairs."""
    sites = region_sites(regions.where(F.col("private") == 0))
    sums = {"pub_bit_gbps": "site_bit", "pub_flit_gbps": "site_flit", "pub_vips": "site_vips", "pub_nreg": "site_regions"}
    out = nearby_sums(clusters, sites, miles, sums, ("cl_lat", "cl_lon"))
    return out.withColumns({c: F.round(c, 3) for c in ("pub_bit_gbps", "pub_flit_gbps")})


def public_pairs(clusters: DataFrame, regions: DataFrame, miles: float = NEAR_MILES, key: str = "region_list") -> DataFrame:
    """(cluster, region) pairs of the public regions near each centroid, found by their sites."""
    public = regions.where(F.col("private") == 0)
    near = near_sites(clusters, region_sites(public), miles, key)
    return near.join(public.select("rg_lat", "rg_lon", "region"), ["rg_lat", "rg_lon"]).select(key, "region")


def near_sites(clusters: DataFrame, sites: DataFrame, miles: float, key: str) -> DataFrame:
    """(cluster, position) pairs of the distinct sites near each centroid."""
    pos = clusters.select(key, F.col("cl_lat").alias("lat"), F.col("cl_lon").alias("lon"))
    return distance_join(pos, sites, miles).select(key, "rg_lat", "rg_lon")


def public_lists(clusters: DataFrame, regions: DataFrame, miles: float = NEAR_MILES) -> DataFrame:
    """The sorted public regions near each centroid; the marker word where there are none."""
    lists = joined_lists(public_pairs(clusters, regions, miles), ["region_list"], {"pub_list": F.col("region")}, [F.col("region")],
                         count_name="pub_nreg")
    return clusters.select("region_list").join(lists, "region_list", "left").select(
        "region_list", F.coalesce("pub_nreg", F.lit(0).cast("long")).alias("pub_nreg"),
        F.coalesce("pub_list", F.lit(EMPTY_LIST)).alias("pub_list"))


def capacity_totals(regions: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Capacity and vips per country, network class and private/public."""
    return regions.where(F.col("network").isin(list(classes))).groupBy("country", "network", "prp").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("peak_bitcap_mbps", "peak_flitcap_mfps", "numvips")])


def coverage_curve(clusters: DataFrame, load: Column, thresholds: Sequence[float]) -> DataFrame:
    """Clusters, and share of the load, at or above each threshold.

    Each cluster is placed once on the threshold scale; the curve is a running sum over that many
    rows. No product of thresholds and clusters is formed."""
    scale = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    placed = clusters.select(F.size(F.filter(scale, lambda t: t <= load)).alias("step"), load.alias("_load"))
    bins = placed.groupBy("step").agg(F.count(F.lit(1)).alias("_n"), F.sum("_load").alias("_l"))
    steps = clusters.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(len(thresholds)))).alias("step"))
    filled = steps.join(bins, "step", "left").na.fill(0, ["_n", "_l"])
    above = W.orderBy(F.col("step").desc()).rowsBetween(W.unboundedPreceding, 0)
    curve = filled.select("step", F.sum("_n").over(above).alias("clusters"), F.sum("_l").over(above).alias("_above"),
                          F.sum("_l").over(W.partitionBy(F.lit(1))).alias("_total")).where(F.col("step") > 0)
    share = F.try_divide(F.col("_above"), F.col("_total"))
    return curve.select(F.element_at(scale, F.col("step")).alias("threshold"), "clusters", F.round(share, 6).alias("load_share"))


def short_capacity(clusters: DataFrame, load: Column, min_load: float, public: Sequence[float], total: Sequence[float],
                   pub=("pub_bit_gbps", "pub_flit_gbps", "pub_vips"), pri=("cap_w", "cap_s", "nvips")) -> DataFrame:
    """Count and load of clusters with a high load, or short of public and also of total capacity."""
    p, q = [F.col(c) for c in pub], [F.col(c) for c in pri]
    short_pub = (p[0] < public[0]) | (p[1] < public[1]) | (p[2] < public[2])
    short_all = (p[0] + q[0] < total[0]) | (p[1] + q[1] < total[1]) | (p[2] + q[2] < total[2])
    return clusters.where((load >= min_load) | (short_pub & short_all)).agg(
        F.count(F.lit(1)).alias("clusters"), F.round(F.coalesce(F.sum(load), F.lit(0.0)), 6).alias("load"))


CAPS = {"bit_gbps": "b", "flit_gfps": "f", "numvips": "v"}
SITE = ("rg_lat", "rg_lon")


def region_criticality(clusters: DataFrame, members: DataFrame, allow: DataFrame, regions: DataFrame, key="region_list",
                       groups: dict[str, Sequence[int]] | None = None, others: str = "other", public_miles: float | None = None) -> DataFrame:
    """How much clusters lean on a region.

    Within (cluster, rule) a region's share of bit, flit and vip capacity; averaged over the rules
    that reach the cluster; summed over clusters, plain and load-weighted. A cluster without any
    usable region counts fully for region 0. `members` holds the (cluster, region) pairs: the regions it may use, and the
    public ones near it.

    With `groups` (label -> rules; all other rules are `others`) the figures are made for each group of rules on its own, with
    its label in `rule_group`: every cluster counts in every group, for region 0 where the group's rules do not reach it.

    With `public_miles` the public regions that near a centroid (`cl_lat`, `cl_lon`) are members too, and form no pairs with
    clusters: those at one position are near the same clusters, so capacities of a position go to its clusters, and sums over
    its clusters come back, by rule. `key` should then be short, as the pairs of clusters and positions carry it."""
    # A region listed twice counts once, with its largest capacity.
    info = regions.groupBy("region").agg(*[F.max(c).alias(c) for c in CAPS])
    label, labels = F.lit(others), [others]
    if groups is not None:
        labels = [*groups, others]
        for name, rules in groups.items():
            label = F.when(F.col("maprule").isin(list(rules)), F.lit(name)).otherwise(label)
    allowed = allow.select("maprule", "region").distinct().withColumn("rule_group", label)
    own, sited, near = members.select(key, "region"), None, None
    if public_miles is not None:
        allowed = stored(allowed, "allowed")
        sited = stored(_at_one_position(regions, info), "sited")
        near = stored(near_sites(clusters, sited.select(*SITE).distinct(), public_miles, key), "near")
        others_near = public_pairs(clusters, regions.where(F.col("private") == 0).join(sited, "region", "left_anti"), public_miles, key)
        own = own.unionByName(others_near).join(sited.select("region", *SITE), "region", "left").join(near, [key, *SITE], "left_anti")
    rows = own.select(key, "region").distinct().join(info, "region").join(allowed, "region")
    at = [key, "rule_group", "maprule"]
    parts = rows.select(*at, *CAPS)
    if sited is not None:
        rows = stored(rows, "own")
        of_sites = sited.join(allowed, "region").groupBy(*SITE, "rule_group", "maprule").agg(*[F.sum(c).alias(c) for c in CAPS])
        parts = rows.select(*at, *CAPS).unionByName(near.join(of_sites, list(SITE)).select(*at, *CAPS))
    totals = parts.groupBy(*at).agg(*[F.sum(c).alias(f"_{n}") for c, n in CAPS.items()])
    totals = totals if sited is None else stored(totals, "totals")
    rules = totals.groupBy(key, "rule_group").agg(F.count(F.lit(1)).alias("_rules"))
    part = lambda c, n: F.when(F.col(f"_{n}") > 0, F.try_divide(c.cast("double"), F.col(f"_{n}").cast("double"))).otherwise(F.lit(0.0))
    per_region = split_join(rows, totals, at).groupBy(key, "rule_group", "region").agg(
        *[F.sum(part(F.col(c), n)).alias(n) for c, n in CAPS.items()])
    mean = split_join(per_region, rules, [key, "rule_group"]).select(
        key, "rule_group", "region", *[(F.col(n) / F.col("_rules")).alias(n) for n in CAPS.values()])
    base = clusters.select(key, "geoname", "load", "nmpg")
    labelled = base.withColumn("rule_group", F.explode(F.array(*[F.lit(x) for x in labels])))
    unreached = labelled.join(rules, [key, "rule_group"], "left_anti").select(
        "rule_group", "geoname", "load", "nmpg", F.lit(0).cast("long").alias("region"), *[F.lit(1.0).alias(n) for n in CAPS.values()])
    full = base.join(mean, key).select(
        "rule_group", "geoname", "load", "nmpg", F.coalesce("region", F.lit(0).cast("long")).alias("region"),
        *[F.coalesce(F.col(n), F.lit(1.0)).alias(n) for n in CAPS.values()]).unionByName(unreached)
    # Distinct (region, geo) pairs first: a region's list is then bounded by the number of geos.
    geos = full.select("rule_group", "region", F.explode(F.split("geoname", ":")).alias("_geo")).distinct()
    sums = full.groupBy("rule_group", "region").agg(
        F.sum("load").alias("mpg_load"), F.sum("nmpg").alias("mpg_num"), *[F.sum(n).alias(f"{n}_ratio") for n in CAPS.values()],
        *[F.sum(F.col(n) * F.col("load")).alias(f"dw_{n}_ratio") for n in CAPS.values()], F.count(F.lit(1)).alias("clusters"))
    if sited is not None:
        # One over capacity and rules of a cluster, summed over the clusters near a position; a region's capacity is a factor.
        each = split_join(totals, rules, [key, "rule_group"]).join(base.select(key, "load"), key).select(
            key, "maprule", "load", *[(part(F.lit(1.0), n) / F.col("_rules")).alias(n) for n in CAPS.values()])
        by_site = near.join(each, key).groupBy(*SITE, "maprule").agg(
            *[F.sum(n).alias(f"_{n}") for n in CAPS.values()], *[F.sum(F.col(n) * F.col("load")).alias(f"_dw_{n}") for n in CAPS.values()])
        around = near.join(base, key)
        place = around.groupBy(*SITE).agg(F.sum("load").alias("mpg_load"), F.sum("nmpg").alias("mpg_num"), F.count(F.lit(1)).alias("clusters"))
        at_rule = sited.join(allowed, "region")
        ratios = at_rule.join(by_site, [*SITE, "maprule"]).groupBy("rule_group", "region", *SITE).agg(
            *[F.sum(F.col(c) * F.col(f"_{n}")).alias(f"{n}_ratio") for c, n in CAPS.items()],
            *[F.sum(F.col(c) * F.col(f"_dw_{n}")).alias(f"dw_{n}_ratio") for c, n in CAPS.items()])
        added = ["mpg_load", "mpg_num", *[f"{k}{n}_ratio" for k in ("", "dw_") for n in CAPS.values()], "clusters"]
        sums = sums.unionByName(ratios.join(place, list(SITE)).select("rule_group", F.col("region").cast("long").alias("region"), *added)).groupBy(
            "rule_group", "region").agg(*[F.sum(c).alias(c) for c in added])
        site_geos = around.select(*SITE, F.explode(F.split("geoname", ":")).alias("_geo")).distinct()
        of_region = at_rule.select("rule_group", "region", *SITE).distinct().join(site_geos, list(SITE))
        geos = geos.unionByName(of_region.select("rule_group", F.col("region").cast("long").alias("region"), "_geo")).distinct()
    lists = geos.groupBy("rule_group", "region").agg(F.array_join(F.array_sort(F.collect_list("_geo")), ":").alias("geo_list"))
    out = lists.join(sums, ["rule_group", "region"]).select(
        "rule_group", "region", "geo_list", F.round("mpg_load", 4).alias("mpg_load"), "mpg_num",
        *[F.round(f"{n}_ratio", 6).alias(f"{n}_ratio") for n in CAPS.values()],
        *[F.round(f"dw_{n}_ratio", 4).alias(f"dw_{n}_ratio") for n in CAPS.values()], "clusters")
    return out if groups is not None else out.drop("rule_group")


def _at_one_position(regions: DataFrame, info: DataFrame) -> DataFrame:
    """Public regions with their capacities, if these are known and the region lies at one known position."""
    spot = F.struct(*SITE)
    one = regions.where(F.col("private") == 0).groupBy("region").agg(F.min(spot).alias("_first"), F.max(spot).alias("_last")).where(
        (F.col("_first") == F.col("_last")) & F.col("_first.rg_lat").isNotNull() & F.col("_first.rg_lon").isNotNull())
    known = info.where(" and ".join(f"{c} is not null" for c in CAPS))
    return one.select("region", *[F.col(f"_first.{c}").alias(c) for c in SITE]).join(known, "region")
