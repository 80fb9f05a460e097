"""Assignment statistics: which regions served a client group, for what share of the time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge.functions.geo import haversine_miles
from casegauge.functions.metrics import entropy, is_continent_fallback, is_even, is_local
from casegauge.operators.joins import members_of
from casegauge.operators.lists import list_item, list_texts
from casegauge.operators.spread import with_totals
from casegauge.sources.snapshots import latest_partition
from casegauge.sources.tables import stored

MIN_DEMAND = 1.0


WEIGHTED = ("min_s", "max_s", "min_r", "max_r", "ping", "local", "cont_fb")


CELLS = 1 << 14
CALM = 1 << 20  # rows of the groups of a cell that one task may hold


def _crowded(log: DataFrame, cell: Column) -> DataFrame:
    """The cells, out of CELLS by a hash of their groups, with more than CALM rows."""
    return F.broadcast(log.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CALM).select("_cell"))


def _sums_in_place(rows: DataFrame, group: Sequence[str], keys: Sequence[str], total: str, over: Sequence[str], made: Callable) -> DataFrame:
    """`made(rows)` of rows with `_total`, the sum of `total` over the rows of their group that are equal in `over`, and then its
    sums by all keys, of which the first are the group. Rows are moved once, by group; all else happens where they lie."""
    here = W.partitionBy("_at")
    among = here.orderBy(*over).rangeBetween(W.currentRow, W.currentRow)
    rows = made(rows.withColumn("_at", F.struct(*group)).repartition("_at").withColumn("_total", F.sum(total).over(among)), "_at")
    ordered = here.orderBy(*keys[len(group):])
    equal = ordered.rangeBetween(W.currentRow, W.currentRow)
    sums = {c: F.sum(c).over(equal) for c in rows.columns if c not in (*keys, "_at")}
    first = rows.withColumns(sums | {"_first": F.rank().over(ordered) == F.row_number().over(ordered)}).where("_first")
    return first.select(*keys, *sums)


def duration_share(log: DataFrame, regions: DataFrame, uuid="mpd_uuid", snapshot="day", weighted: Sequence[str] = WEIGHTED) -> DataFrame:
    """Per (client group, rule, region, link): duration and duration-weighted sums (those named by `weighted`).

    The share is the count over all counts of the same group, rule, run and time, rounded to 5
    places, times the duration of the time step. Rows are moved once, by group, rule and run: totals and sums come from windows
    there. Crowded groups are left out of that: their totals are grouped and joined back, so that they are summed on the map side and
    their rows stay spread over tasks. The log (often a join) is stored, as both forms read
    it, without the columns that no sum needs; the newest snapshot is stored, so that its size on disk decides how it is joined."""
    group = [uuid, "mpgid", "mrid"]
    made = {"ping": (is_even("min_s"), ["min_s"]), "local": (is_local("min_s"), ["min_s"]),
            "cont_fb": (is_continent_fallback("max_s", "max_r"), ["max_s", "max_r"])}
    needed = {c for w in weighted for c in (made[w][1] if w in made else [w])}
    keys = [*group, "mpg_type", "region", "link"]
    log = stored(log.select([c for c in log.columns if c in {*keys, "ts", "cnt", "dftime", *needed}]), "log")
    cell = F.pmod(F.xxhash64(*group, F.lit(11)), F.lit(CELLS))
    crowded = _crowded(log, cell)
    of_cell = lambda how: log.withColumn("_cell", cell).join(crowded, "_cell", how).drop("_cell")
    share = F.round(F.try_divide(F.col("cnt").cast("double"), F.col("_total").cast("double")), 5)
    lasted = share * F.col("dftime")

    def times(rows: DataFrame, *more: str) -> DataFrame:
        rows = rows.select(*more, *keys, lasted.alias("mpd_dftime"), *[made[w][0].alias(w) if w in made else F.col(w) for w in weighted])
        return rows.select(*more, *keys, *[(F.col(c) * F.col("mpd_dftime")).alias(c) for c in weighted], "mpd_dftime")

    calm = _sums_in_place(of_cell("left_anti"), group, keys, "cnt", ["ts"], times)
    spread = times(with_totals(of_cell("left_semi"), [*group, "ts"], _total=F.sum("cnt"))).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in (*weighted, "mpd_dftime")])
    sums = calm.unionByName(spread).select(*keys, *[F.round(c, 4).alias(c) for c in (*weighted, "mpd_dftime")])
    dim = stored(latest_partition(regions, snapshot).select(
        "region", "ecor", "continent", "country", "latitude", "longitude", (F.col("prp") == "private").cast("int").alias("_prp")), "newest")
    return sums.join(dim, "region").withColumn("prp", F.round(F.col("_prp") * F.col("mpd_dftime"), 4)).drop("_prp")


def selected_clients(clients: DataFrame, min_demand: float | None = MIN_DEMAND) -> DataFrame:
    """Clients at a known place with more than a least demand."""
    placed = clients.where(F.col("ns_lat").isNotNull() & F.col("ns_lon").isNotNull())
    return placed if min_demand is None else placed.where(F.col("ns_demand") > min_demand)


def _shares(summary: DataFrame, uuid: str) -> DataFrame:
    """Assignments to regions at a known place with their share of the longest duration of the run. There is one maximum
    per run: it goes to the rows, which are not shuffled for it."""
    rows = summary.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    longest = rows.groupBy(uuid).agg(F.max("mpd_dftime").alias("_max"))
    return rows.join(F.broadcast(longest), uuid).withColumn("_share", F.round(F.try_divide(F.col("mpd_dftime"), F.col("_max")), 3))


def assignment_stats(summary: DataFrame, clients: DataFrame, uuid="mpd_uuid", normalise_entropy: bool = False,
                     min_demand: float | None = MIN_DEMAND) -> DataFrame:
    """Per (client, rule): duration-weighted means, ratios in percent, mean distance, number of
    regions, entropy, total duration, and lists of regions by falling share.

    Shares are relative to the longest duration of the run, so the entropy is that of unnormalised
    shares unless `normalise_entropy`. Scalars and lists come from one aggregation: a client's lists are bounded by the
    region dimension and its links. Assignments are shuffled once, by (run, group, rule, type), grouped where they lie, and
    clients come to the groups. A client that is listed n times counts each of its assignments n times."""
    rows = _shares(summary, uuid)
    group = [uuid, "mpgid", "mrid", "mpg_type"]
    attributes = ["ns_demand", "ns_asnum", "ns_country", "ns_continent", "ns_lat", "ns_lon", "mpg_load"]
    d = F.col("mpd_dftime")
    if normalise_entropy:
        rows = with_totals(rows, group[:3], _all=F.sum("mpd_dftime")).withColumn("_p", F.try_divide(d, F.col("_all"))).drop("_all")
    p = F.col("_p" if normalise_entropy else "_share")

    # Durations and weighted sums have 4 places: added as decimals, they do not depend on row order.
    exact = lambda c: F.sum(c.cast("decimal(18,4)")).cast("double")

    def mean(c, total, digits, scale=1.0) -> Column:
        value = F.round(F.lit(scale) * F.try_divide(c, total), digits)
        return F.when(total > 0, value).otherwise(F.lit(-1.0))

    each = lambda c: F.round(F.try_divide(F.col(c), d), 2)
    lists = {
        "regions": F.col("region"),
        "region_links": F.concat_ws("_", F.col("region").cast("string"), F.col("link").cast("string")),
        "dftime_ratio": F.round(F.col("_share") * 100, 2), "ecors": F.col("ecor"),
        "list_min_s": each("min_s"), "list_max_s": each("max_s"), "list_min_r": each("min_r"), "list_max_r": each("max_r"),
        "region_lats": F.round("latitude", 3), "region_lons": F.round("longitude", 3)}
    order = [-F.col("_share"), F.col("region"), F.col("link")]
    place = ["mpd_dftime", "continent", "country", "latitude", "longitude"]
    used = [*WEIGHTED, *place, "prp", "region", "link", "ecor", "_share", *(["_p"] if normalise_entropy else [])]
    # One key that is never null: partitions of the rows serve the grouping and the join with the clients.
    at = F.struct(*group).alias("_at")
    grouped = rows.select(at, *used).repartition("_at").groupBy("_at").agg(
        exact(d).alias("_total"), *[mean(exact(F.col(c)), exact(d), 3).alias(f"avg_{c}") for c in ("min_s", "max_s", "min_r", "max_r")],
        *[mean(exact(F.col(c)), exact(d), 2, 100.0).alias(n) for c, n in
          (("ping", "ping_ratio"), ("local", "local_ratio"), ("cont_fb", "cont_fb_ratio"), ("prp", "private_ratio"))],
        F.count(F.lit(1)).alias("_n"), entropy(p).alias("_entropy"), F.sum(F.when(p > 0, p)).alias("_sum_p"),
        F.collect_list(list_item(lists, order)).alias("_items"), F.collect_list(F.struct(*place)).alias("_places"))

    listed = selected_clients(clients, min_demand).groupBy("mpgid", "nsip", *attributes).agg(F.count(F.lit(1)).alias("_copies"))
    if normalise_entropy:
        listed = with_totals(listed, ["mpgid", "nsip"], _named=F.sum("_copies"))
    joined = grouped.join(rows.select(*group).distinct().join(listed, "mpgid").select(at, "nsip", *attributes, *listed.columns[len(attributes) + 2:]), "_at")

    total, copies = F.col("_total"), F.col("_copies")
    places = lambda zero, value: F.aggregate("_places", zero, lambda s, p: (s + F.coalesce(value(p), F.lit(0).cast("double")).cast(
        "decimal(18,4)")).cast("decimal(28,4)")).cast("double")
    same = lambda c: places(F.lit(0).cast("decimal(28,4)"), lambda p: F.when(p[c] == F.col(f"ns_{c}"), p["mpd_dftime"]).otherwise(F.lit(0.0)))
    away = F.aggregate("_places", F.lit(0.0), lambda s, p: s + F.coalesce(
        haversine_miles(F.col("ns_lat"), F.col("ns_lon"), p["latitude"], p["longitude"]) * p["mpd_dftime"], F.lit(0.0)))
    bits = F.col("_entropy") * copies
    if normalise_entropy:
        bits = copies / F.col("_named") * (F.col("_entropy") + F.coalesce(F.log(F.col("_named")) * F.col("_sum_p"), F.lit(0.0)))
    items = F.array_sort(F.when(copies == 1, F.col("_items")).otherwise(F.flatten(F.array_repeat("_items", copies.cast("int")))))
    return joined.withColumn("_items", items).select(
        *[F.col(f"_at.{c}").alias(c) if c in group else F.col(c) for c in (uuid, "nsip", "mrid", "mpgid", "mpg_type", *attributes)],
        *[f"avg_{c}" for c in ("min_s", "max_s", "min_r", "max_r")], "ping_ratio", "local_ratio", "cont_fb_ratio",
        mean(same("continent"), total, 2, 100.0).alias("in_cont_ratio"), mean(same("country"), total, 2, 100.0).alias("in_country_ratio"),
        "private_ratio", mean(away, total, 2).alias("avg_distance"), (F.col("_n") * copies).alias("num_region_mapped"),
        F.round(bits, 6).alias("mapping_entropy"), F.round(total * copies, 3).alias("sum_dftime"),
        F.size("_items").cast("long").alias("listed"), *list_texts(F.col("_items"), list(lists)))


def client_entropy(summary: DataFrame, clients: DataFrame, uuid="mpd_uuid", normalise: bool = False,
                   min_demand: float | None = MIN_DEMAND) -> DataFrame:
    """Entropy of the region shares alone."""
    rows = _shares(summary, uuid).select(uuid, "mpgid", "mrid", "mpd_dftime", "_share")
    rows = rows.join(selected_clients(clients, min_demand).select("mpgid", "nsip"), "mpgid")
    keys = [uuid, "nsip", "mrid"]
    if not normalise:
        return rows.groupBy(*keys).agg(F.round(entropy("_share"), 6).alias("mapping_entropy"))
    p = F.try_divide(F.col("mpd_dftime"), F.col("_all"))
    return with_totals(rows, keys, _all=F.sum("mpd_dftime")).groupBy(*keys).agg(F.round(entropy(p), 6).alias("mapping_entropy"))


def poorly_mapped(stats: DataFrame, networks: DataFrame, rule=None, geo=None, limits: dict | None = None) -> DataFrame:
    """Clients whose assignment breaks any of the limits, with the networks of their AS number.

    The ratio columns are percentages; the default limits are compared with them as they are."""
    lim = {"entropy": 0.9, "ping": 0.1, "fallback": 0.2, "country": 0.2, "continent": 0.05, "miles": 2000.0,
           **(limits or {})}
    rows = stats
    if rule is not None:
        rows = members_of(rows, "mrid", [rule])
    if geo is not None:
        rows = rows.where(F.col("ns_country") == geo)
    bad = ((F.col("mapping_entropy") > lim["entropy"]) | (F.col("ping_ratio") < lim["ping"])
           | (F.col("cont_fb_ratio") > lim["fallback"]) | (F.col("in_country_ratio") < lim["country"])
           | (F.col("in_cont_ratio") < lim["continent"]) | (F.col("avg_distance") > lim["miles"]))
    return rows.where(bad).join(networks.withColumnRenamed("asnum", "ns_asnum"), "ns_asnum")


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top k; each task keeps k rows."""
    return df.orderBy(*order).limit(k)
