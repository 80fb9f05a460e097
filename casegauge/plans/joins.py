"""Joins: samples, targets, dimensions, time, distance."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.functions.geo import haversine_miles
from casegauge.functions.metrics import pct_change, change_label, remap
from casegauge.operators import joins as J
from casegauge.operators.clusters import region_sites, serving_regions
from casegauge.operators.ratios import pivot_percentiles
from casegauge.plans.inputs import SERVICE_CLASSES
from casegauge.plans.inputs_sql import miles, rounded, with_inputs
from casegauge.plans.registry import query
from casegauge.plans.summaries import KEYS
from casegauge.sources.snapshots import enrich_latest
from casegauge.sources.tables import stored

LEVELS = ("99", "95", "90", "75")
WIDE = f"""{KEYS}, ts, {', '.join(f'sp{v}' for v in LEVELS)}, star, {', '.join(f'greatest(sp{v} - star, 0) sp{v}d' for v in LEVELS)},
    {', '.join(f'dp{v}' for v in LEVELS)}, dtar, {', '.join(f'greatest(dp{v} - dtar, 0) dp{v}d' for v in LEVELS)},
    icy_pct, icy_tar, greatest(icy_tar - icy_pct, 0) icyd, ict_pct, ict_tar, greatest(ict_tar - ict_pct, 0) ictd,
    total_bps, ping_bps, p2t_bps_pct"""


FEEDS = ("score", "distance", "in_country", "in_continent", "load")


@query("sample_join", with_inputs("case_sample", f"select {WIDE} from case_sample"))
def _(x):
    s = stored(x.case_sample(), "samples")
    return J.sample_join(*[x.metric_feed(k, s) for k in FEEDS])


@query("sample_join_left", with_inputs("case_sample", f"""select {WIDE}, case when maprule <> 3 then ioratio else -1 end ioratio,
    case when maprule <> 3 then ioratio_tar else -1 end ioratio_tar, case when maprule <> 3 then 100 else -1 end load_coverage,
    case when maprule <> 3 then greatest(ioratio - ioratio_tar, 0) else -1 end iod from case_sample"""))
def _(x):
    s = stored(x.case_sample(), "samples")
    return J.with_io_ratio(J.sample_join(*[x.metric_feed(k, s) for k in FEEDS]), x.metric_feed("io", s))


OR_JOIN = """a.maprule = b.mapruleid and (a.geoname = b.geo or a.geoname = 'GLOBAL' and b.geo = '')
    and (a.netname = b.aslist or a.netname = 'ANY' and b.aslist = '')"""
SCORE_TARGET = "select maprule, geoname, netname, max(targetvalue) targetvalue from objectives where attrname = 'SCORE' group by all"


def score_targets(x):
    return J.target_per_key(x.objectives(), CASE, where=F.col("attrname") == "SCORE")


@query("wildcard_target_join", with_inputs("objectives overview", f"""select b.casename, a.maprule, a.geoname, a.netname, b.metric, a.targetvalue
    from ({SCORE_TARGET}) a join overview b on {OR_JOIN}"""))
def _(x):
    return J.wildcard_join(score_targets(x), x.overview()).select("casename", *CASE, "metric", "targetvalue")


PIVOT = ", ".join(f"max(case when config_percentile = 0.{v} then metric_value else 0 end) p{v}" for v in LEVELS)
PERCENTS = {f"p{v}": f"0.{v}" for v in LEVELS}


def case_percentiles(x, metric):
    s = x.case_statistics().where(F.col("metric_type") == metric)
    p = pivot_percentiles(s, ["casename"], PERCENTS)
    return p.join(x.overview().select("casename", "mapruleid", "geo", "aslist"), "casename")


def metric_sql(metric):
    return with_inputs("objectives overview case_statistics", f"""
        select casename, maprule, geoname, netname, p99, p95, p90, p75, targetvalue from
        (select maprule, geoname, netname, max(targetvalue) targetvalue from objectives where attrname = '{metric.upper()}' group by all) a
        join (select casename, mapruleid, geo, aslist, {PIVOT} from case_statistics join overview using (casename)
              where metric_type = '{metric}' group by 1, 2, 3, 4) b on {OR_JOIN}""")


def metric_query(x, metric):
    t = J.target_per_key(x.objectives(), CASE, where=F.col("attrname") == metric.upper())
    return J.wildcard_join(t, case_percentiles(x, metric)).select("casename", *CASE, *PERCENTS, "targetvalue")


@query("score_feed", metric_sql("score"))
def _(x):
    return metric_query(x, "score")


@query("distance_feed", metric_sql("distance"))
def _(x):
    return metric_query(x, "distance")


@query("percentile_pivot", with_inputs("case_statistics", f"select casename, metric_type, {PIVOT} from case_statistics group by 1, 2"))
def _(x):
    return pivot_percentiles(x.case_statistics(), ["casename", "metric_type"], PERCENTS)


@query("target_per_case", with_inputs("objectives", """select maprule, geoname, netname, attrname, max(targetvalue) highest,
    min(targetvalue) lowest, max(case when targetpct = 80 then 90 else targetpct end) tpct from objectives group by 1, 2, 3, 4"""))
def _(x):
    keys = [*CASE, "attrname"]
    o = x.objectives().withColumn("tpct", remap("targetpct", 80, 90))
    return J.targets_per_key(o, keys, {"highest": ("max", "targetvalue"), "lowest": ("min", "targetvalue"), "tpct": ("max", "tpct")})


@query("target_pct_remap", with_inputs("objectives", """select maprule, geoname, netname, attrname, targetvalue,
    case when targetpct = 80 then 90 else targetpct end targetpct from objectives"""))
def _(x):
    return x.objectives().withColumn("targetpct", remap("targetpct", 80, 90))


INFO = ["name", "ecor", "continent", "country", "city", "latitude", "longitude", "asnum", "provider", "region_capacity",
        "ecor_capacity", "prp", "numghosts"]
INFO_SQL = ", ".join(rounded(c, 3) + " " + c if c in ("latitude", "longitude") else f'"{c}"' for c in INFO)


@query("enrich_latest_dim", with_inputs("region_sample newest", f"""select maprule, geoname, netname, region, score, ra_load, datestamp, "hour", ts,
    {INFO_SQL} from region_sample join newest using (region)"""))
def _(x):
    d = x.regions().withColumns({c: F.round(c, 3) for c in ("latitude", "longitude")}).select("region", "day", *INFO)
    s = x.region_sample().select(*CASE, "region", "score", "ra_load", "datestamp", "hour", "ts")
    return enrich_latest(s, d, "region", "day")


@query("attach_target", with_inputs("region_sample score_targets", """select s.maprule, s.geoname, s.netname, region, ts, ra_load, score_target
    from region_sample s join (select maprule, geoname, netname, max(targetvalue) score_target from score_targets group by all)
    using (maprule, geoname, netname)"""))
def _(x):
    return J.attach_target(x.region_sample().select(*CASE, "region", "ts", "ra_load"), x.score_targets())


@query("dim_left_outer", with_inputs("region_sample newest", f"""select maprule, geoname, netname, s.region, ts, ra_load, "name", country
    from region_sample s left join newest n on s.region = n.region"""))
def _(x):
    dim = x.regions().select("region", "day", "name", "country")
    return enrich_latest(x.region_sample().select(*CASE, "region", "ts", "ra_load"), dim, "region", "day", "left")


@query("asof_join", """select e.event_id, e.event_type, cast(floor(epoch(e.ts)) as bigint) ts, p.event_id prev_id, p.t prev_ts
    from (select *, cast(floor(epoch(ts)) as bigint) t from events) e
    asof left join (select max(event_id) event_id, event_type, cast(floor(epoch(ts)) as bigint) t from events where value > 100 group by 2, 3) p
    on e.event_type = p.event_type and e.t > p.t""")
def _(x):
    e = x.table("events").select("event_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts"), "value")
    right = e.where("value > 100").groupBy("event_type", "ts").agg(F.max("event_id").alias("prev_id")).withColumnRenamed("ts", "prev_ts")
    return J.asof_join(e.drop("value"), right, ["event_type"], "ts", "prev_ts", ["prev_id"])


@query("distance_join", with_inputs("newest client_groups", f"""select lat, lon, groups_ as "groups", latitude rg_lat, longitude rg_lon, site_regions,
    site_vips, {rounded(miles('lat', 'lon', 'latitude', 'longitude'), 3)} distance from places, sites
    where {miles('lat', 'lon', 'latitude', 'longitude')} < 500""", {
        "sites": """select latitude, longitude, count(*) site_regions, cast(sum(numvips) as bigint) site_vips from newest
                    where network in ('web', 'secure') group by all""",
        "places": "select lat, lon, count(*) groups_ from client_groups group by all"}))
def _(x):
    """Client sites and region sites less than 500 miles apart."""
    newest = x.regions().where(F.col("day") == "20240130")
    sites = region_sites(serving_regions(newest, SERVICE_CLASSES)).drop("site_bit", "site_flit")
    places = x.client_groups().groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("groups"))
    return J.distance_join(places, sites, 500.0).withColumn("distance", F.round("distance", 3))


@query("haversine_miles", with_inputs("clients", f"""select mpgid, {rounded(miles('ns_lat', 'ns_lon', '40.0::double', '-75.0::double'), 4)} miles
    from clients"""))
def _(x):
    return x.clients().select("mpgid", F.round(haversine_miles("ns_lat", "ns_lon", F.lit(40.0), F.lit(-75.0)), 4).alias("miles"))


@query("explode_join", with_inputs("near_groups newest", """select mpgid, g.country, load, region, n."name" from
    (select *, unnest(allowed) rid from near_groups) g join newest n on rid = region"""))
def _(x):
    dim = x.regions().where(F.col("day") == "20240130").select("region", "name")
    return J.explode_join(x.near_groups().select("mpgid", "country", "load", "allowed"), "allowed", dim, "region")


@query("lookup_join", """select e.event_id, e.user_id, coalesce(n.n_name, 'unknown') geo from events e left join nation n
    on e.user_id % 30 = n.n_nationkey""")
def _(x):
    e = x.table("events").withColumn("n_nationkey", (F.col("user_id") % 30).cast("int"))
    j = e.join(x.table("nation"), "n_nationkey", "left")
    return j.select("event_id", "user_id", F.coalesce("n_name", F.lit("unknown")).alias("geo"))


@query("share_join", with_inputs("region_sample", f"""select maprule, geoname, netname, region, region_load, case_load,
    case when case_load > 0 then {rounded('100.0::double*region_load/case_load', 4)} else 0 end share from
    (select maprule, geoname, netname, region, cast(sum(ra_load) as bigint) region_load from region_sample group by all) join
    (select maprule, geoname, netname, cast(sum(ra_load) as bigint) case_load from region_sample group by all) using (maprule, geoname, netname)"""))
def _(x):
    d = x.region_sample().groupBy(*CASE, "region").agg(F.sum("ra_load").alias("region_load"))
    return J.share_of_total(d, CASE, "region_load", "share", "case_load")


COVER = ("sum_demand", "in_asn_pct", "in_provider_pct", "in_country_pct", "has_pp_pct", "weighted_distance")


@query("week_over_week", with_inputs("coverage", f"""select country, asnum, {', '.join(rounded('a.' + c, 4) + ' ' + c + ', ' + rounded('b.' + c, 4) + ' ' + c + '_1m' for c in COVER)}
    from (select * from coverage where "day" = '200101') a join (select * from coverage where "day" = '200012') b using (country, asnum)"""))
def _(x):
    c = x.coverage()
    for v in COVER:
        c = c.withColumn(v, F.round(v, 4))
    return J.period_compare(c.where("day = '200101'"), c.where("day = '200012'"), ["country", "asnum"], COVER, "_1m")


MONTHLY = """select o_custkey % 25 grp, date_trunc('month', o_orderdate) as m, cast(sum(cast(trunc(o_totalprice) as bigint)) as bigint) load from orders group by 1, 2"""
CHANGE = "case when b.load > 0 then cast(" + rounded("(cast(a.load as double)-b.load)/cast(b.load as double)*100", 0) + " as int) else 0 end"


@query("pct_change", f"""with m as ({MONTHLY}) select a.grp, cast(a.m as date) as "month", a.load, b.load before_load, {CHANGE} change_pct,
    a.load || ' (' || {CHANGE} || '%)' label from m a join m b on a.grp = b.grp and a.m = b.m + interval 1 month""")
def _(x):
    m = x.table("orders").groupBy((F.col("o_custkey") % 25).alias("grp"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("long")).alias("load"))
    old = m.select("grp", F.add_months("month", 1).alias("month"), F.col("load").alias("before_load"))
    return m.join(old, ["grp", "month"]).withColumns({
        "change_pct": pct_change("load", "before_load"), "label": change_label("load", "before_load")})


@query("plan_vs_actual", with_inputs("plan case_sample", f"""select maprule, geoname, netname, p."month" + 1 as "month", load, score, score_target, sp95, n
    from plan p join (select maprule, geoname, netname, cast(strftime(to_timestamp(ts) at time zone 'UTC', '%Y%m') as int) mo, max(sp95) sp95, count(*) n
    from case_sample group by 1, 2, 3, 4) s using (maprule, geoname, netname) where p."month" + 1 = s.mo"""))
def _(x):
    """The plan of one period against the figures of the next."""
    month = F.date_format(F.timestamp_seconds("ts"), "yyyyMM").cast("int")
    actual = x.case_sample().groupBy(*CASE, month.alias("month")).agg(F.max("sp95").alias("sp95"), F.count(F.lit(1)).alias("n"))
    return x.plan().withColumn("month", F.col("month") + 1).join(actual, [*CASE, "month"])


@query("override_dimension", """select l_returnflag rule_id, l_linestatus service, coalesce(m.description, 'auto ' || l_returnflag) description, n from
    (select l_returnflag, min(l_linestatus) l_linestatus, count(*) n from lineitem group by 1) left join
    (select 'manual ' || o_orderstatus description, case o_orderstatus when 'F' then 'A' when 'O' then 'N' end k from orders
     where o_orderstatus in ('F', 'O') group by o_orderstatus) m on l_returnflag = k""")
def _(x):
    auto = x.table("lineitem").groupBy(F.col("l_returnflag").alias("rule_id")).agg(
        F.min("l_linestatus").alias("service"), F.count(F.lit(1)).alias("n"))
    auto = auto.withColumn("description", F.concat(F.lit("auto "), F.col("rule_id")))
    s = F.col("o_orderstatus")
    manual = x.table("orders").where(s.isin("F", "O")).select(s).distinct().select(
        F.when(s == "F", "A").otherwise("N").alias("rule_id"), F.concat(F.lit("manual "), s).alias("description"))
    return J.override_dimension(auto, manual, "rule_id", ["description"])


@query("membership_filter", """select l_orderkey, l_linenumber, l_suppkey, l_partkey from lineitem where l_returnflag in ('A', 'N')
    and l_suppkey in (select s_suppkey from supplier where s_acctbal > 0) and l_partkey not in (select p_partkey from part where p_size > 40)""")
def _(x):
    flagged = J.members_of(x.table("lineitem"), "l_returnflag", ["A", "N"])
    li = flagged.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    known = J.members_of(li, "l_suppkey", x.table("supplier").where("s_acctbal > 0"), "s_suppkey")
    return J.members_of(known, "l_partkey", x.table("part").where("p_size > 40"), "p_partkey", negate=True).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


@query("semi_anti", """select 'semi' kind, c_custkey from customer where c_custkey in (select o_custkey from orders) union all
    select 'anti', c_custkey from customer where c_custkey not in (select o_custkey from orders)""")
def _(x):
    c, o = x.table("customer"), x.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    part = lambda kind, how: c.join(o, "c_custkey", how).select(F.lit(kind).alias("kind"), "c_custkey")
    return part("semi", "left_semi").unionByName(part("anti", "left_anti"))
