"""Traffic ratios, costs, rollups and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.operators import ratios as T
from casegauge.operators.joins import target_per_key
from casegauge.operators.summary import io_rollup_summary
from casegauge.plans.inputs_sql import percentile, rounded, with_inputs
from casegauge.plans.joins import OR_JOIN
from casegauge.plans.registry import query

COUNTERS = ("bytes", "bytes_in", "hits", "connections", "flytes", "cpu", "disk")


def machine_traffic(x, **kw):
    return T.machine_traffic(x.traffic(), x.machines(), COUNTERS, **kw)


@query("machine_traffic_join", with_inputs("machine_traffic", "select * from machine_traffic"))
def _(x):
    return machine_traffic(x)


@query("traffic_by_rule_region", with_inputs("traffic machines", f"""select maprule_id, region, georegion,
    {', '.join(f'cast(sum({c}) as bigint) {c}' for c in COUNTERS)} from traffic join machines using (ghostip, ts)
    where maprule_id <> -1 group by 1, 2, 3"""))
def _(x):
    return machine_traffic(x, by=["georegion"], where=F.col("maprule_id") != -1)


INPUTS = "objectives view_by_region machine_traffic"


def case_traffic(attr, agg):
    return {"a": f"select maprule, geoname, netname, {agg}(targetvalue) targetvalue from objectives where attrname = '{attr}' group by all",
            "b": """select max(casename) casename, mapruleid, geo, aslist, regionid, max(percentage) percentage
                    from view_by_region group by mapruleid, geo, aslist, regionid""",
            "ab": f"select a.*, b.* from a join b on {OR_JOIN}"}


def targets(x, attr, agg="min"):
    return target_per_key(x.objectives(), CASE, agg=agg, where=F.col("attrname") == attr)


@query("in_out_ratio_pooled", with_inputs(INPUTS, f"""select casename, case when sum(bytes) > 0 then {rounded('100.0::double*sum(bytes_in)/sum(bytes)', 4)} else 0 end in_out_ratio,
    max(targetvalue) targetvalue, cast(sum(cast(trunc(100.0::double*percentage) as int)) as bigint) coverage_pct
    from ab join machine_traffic c on ab.maprule = c.maprule_id and ab.regionid = c.region group by casename""", case_traffic("IN-OUT-RATIO", "min")))
def _(x):
    return T.pooled_io_ratio(targets(x, "IN-OUT-RATIO"), x.view_by_region(), machine_traffic(x))


def weighted_sql(having=""):
    return with_inputs(INPUTS, f"""select casename, {rounded('sum(case when bytes > 0 then 100.0::double*bytes_in/bytes*percentage/nullif(coverage, 0) else 0 end)', 4)} in_out_ratio,
        max(targetvalue) targetvalue, cast(trunc(max(coverage)) as int) coverage_pct
        from ab join (select * from machine_traffic {having}) c on ab.maprule = c.maprule_id and ab.regionid = c.region
        join (select casename, sum(percentage) coverage from b group by casename) d using (casename) group by casename""",
        case_traffic("IN-OUT-RATIO", "min"))


@query("in_out_ratio_weighted", weighted_sql())
def _(x):
    return T.weighted_io_ratio(targets(x, "IN-OUT-RATIO"), x.view_by_region(), machine_traffic(x))


@query("in_out_ratio_min_bytes", weighted_sql("where bytes > 500000"))
def _(x):
    return T.weighted_io_ratio(targets(x, "IN-OUT-RATIO"), x.view_by_region(), machine_traffic(x), min_bytes=500000)


@query("coverage_pct", with_inputs("view_by_region", f"select casename, {rounded('sum(percentage)', 6)} coverage_pct from b group by casename",
                                   {"b": case_traffic("", "min")["b"]}))
def _(x):
    return T.coverage_pct(x.view_by_region()).withColumn("coverage_pct", F.round("coverage_pct", 6))


RATED = """select region, maprule_id, bytes, nominalrate from machine_traffic join locations using (region) join bandwidth_cost using (location)"""


@query("cost_join", with_inputs("machine_traffic locations bandwidth_cost", RATED))
def _(x):
    return T.region_rates(machine_traffic(x), x.locations(), x.bandwidth_cost())


@query("weighted_rate", with_inputs(INPUTS + " locations bandwidth_cost", """select casename, min(targetvalue) targetvalue,
    cast(trunc(sum(bytes*nominalrate)) as bigint) total_cost,
    case when sum(bytes) > 0 then cast(trunc(1000.0::double*sum(bytes*nominalrate)/cast(sum(bytes) as double)) as int) else 0 end wavg_rate_x1000,
    cast(trunc(1000.0::double*avg(nominalrate)) as int) avg_rate_x1000, cast(trunc(100.0::double*sum(percentage)) as int) coverage_pct
    from ab join rated c on ab.maprule = c.maprule_id and ab.regionid = c.region group by casename""",
    {**case_traffic("COGS", "min"), "rated": RATED}))
def _(x):
    rated = T.region_rates(machine_traffic(x), x.locations(), x.bandwidth_cost())
    return T.weighted_cost(targets(x, "COGS"), x.view_by_region(), rated)


@query("load_share_pct", with_inputs("objectives overview", f"""select casename, maprule, geoname, netname, total_bps, ping_bps,
    case when total_bps > 0 then cast(trunc(10000.0::double*ping_bps/total_bps) as int) else 0 end p2t_bps_pct
    from (select distinct maprule, geoname, netname from objectives) a join
    (select casename, mapruleid, geo, aslist, cast(trunc(cast(ra_load_total as double)/1024/1024) as int) total_bps,
            cast(trunc(cast(ra_load_total as double)/1024/1024*ping_perc/100) as int) ping_bps from overview) b on {OR_JOIN}"""))
def _(x):
    return T.load_share(x.overview(), x.objectives())


ROLLUP = f"""select maprule, geoname, netname, datestamp, "hour", cast(sum(nsd_demand) as bigint) nsd_demand, cast(sum(eu_demand) as bigint) eu_demand,
    cast(sum(ra_load) as bigint) ra_load, case when sum(bytes) > 0 then {rounded('100.0::double*cast(sum(bytes_in) as bigint)/cast(sum(bytes) as bigint)', 3)} else 0 end in_out_ratio,
    cast(sum(hits) as bigint) hits, cast(sum(connections) as bigint) connections,
    case when sum(flytes) > 0 then {rounded('100.0::double*cast(sum(bytes) as bigint)/cast(sum(flytes) as bigint)', 3)} else 0 end b2f_ratio,
    {rounded('cast(sum(cpu) as double)/1000000', 3)} m_cpu, cast(sum(disk) as bigint) disk
    from region_sample a join machine_traffic c on a.maprule = c.maprule_id and a.region = c.region group by 1, 2, 3, 4, 5"""


def rollup(x):
    return T.io_case_rollup(x.region_sample(), machine_traffic(x), [*CASE, "datestamp", "hour"])


@query("io_case_rollup", with_inputs("region_sample machine_traffic", ROLLUP))
def _(x):
    return rollup(x)


def io_summary_sql():
    plain = ("nsd_demand", "eu_demand", "ra_load", "hits", "connections", "disk")
    cols = [f"cast(trunc({percentile(c, 0.9584)}) as bigint) {c}_t95" for c in plain]
    cols += [f"{rounded(percentile(f'cast(trunc({c}*1000) as bigint)', 0.9584) + '/1000', 3)} {c}_t95" for c in ("in_out_ratio", "b2f_ratio", "m_cpu")]
    cols += [f"cast(trunc(avg({c})) as bigint) {c}_t50" for c in (*plain, "m_cpu")]
    cols += [f"{rounded(f'avg({c})', 3)} {c}_t50" for c in ("in_out_ratio", "b2f_ratio")]
    return with_inputs("region_sample machine_traffic", f"select maprule, geoname, netname, {', '.join(cols)}, count(*) case_count from r group by 1, 2, 3", {"r": ROLLUP})


@query("io_summary", io_summary_sql())
def _(x):
    return io_rollup_summary(rollup(x))


def coverage_sql(by):
    pct = lambda n, d, s: f"case when {d} > 0 then {rounded(f'{s}*{n}/{d}', 2)} end"
    w = "sum_demand*has_pp_pct"
    return with_inputs("coverage", f"""select {by}, count(*) asns, {rounded('sum(sum_demand)', 2)} tot_demands,
        {pct(f'sum({w}*in_country_pct)', f'sum({w})', '100.0::double')} in_country_pct, {pct(f'sum({w}*in_asn_pct)', f'sum({w})', '100.0::double')} in_asn_pct,
        {pct(f'sum({w})', 'sum(sum_demand)', '100.0::double')} has_pp_pct, {pct(f'sum({w}*weighted_distance)', f'sum({w})', '1.0::double')} avg_distance
        from coverage where "day" = (select max("day") from coverage) group by {by}""")


@query("coverage_by_geo", coverage_sql("country"))
def _(x):
    return T.coverage_by(x.coverage(newest=True), ["country"], None)


@query("coverage_by_day", coverage_sql('"day"'))
def _(x):
    return T.coverage_by(x.coverage(newest=True), ["day"], None)


@query("coverage_detail", with_inputs("coverage", f"""select "day", country, asnum, {', '.join(f'{rounded(c, 4)} {c}' for c in
    ('sum_demand', 'in_country_pct', 'in_asn_pct', 'weighted_distance', 'has_pp_pct', 'in_provider_pct'))}
    from coverage where "day" = (select max("day") from coverage)"""))
def _(x):
    c = x.coverage(newest=True)
    return c.select("day", "country", "asnum", *[F.round(v, 4).alias(v) for v in (
        "sum_demand", "in_country_pct", "in_asn_pct", "weighted_distance", "has_pp_pct", "in_provider_pct")]).orderBy(F.col("sum_demand").desc())
