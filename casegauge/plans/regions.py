"""Load by serving region and top regions per case."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.operators import region as R
from casegauge.operators.assignment import top_k
from casegauge.operators.lists import explode_list, items_with_totals, joined_lists
from casegauge.operators.topn import top_n_shares
from casegauge.plans.inputs_sql import rounded, with_inputs
from casegauge.plans.joins import INFO_SQL
from casegauge.plans.registry import query

KEYS = "maprule, geoname, netname"


def summary_sql(parts: str) -> str:
    """The (case, region) summary with `parts` (hour or day) added to the case."""
    keys = f"{KEYS}, {parts}"
    avg = lambda c, n=4: rounded(f"avg({c})", n)
    total = lambda c: f"cast(sum({c}) as bigint)"
    pct = lambda a, b: f"case when {b} > 0 then {rounded(f'100.0::double*{a}/{b}', 4)} else 0 end"
    return f"""select {keys}, d.region, avg_region_score, max_region_score, avg_region_nsd_demand, region_nsd_demand, avg_region_eu_demand,
        region_eu_demand, region_ra_load, avg_case_percent_pre_norm_load, avg_case_percent_load, avg_recorded_load_percentage,
        {pct('region_ra_load', 'case_ra_load')} case_percent_load, {pct('region_nsd_demand', 'case_nsd_demand')} case_percent_nsd_demand,
        {pct('region_eu_demand', 'case_eu_demand')} case_percent_eu_demand, case_ra_load, case_nsd_demand, case_eu_demand,
        case_sum_max_region_percent_load, case_uniq_region, {INFO_SQL}, score_target
        from (select {keys}, region, {avg('score', 2)} avg_region_score, {rounded('max(score)', 2)} max_region_score,
                {avg('nsd_demand')} avg_region_nsd_demand, {total('nsd_demand')} region_nsd_demand, {avg('eu_demand')} avg_region_eu_demand,
                {total('eu_demand')} region_eu_demand, {total('ra_load')} region_ra_load,
                {avg('case_percent_pre_norm_load')} avg_case_percent_pre_norm_load, {avg('case_percent_load')} avg_case_percent_load,
                {avg('recorded_load_percentage')} avg_recorded_load_percentage
              from region_sample group by {keys}, region) d
        join (select {keys}, {total('a')} case_ra_load, {total('b')} case_nsd_demand, {total('c')} case_eu_demand,
                {rounded('sum(m)', 4)} case_sum_max_region_percent_load, count(distinct region) case_uniq_region
              from (select {keys}, region, sum(ra_load) a, sum(nsd_demand) b, sum(eu_demand) c, max(greatest(case_percent_load, 0)) m
                    from region_sample group by {keys}, region) group by {keys}) t using ({keys})
        join newest n on n.region = d.region
        join (select {KEYS}, max(targetvalue) score_target from score_targets group by {KEYS}) s using ({KEYS})
        where {pct('region_ra_load', 'case_ra_load')} >= 0.00005"""


HOUR = ["datestamp", "hour"]
HOURLY = 'datestamp, "hour"'
TABLES = "region_sample newest score_targets"


def hourly(x):
    return R.region_summary(x.region_sample(), x.regions(), x.score_targets(), [*CASE, *HOUR])


@query("region_hour_summary", with_inputs(TABLES, summary_sql(HOURLY)))
def _(x):
    return hourly(x)


@query("region_day_summary", with_inputs(TABLES, summary_sql("datestamp")))
def _(x):
    return R.region_summary(x.region_sample(), x.regions(), x.score_targets(), [*CASE, "datestamp"])


SHARES = f"""select {KEYS}, region, region_load, case_load, case when case_load > 0 then {rounded('100.0::double*region_load/case_load', 2)} else 0 end share
    from (select {KEYS}, region, cast(sum(ra_load) as bigint) region_load from region_sample group by all) join
         (select {KEYS}, cast(sum(ra_load) as bigint) case_load from region_sample group by all) using ({KEYS})"""
LABEL = "'MR_' || maprule || ':GEO_' || geoname || ':' || netname"


@query("region_view", with_inputs("region_sample newest", f"""select v.*, {INFO_SQL} from
    (select region, count(*) cases, string_agg(info, ',' order by info) distribution from
      (select region, {LABEL} || '(' || share || ':' || region_load || ':' || case_load || ')' info from shares) group by region) v
    join newest using (region)""", {"shares": SHARES}))
def _(x):
    return R.region_view(x.region_sample(), x.regions())


def region_figures(tag, value, total):
    return f"':{tag}_' || {value} || '_' || case when {total} > 0 then {rounded(f'100.0::double*{value}/{total}', 2)} else 0.0::double end || '_'"


@query("case_view", with_inputs(TABLES, f"""select {KEYS}, {HOURLY}, count(*) regions, string_agg(info, ',' order by info) distribution,
    score_target, case_ra_load, case_nsd_demand, case_eu_demand, case_uniq_region from
    (select *, region || '(' || avg_region_score || {region_figures('NSD', 'region_nsd_demand', 'case_nsd_demand')} ||
      {region_figures('EU', 'region_eu_demand', 'case_eu_demand')} || {region_figures('LOAD', 'region_ra_load', 'case_ra_load')} || ':' || "name" || ':' ||
      ecor || ':' || continent || ':' || country || ':' || city || ':' || latitude || ':' || longitude || ':' || asnum || ':' || provider || ':' ||
      region_capacity || ':' || ecor_capacity || ':' || prp || ':' || numghosts || ')' info from hourly)
    group by all""", {"hourly": summary_sql(HOURLY)}))
def _(x):
    return R.case_view(hourly(x), [*CASE, *HOUR])


@query("provider_rollup", with_inputs("newest", """select ecor, min(continent) continent, min(country) country, min(asnum) asnum, min(prp) prp,
    string_agg(distinct provider, ',' order by provider) provider_set,
    string_agg(distinct cast(ecor_capacity as varchar), ',' order by cast(ecor_capacity as varchar)) ecor_capacity_set,
    cast(sum(numghosts) as bigint) numghosts, count(*) regions from newest group by ecor"""))
def _(x):
    return R.provider_rollup(x.regions(), "ecor", ["continent", "country", "asnum", "prp"], ["provider", "ecor_capacity"])


@query("provider_distribution", with_inputs("region_sample newest", f"""select ecor, count(*) cases,
    string_agg(info, ',' order by info) distribution from (
      select ecor, {LABEL} || '(' || {rounded('100.0::double*load/case_load', 2)} || '%:' || load || ':' || case_load || ')' info from
      (select ecor, {KEYS}, case_load, cast(sum(region_load) as bigint) load from shares join newest using (region) group by all)
      where load > 0) group by ecor""", {"shares": SHARES}))
def _(x):
    return R.provider_distribution(x.region_sample(), x.regions(), "ecor")


@query("region_day_load", with_inputs("region_sample", """select datestamp, region, count(distinct maprule || geoname || netname) cases, count(*) samples,
    cast(sum(ra_load) as bigint) load from region_sample group by all"""))
def _(x):
    """Cases per region and day: counted from the (case, region) aggregate, not by collecting sets."""
    pairs = x.region_sample().groupBy("datestamp", "region", *CASE).agg(F.count(F.lit(1)).alias("n"), F.sum("ra_load").alias("l"))
    return pairs.groupBy("datestamp", "region").agg(F.count(F.lit(1)).alias("cases"), F.sum("n").alias("samples"), F.sum("l").alias("load"))


TOP = """select n_name geoname, regionid, load, sh from (select n_name, l_suppkey regionid, cast(sum(cast(trunc(l_extendedprice) as bigint)) as bigint) load,
    cast(sum(l_quantity) as double) sh from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey group by all)"""


@query("top_n_running_share", f"""select geoname, regionid, load, sh, cast(rank_ as int) as "rank", {rounded('cum', 4)} cum_share,
    {rounded('max(cum) over (partition by geoname)', 4)} max_cum_share,
    case when sum(load) over (partition by geoname) > 0 then {rounded('100.0::double*load/cast(sum(load) over (partition by geoname) as double)', 4)} else -1 end load_ratio
    from (select *, sum(sh) over (partition by geoname order by rank_ rows unbounded preceding) cum from
      (select *, row_number() over (partition by geoname order by load desc, regionid) rank_ from ({TOP})) where rank_ <= 30)""")
def _(x):
    li, o = x.table("lineitem"), x.table("orders")
    loads = (li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(x.customers(), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy(F.col("n_name").alias("geoname"), F.col("l_suppkey").alias("regionid"))
             .agg(F.sum(F.col("l_extendedprice").cast("long")).alias("load"), F.sum("l_quantity").alias("sh")))
    return top_n_shares(loads, ["geoname"], "load", "sh", "regionid")


@query("top_k", """select l_orderkey, l_linenumber, l_suppkey, l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_linenumber limit 100""")
def _(x):
    li = x.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return top_k(li, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], 100)


@query("member_list", with_inputs("members", """select "name", asnum, count(*) over (partition by "name") counts from members"""))
def _(x):
    return items_with_totals(x.members(), ["name"], "counts")


@query("explode_members", with_inputs("allow_list", "select maprule, region from allow_list"))
def _(x):
    """The lists of a rule's regions taken apart again."""
    lists = joined_lists(x.allow_list(), ["maprule"], {"regions": F.col("region")}, [F.col("region")])
    return explode_list(lists, ["maprule"], "regions", "region").withColumn("region", F.col("region").cast("long"))


@query("regions_per_rule", with_inputs("allow_list", """select maprule, count(*) n_regions,
    string_agg(region, ':' order by region) regions from allow_list group by maprule"""))
def _(x):
    return joined_lists(x.allow_list(), ["maprule"], {"regions": F.col("region")}, [F.col("region")], count_name="n_regions")
