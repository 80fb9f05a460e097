"""Client groups, clusters, regions they depend on, and probe statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.functions.metrics import class_map, split_by_class
from casegauge.operators import clusters as C
from casegauge.operators.lists import explode_list, first_items
from casegauge.operators.regression import distance_latency_stats, linear_fit_cv, valid_points
from casegauge.operators.set_pairs import set_differences
from casegauge.operators.summary import case_summary, score_metric
from casegauge.plans.inputs import REGION_DAYS, SERVICE_CLASSES
from casegauge.plans.inputs_sql import miles, percentile, rounded, with_inputs
from casegauge.plans.registry import query
from casegauge.plans.summaries import metric_sql
from casegauge.sources.tables import stored

CLASS_SQL = "case network when 'web' then 'W' when 'secure' then 'S' else 'O' end"


@query("class_map", with_inputs("regions", f"""select region, "day", {CLASS_SQL} service, case when prp = 'private' then 1 else 0 end private,
    case when network = 'web' then cast(region_capacity as double) else 0 end cap_w,
    case when network = 'secure' then cast(region_capacity as double) else 0 end cap_s from regions"""))
def _(x):
    r = x.regions().withColumns({"service": class_map("network", SERVICE_CLASSES, "O"), "cap": F.col("region_capacity").cast("double")})
    return r.select("region", "day", "service", (F.col("prp") == "private").cast("int").alias("private"),
                    split_by_class("cap", "service", "W").alias("cap_w"), split_by_class("cap", "service", "S").alias("cap_s"))


SERVING = {"serving": f"""select region, latitude rg_lat, longitude rg_lon, {rounded('cast(peak_bitcap_mbps as double)/1000', 3)} bit_gbps,
    {rounded('cast(peak_flitcap_mfps as double)/1000', 3)} flit_gfps, country rg_country, numvips, {CLASS_SQL} service,
    case when prp = 'private' then 1 else 0 end private from newest where network in ('web', 'secure')"""}
DIST = miles("lat", "lon", "rg_lat", "rg_lon")
PAIRS = {**SERVING, "pairs": f"""select *, {DIST} distance from (select * exclude (allowed), unnest(allowed) rid from near_groups) join serving on rid = region
    where bit_gbps > 1 and ({DIST} < 500 or country = rg_country and {DIST} < 1000)"""}
GROUPED = {**PAIRS, "grouped": f"""select mpgid, country, load, lat, lon, asnum, string_agg(region, ':' order by region) region_list,
    {rounded('avg(distance)', 2)} avg_distance, {rounded("sum(case when service = 'W' then bit_gbps else 0 end)", 2)} cap_w,
    {rounded("sum(case when service = 'S' then bit_gbps else 0 end)", 2)} cap_s, cast(sum(numvips) as bigint) nvips, count(*) nreg
    from pairs group by 1, 2, 3, 4, 5, 6"""}
R = "3963.1676"


def centroid_sql(lat="lat", lon="lon", w="load"):
    x, y, z = f"cos(radians({lat}))*cos(radians({lon}))", f"cos(radians({lat}))*sin(radians({lon}))", f"sin(radians({lat}))"
    cx, cy, cz = (f"(sum({w}*{c})/sum({w}))" for c in (x, y, z))
    length = f"sqrt({cx}*{cx} + {cy}*{cy} + {cz}*{cz})"
    return f"""{rounded(f'90 - degrees(acos(greatest(-1, least(1, {cz}/{length}))))', 3)} cl_lat, {rounded(f'degrees(atan2({cy}, {cx}))', 3)} cl_lon,
        {rounded(length, 4)} cl_por, {rounded(f'sqrt(greatest(0, 1 - {length}*{length}))*{R}', 2)} cl_porsigma"""


CLUSTERS = {**GROUPED, "clusters": f"""select region_list, string_agg(distinct country, ':' order by country) geoname,
    {rounded('sum(avg_distance*load)/sum(load)', 2)} avg_distance, {centroid_sql()}, max(cap_w) cap_w, max(cap_s) cap_s, max(nvips) nvips, max(nreg) nreg,
    {rounded('sum(load)', 6)} load, count(*) nmpg from grouped group by region_list having sum(load) > 0.0001"""}
NEAR = "near_groups newest"


def serving(x):
    return C.serving_regions(x.regions().where(F.col("day") == REGION_DAYS[1]), SERVICE_CLASSES)


def grouped(x):
    return C.group_regions(C.reachable_regions(x.near_groups(), serving(x)), ("country", "load", "lat", "lon", "asnum"))


def clusters(x):
    return C.cluster_by_set(grouped(x))


@query("allowed_region_pairs", with_inputs(NEAR, f"select mpgid, region, service, {rounded('distance', 3)} distance from pairs", PAIRS))
def _(x):
    return C.reachable_regions(x.near_groups(), serving(x)).select("mpgid", "region", "service", F.round("distance", 3).alias("distance"))


@query("group_regions", with_inputs(NEAR, "select * from grouped", GROUPED))
def _(x):
    return grouped(x)


@query("cluster_by_set", with_inputs(NEAR, "select * from clusters", CLUSTERS))
def _(x):
    return clusters(x)


@query("cluster_members", with_inputs(NEAR, """select region_list, mpgid, count(*) over (partition by region_list) n_members
    from (select distinct region_list, mpgid from grouped)""", GROUPED))
def _(x):
    return C.cluster_members(grouped(x), "mpgid")


@query("cluster_networks", with_inputs(NEAR, """select region_list, count(*) n_networks,
    array_to_string(list(asnum order by asnum)[1:5], ':') first_networks from (select distinct region_list, asnum from grouped) group by 1""", GROUPED))
def _(x):
    return first_items(C.distinct_members(grouped(x), "asnum"), ["region_list"], "asnum", 5, "first_networks", count_name="n_networks")


@query("cluster_addresses", with_inputs(NEAR + " addresses", """select region_list, count(distinct nsip) n_nsips,
    coalesce(array_to_string(list_sort(list(distinct nsip) filter (nsip is not null))[1:5], ':'), 'NULL') first_nsips
    from grouped left join addresses using (mpgid) group by 1""", GROUPED))
def _(x):
    return C.cluster_addresses(grouped(x), x.addresses())


@query("geo_centroid", with_inputs("client_groups", f"""select country, asnum, {centroid_sql()} from client_groups group by 1, 2 having sum(load) > 0.0001"""))
def _(x):
    return C.weighted_centroid(x.client_groups(), ["country", "asnum"])


PUBLIC = {**CLUSTERS, "near_public": f"""select region_list, region, bit_gbps, flit_gfps, numvips from clusters, serving
    where private = 0 and {miles('cl_lat', 'cl_lon', 'rg_lat', 'rg_lon')} < 500"""}
ATTACHED = {**PUBLIC, "attached": f"""select c.*, {rounded('coalesce(b, 0)', 3)} pub_bit_gbps, {rounded('coalesce(f, 0)', 3)} pub_flit_gbps,
    coalesce(v, 0) pub_vips, coalesce(n, 0) pub_nreg from clusters c left join (select region_list, sum(bit_gbps) b, sum(flit_gfps) f,
    cast(sum(numvips) as bigint) v, count(*) n from near_public group by 1) p using (region_list)"""}


def attached(x):
    return C.attach_public(clusters(x), serving(x))


@query("public_region_attach", with_inputs(NEAR, "select * from attached", ATTACHED))
def _(x):
    return attached(x)


@query("public_region_lists", with_inputs(NEAR, """select c.region_list, coalesce(n, 0) pub_nreg, coalesce(l, 'NULL') pub_list from clusters c
    left join (select region_list, count(*) n, string_agg(region, ':' order by region) l from near_public group by 1) using (region_list)""", PUBLIC))
def _(x):
    return C.public_lists(clusters(x), serving(x))


@query("capacity_totals", with_inputs("newest", """select country, network, prp, cast(sum(peak_bitcap_mbps) as bigint) peak_bitcap_mbps,
    cast(sum(peak_flitcap_mfps) as bigint) peak_flitcap_mfps, cast(sum(numvips) as bigint) numvips from newest
    where network in ('web', 'secure') group by 1, 2, 3"""))
def _(x):
    return C.capacity_totals(x.regions().where(F.col("day") == REGION_DAYS[1]), list(SERVICE_CLASSES))


@query("pair_difference", with_inputs(NEAR, f"""select region_list, count(q) partners, {rounded('coalesce(sum(w), 0)', 3)} differing_gbps from
    (select distinct region_list from member) left join (select a.region_list, b.region_list q, any_value(s.w) + any_value(t.w) - 2*sum(a.bit_gbps) w
     from member a join member b using (region) join total s on s.region_list = a.region_list join total t on t.region_list = b.region_list
     where a.region_list <> b.region_list group by 1, 2 having any_value(s.n) + any_value(t.n) - 2*count(*) < 10) using (region_list) group by region_list""",
    {**CLUSTERS, "member": """select region_list, region, cast(bit_gbps as decimal(18,3)) bit_gbps from
        (select region_list, cast(unnest(string_split(region_list, ':')) as bigint) region from clusters) join serving using (region)""",
     "total": "select region_list, count(*) n, sum(bit_gbps) w from member group by 1"}))
def _(x):
    members = explode_list(clusters(x), ["region_list"], "region_list", "region").withColumn("region", F.col("region").cast("long"))
    rows = members.join(serving(x).select("region", "bit_gbps"), "region")
    out = set_differences(rows, "region_list", "region", "bit_gbps", differing="differing_gbps")
    return out.withColumn("differing_gbps", F.round("differing_gbps", 3))


# The load thresholds of the coverage curve, in units of the scaled load.
THRESHOLDS = [i / 100 for i in range(1, 200, 2)]


@query("coverage_curve", with_inputs("client_groups", f"""select t threshold, count(l) clusters,
    {rounded("coalesce(sum(l), 0)/(select sum(load/8192) from client_groups)", 6)} load_share
    from (select unnest({THRESHOLDS}::double[]) t) left join (select load/8192 l from client_groups) on l >= t group by t"""))
def _(x):
    return C.coverage_curve(x.client_groups(), F.col("load") / 8192, THRESHOLDS)


@query("multi_threshold_count", with_inputs(NEAR, f"""select count(*) clusters, {rounded('coalesce(sum(load), 0)', 6)} load from attached where load >= 100000
    or ((pub_bit_gbps < 50 or pub_flit_gbps < 25 or pub_vips < 40) and (pub_bit_gbps + cap_w < 150 or pub_flit_gbps + cap_s < 120 or pub_vips + nvips < 90))""", ATTACHED))
def _(x):
    return C.short_capacity(attached(x), F.col("load"), 100000, (50, 25, 40), (150, 120, 90))


def share(c):
    return f"sum(case when t.{c} > 0 then cast(r.{c} as double)/t.{c} else 0 end)/max(n)"


# The rules of the first group; all others are the second one.
WEB_RULES = [0, 1, 2]

CRITICAL = {**PUBLIC, "reach": """select region_list, cast(unnest(string_split(region_list, ':')) as bigint) region from clusters
        union select region_list, region from near_public""",
    "r": f"""select region_list, case when list_contains({WEB_RULES}, maprule) then 'W' else 'S' end rule_group, maprule, region, bit_gbps, flit_gfps, numvips
        from reach join serving using (region) join allow_list using (region)""",
    "t": "select region_list, rule_group, maprule, sum(bit_gbps) bit_gbps, sum(flit_gfps) flit_gfps, sum(numvips) numvips from r group by 1, 2, 3",
    "m": f"""select region_list, rule_group, region, {share('bit_gbps')} b, {share('flit_gfps')} f, {share('numvips')} v from r join t using (region_list, rule_group, maprule)
        join (select region_list, rule_group, count(*) n from t group by 1, 2) using (region_list, rule_group) group by 1, 2, 3""",
    "full_": """select rule_group, geoname, load, nmpg, coalesce(region, 0) region, coalesce(b, 1) b, coalesce(f, 1) f, coalesce(v, 1) v
        from (select *, unnest(['W', 'S']) rule_group from clusters) left join m using (region_list, rule_group)"""}


@query("region_criticality", with_inputs(NEAR + " allow_list", f"""select rule_group, region, geo_list, {rounded('sum(load)', 4)} mpg_load, cast(sum(nmpg) as bigint) mpg_num,
    {', '.join(f"{rounded(f'sum({c})', 6)} {c}_ratio, {rounded(f'sum({c}*load)', 4)} dw_{c}_ratio" for c in 'bfv')}, count(*) clusters
    from full_ join (select rule_group, region, string_agg(distinct g, ':' order by g) geo_list from
        (select rule_group, region, unnest(string_split(geoname, ':')) g from full_) group by 1, 2)
    using (rule_group, region) group by rule_group, region, geo_list""", CRITICAL))
def _(x):
    """Regions that a cluster may use and public regions near it, for web rules and the others."""
    c = stored(clusters(x).withColumn("cluster", F.monotonically_increasing_id()), "clusters")
    members = explode_list(c, ["cluster"], "region_list", "region").withColumn("region", F.col("region").cast("long"))
    return C.region_criticality(c, members, x.allow_list(), serving(x), key="cluster", groups={"W": WEB_RULES}, others="S", public_miles=C.NEAR_MILES)


# -- probes and fits ------------------------------------------------------------------------------
V = {"v": "select *, latency < 10000 ok from probes"}
FIT = "case when n_valid > 10 then {0} else {1} end"


def probe_sql():
    whole = lambda c, p: percentile(f"cast(trunc(case when ok then {c} end) as bigint)", p)
    val = lambda c: f"case when ok then {c} end"
    x, y = val("distance"), val("latency")
    take = lambda e, d, n: rounded(FIT.format(e, d), n)
    return with_inputs("probes", f"""select ppip, pp_state, n_record, n_valid, {rounded('100.0::double*n_valid/n_record', 2)} valid_ratio,
        {take('r', 0, 6)} r, {take('a', 0, 3)} slope, {take('b', 0, 3)} intercept, {take('sqrt(greatest(0, (syy - a*sxy)/n_valid))', 0, 4)} err, {take('worst', 0, 3)} err_max,
        {', '.join(f'{take(f"mean_{n}", -1, 3)} avg_{n}' for n in ('dist', 'lat', 'loss'))},
        {', '.join(f'{take(f"{p}_{n}", -1, 3)} {p}_{n}' for p in ('p95', 'p50') for n in ('dist', 'lat', 'loss'))}
        from (select ppip, min(pp_state) pp_state, count(*) n_record, count({y}) n_valid, corr({x}, {y}) r, regr_slope({y}, {x}) a, regr_intercept({y}, {x}) b,
              regr_syy({y}, {x}) syy, regr_sxy({y}, {x}) sxy, avg({x}) mean_dist, avg({y}) mean_lat, avg({val('loss')}) mean_loss,
              {', '.join(f'{whole(c, p)} {q}_{n}' for q, p in (('p95', 0.95), ('p50', 0.5)) for c, n in (('distance', 'dist'), ('latency', 'lat'), ('loss', 'loss')))}
              from v group by ppip)
        left join (select ppip, max(abs(a*distance + b - latency)) worst from v join
              (select ppip, regr_slope({y}, {x}) a, regr_intercept({y}, {x}) b from v group by ppip) using (ppip) where ok group by ppip) using (ppip)""", V)


@query("distance_latency_stats", probe_sql())
def _(x):
    return distance_latency_stats(x.probes(), ["ppip"], attributes=["pp_state"])


# Two-sided p of a correlation r over n points: with sin(a) = |r|, the share of cos(t)^(n-3) beyond a on 0..pi/2 (Simpson's rule).
P_VALUE = with_inputs("probes", f"""select ppip, n_valid, {rounded('case when n_valid > 10 then r else 0 end', 6)} r, {rounded('case when n_valid > 10 then p else 1 end', 6)} rpv from
    (select ppip, any_value(n_valid) n_valid, any_value(r) r,
        sum((case when i in (0, 40000) then 1 else 2 + 2*(i % 2) end)*pow(abs(cos(a + (pi()/2 - a)*i/40000.0::double)), n_valid - 3))*(pi()/2 - any_value(a))/120000
            *2*exp(lgamma((any_value(n_valid) - 1)/2.0::double) - lgamma((any_value(n_valid) - 2)/2.0::double))/sqrt(pi()) p
     from (select *, asin(least(abs(r), 1.0::double)) a from (select ppip, count(*) filter (latency < 10000) n_valid,
        corr(latency, distance) filter (latency < 10000) r from probes group by ppip)), range(40001) t(i) group by ppip)""")


@query("distance_latency_p_value", P_VALUE)
def _(x):
    out = distance_latency_stats(x.probes(), ["ppip"], p_value=True)
    return out.select("ppip", "n_valid", "r", F.round("rpv", 6).alias("rpv"))


@query("probe_points", with_inputs("probes", f"""select ppip, count(*) over (partition by ppip) points, {rounded('distance', 3)} dist, {rounded('latency', 3)} latency
    from probes where latency < 10000"""))
def _(x):
    return valid_points(x.probes(), ["ppip"])


SP95 = score_metric("95")
FIT_TARGETS = [f"sp95_{t}" for t in ("t95", "t90", "t85", "t75", "t50")]
MONTH_SQL = "cast(strftime(to_timestamp(ts) at time zone 'UTC', '%Y%m') as int)"


def fit_sql():
    tr, te = "filter (not test)", "filter (test)"
    r2 = lambda t: (f"1 - (syy_{t} - 2*a_{t}*sxy_{t} + a_{t}*a_{t}*sxx_{t} + m_{t}*pow(my_{t} - a_{t}*mx_{t} - b_{t}, 2))/nullif(syy_{t}, 0)")
    sums = ", ".join(f"""regr_slope({t}, score) {tr} a_{t}, regr_intercept({t}, score) {tr} b_{t}, regr_sxx({t}, score) {te} sxx_{t}, regr_syy({t}, score) {te} syy_{t},
        regr_sxy({t}, score) {te} sxy_{t}, count({t}) {te} m_{t}, avg(score) {te} mx_{t}, avg({t}) {te} my_{t}""" for t in FIT_TARGETS)
    outs = ", ".join(f"{rounded(f'avg({r2(t)})', 2)} {t}_r2, {rounded(f'avg(b_{t})', 2)} {t}_intercept, {rounded(f'avg(a_{t})', 3)} {t}_coeff" for t in FIT_TARGETS)
    return with_inputs("case_sample plan", f"""select geoname, max(n) samples, max(load) load, {outs} from
        (select geoname, rep, count(*) n, sum(load) load, {sums} from
          (select *, (id*31 + rep*17) % 5 = 0 test from fit_rows, unnest(range(0, 10)) t(rep)) group by 1, 2 having count(*) >= 20) group by geoname""",
        {"monthly": f"""select maprule, geoname, netname, "month", {', '.join(metric_sql(SP95))} from (select *, {MONTH_SQL} as "month" from case_sample) group by 1, 2, 3, 4""",
         "fit_rows": f"""select geoname, score, load, {', '.join(f'cast({t} as double) {t}' for t in FIT_TARGETS)}, cast("month" as bigint)*101 + maprule*7 + ascii(netname) id
            from plan join monthly using (maprule, geoname, netname, "month") where load > 20 and netname <> 'N' and score_target <> 10000"""})


@query("linear_fit_cv", fit_sql())
def _(x):
    month = F.date_format(F.timestamp_seconds("ts"), "yyyyMM").cast("int")
    keys = [*CASE, "month"]
    monthly = case_summary(x.case_sample().withColumn("month", month), [SP95], keys)
    rows = x.plan().join(monthly, keys).where((F.col("load") > 20) & (F.col("netname") != "N") & (F.col("score_target") != 10000))
    rows = rows.select("geoname", "score", "load", *[F.col(t).cast("double").alias(t) for t in FIT_TARGETS],
                       (F.col("month").cast("long") * 101 + F.col("maprule") * 7 + F.ascii("netname")).alias("id"))
    return linear_fit_cv(rows, "geoname", "score", FIT_TARGETS, "load", lambda rep: (F.col("id") * 31 + rep * 17) % 5 == 0)
