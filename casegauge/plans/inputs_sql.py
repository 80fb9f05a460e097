"""The projections of `inputs` in DuckDB SQL, as named common table expressions."""

from __future__ import annotations

EPOCH = "cast(floor(epoch({0})) as bigint)"


def _int(x: str) -> str:
    return f"cast(trunc({x}) as int)"


def _big(x: str) -> str:
    return f"cast(trunc({x}) as bigint)"


POSITION = ("cast(({0}*37) % 1200 as double)/10 - 60", "cast(({0}*91) % 3600 as double)/10 - 180")


def _lat(k):
    return POSITION[0].format(k)


def _lon(k):
    return POSITION[1].format(k)


# Users dealt out over all suppliers.
REGION_OF = "user_id % (select max(s_suppkey) - min(s_suppkey) + 1 from supplier) + (select min(s_suppkey) from supplier)"

# name -> (needed expressions, query)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "line_cases": ((), f"""
        select cast(l_suppkey % 4 as int) maprule, n_name geoname, l_returnflag netname, {EPOCH.format('l_shipdate')} ts,
               {_int('l_quantity')} q, {_int('l_discount*100')} d, {_int('l_extendedprice')} p, l_linenumber line
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"""),
    "case_sample": (("line_cases",), f"""
        select maprule, geoname, netname, ts, max(q)+5 sp99, max(q) sp95, cast(floor((max(q)+min(q))/2.0) as int) sp90, min(q) sp75,
               30 star, max(d)*100+50 dp99, max(d)*100 dp95, max(d)*50 dp90, min(d)*50 dp75, 500 dtar,
               min(q)*2 icy_pct, 40 icy_tar, max(q)*2 ict_pct, 60 ict_tar, cast(sum(p) as bigint) total_bps,
               cast(sum(case when line % 2 = 0 then p else 0 end) as bigint) ping_bps,
               case when sum(p) > 0 then {_int('10000.0::double*cast(sum(case when line % 2 = 0 then p else 0 end) as double)/cast(sum(p) as double)')} else 0 end p2t_bps_pct,
               case when maprule <> 3 then max(d)*10 else -1 end ioratio, case when maprule <> 3 then 40 else -1 end ioratio_tar
        from line_cases group by maprule, geoname, netname, ts"""),
    "customers": ((), "select * from customer join nation on c_nationkey = n_nationkey"),
    "objectives": (("customers",), """
        select cast(c_custkey % 6 as int) maprule, case when c_custkey % 4 = 0 then 'GLOBAL' else n_name end geoname,
               case when c_custkey % 3 = 0 then 'ANY' else c_mktsegment end netname,
               (['SCORE','DISTANCE','IN-OUT-RATIO','COGS'])[cast(floor(c_custkey/12.0) as bigint) % 4 + 1] attrname,
               cast(c_custkey % 90 as int) targetvalue, case when c_custkey % 2 = 0 then 80 else 95 end targetpct
        from customers"""),
    "overview": (("customers",), f"""
        select 'C' || c_custkey casename, cast(c_custkey % 6 as int) mapruleid, case when c_custkey % 5 = 0 then '' else n_name end geo,
               case when c_custkey % 7 = 0 then '' else c_mktsegment end aslist, {_int('c_acctbal')} metric,
               {_big('abs(c_acctbal)*1000000')} ra_load_total, cast(c_custkey % 101 as double) ping_perc
        from customers"""),
    "case_statistics": ((), f"""
        select 'C' || o_custkey casename, case when cast(floor(o_orderkey/4.0) as bigint) % 2 = 0 then 'score' else 'distance' end metric_type,
               ([0.99,0.95,0.90,0.75])[o_orderkey % 4 + 1] config_percentile, {_int('o_totalprice/1000')} metric_value
        from orders"""),
    "view_by_region": (("overview",), """
        select casename, l_suppkey regionid, cast(cast(trunc(l_discount*100) as int) as double)/128 percentage, mapruleid, geo, aslist
        from lineitem join orders on l_orderkey = o_orderkey join overview on casename = 'C' || o_custkey"""),
    "traffic": ((), f"""
        select 'm' || l_suppkey ghostip, cast(year(l_shipdate) as int) ts, cast(l_partkey % 6 as int) maprule_id, l_linenumber georegion,
               {_big('l_quantity')} hits, {_big('l_quantity')} + l_linenumber connections, {_big('l_extendedprice*(1+l_tax)')} flytes,
               {_big('l_extendedprice')} bytes, {_big('l_extendedprice*l_discount')} bytes_in, {_big('l_extendedprice')}*10 cpu,
               {_big('l_tax*1000000')} disk
        from lineitem"""),
    "machines": ((), """
        select 'm' || s_suppkey ghostip, s_suppkey region, s_name regionname, cast(y as int) ts
        from supplier, (select unnest(range(min(year(l_shipdate)), max(year(l_shipdate)) + 1)) y from lineitem)"""),
    "machine_traffic": (("traffic", "machines"), """
        select maprule_id, region, cast(sum(bytes) as bigint) bytes, cast(sum(bytes_in) as bigint) bytes_in, cast(sum(hits) as bigint) hits,
               cast(sum(connections) as bigint) connections, cast(sum(flytes) as bigint) flytes, cast(sum(cpu) as bigint) cpu,
               cast(sum(disk) as bigint) disk
        from traffic join machines using (ghostip, ts) group by maprule_id, region"""),
    "locations": ((), "select s_suppkey region, s_nationkey location from supplier"),
    "bandwidth_cost": ((), "select n_nationkey location, cast(n_nationkey as double)/8 + 0.5::double nominalrate from nation"),
    "regions": ((), f"""
        select s_suppkey region, s_name \"name\", cast(s_suppkey % 10 as int) ecor, r_name continent, n_name country, 'city' || (s_suppkey % 50) city,
               {_lat('s_suppkey')} latitude, {_lon('s_suppkey')} longitude, cast(s_suppkey % 20 as int) asnum, 'P' || (s_suppkey % 7) provider,
               {_int('abs(s_acctbal)')} region_capacity, cast((s_suppkey % 10)*1000 as int) ecor_capacity,
               case when s_suppkey % 2 = 0 then 'private' else 'public' end prp, cast(s_suppkey % 9 + 1 as int) numghosts,
               (['web','secure','other'])[s_suppkey % 3 + 1] network, {_int('abs(s_acctbal)*10')} peak_bitcap_mbps,
               {_int('abs(s_acctbal)*5')} peak_flitcap_mfps, cast(s_suppkey % 100 as int) numvips, \"day\"
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey,
             unnest(['20240129','20240130']) t(\"day\")
        where \"day\" = '20240130' or s_suppkey % 3 <> 0"""),
    "newest": (("regions",), "select * from regions where \"day\" = (select max(\"day\") from regions)"),
    "region_sample": ((), f"""
        select cast(user_id % 5 as int) maprule, event_type geoname, case when user_id % 2 = 0 then 'ANY' else 'N1' end netname,
               {REGION_OF} region, cast({_big('"value"*100')} as double)/128 score, {_int('"value"')} nsd_demand, {_int('"value"*2')} eu_demand, {_big('"value"*100')} ra_load,
               cast({_big('"value"*100')} as double)/1024 case_percent_pre_norm_load, cast({_big('"value"*100')} as double)/512 case_percent_load,
               cast({_big('"value"*100')} as double)/2048 recorded_load_percentage,
               strftime(ts, '%Y%m%d') datestamp, strftime(ts, '%H') as \"hour\",
               {EPOCH.format('ts')} - {EPOCH.format('ts')} % 600 ts
        from events"""),
    "score_targets": ((), f"""
        select cast(user_id % 5 as int) maprule, event_type geoname, case when user_id % 2 = 0 then 'ANY' else 'N1' end netname,
               {_int('"value"')} targetvalue from events"""),
    "assignment_log": ((), f"""
        select o_custkey mpgid, cast(l_suppkey % 4 as int) mrid, 'NS' mpg_type, l_suppkey region, l_linenumber link, {_int('l_quantity')} cnt,
               {_int('l_extendedprice')} min_s, {_int('l_extendedprice')} + 100 max_s, cast(l_partkey % 300 as int) min_r,
               cast(l_partkey % 300 + 1 as int) max_r, 600.0::double dftime, case when o_custkey % 2 = 0 then 'u0' else 'u1' end mpd_uuid,
               {EPOCH.format('o_orderdate')} ts
        from lineitem join orders on l_orderkey = o_orderkey"""),
    "assignment_sum": (("assignment_log", "newest"), """
        select a.*, ecor, continent, country, latitude, longitude,
               round(case when prp = 'private' then mpd_dftime else 0 end, 4) prp
        from (
          select mpd_uuid, mpgid, mrid, mpg_type, region, link,
                 round(sum(min_s*dd), 4) min_s, round(sum(max_s*dd), 4) max_s, round(sum(min_r*dd), 4) min_r, round(sum(max_r*dd), 4) max_r,
                 round(sum(case when min_s % 2 = 0 then dd else 0 end), 4) ping, round(sum(case when min_s % 4 >= 2 then dd else 0 end), 4) local,
                 round(sum(case when max_s > 65533 and max_r > 253 then dd else 0 end), 4) cont_fb, round(sum(dd), 4) mpd_dftime
          from (select *, cast(round(cast(cast(cast(cnt as double)/sum(cnt) over (partition by mpgid, mrid, mpd_uuid, ts) as varchar) as decimal(38,20)), 5) as double)*dftime dd
                from assignment_log)
          group by all) a join newest using (region)"""),
    "clients": (("customers",), f"""
        select c_custkey mpgid, 'ns' || c_custkey nsip, abs(c_acctbal) ns_demand, cast(c_custkey % 20 as int) ns_asnum, n_name ns_country,
               r_name ns_continent, {_lat('c_custkey')} ns_lat, {_lon('c_custkey')} ns_lon, abs(c_acctbal) mpg_load
        from customers join region on n_regionkey = r_regionkey"""),
    "client_rows": (("assignment_sum", "clients"), """
        select *, cast(round(cast(cast(mpd_dftime/longest as varchar) as decimal(38,20)), 3) as double) share_
        from (select *, max(mpd_dftime) over (partition by mpd_uuid) longest from assignment_sum where latitude is not null and longitude is not null)
        join clients using (mpgid) where ns_demand > 1 and ns_lat is not null and ns_lon is not null"""),
    "addresses": ((), "select distinct o_custkey mpgid, 'ns' || (o_orderkey % 997) nsip from orders where o_custkey % 10 <> 0"),
    "networks": ((), "select distinct cast(c_custkey % 20 as int) asnum, c_mktsegment netname from customer"),
    "client_groups": (("customers",), f"""
        select c_custkey mpgid, {_lat('c_custkey')} lat, {_lon('c_custkey')} lon, n_name country, abs(c_acctbal) load, cast(c_custkey % 20 as int) asnum
        from customers"""),
    "allowed_regions": ((), """
        select o_custkey mpgid, list_sort(list(distinct l_suppkey)) allowed from lineitem join orders on l_orderkey = o_orderkey group by 1"""),
    "near_groups": (("client_groups", "allowed_regions"), f"""
        select * exclude (anchor), {_lat('anchor')} + cast(mpgid % 7 as double)/10 lat, {_lon('anchor')} + cast(mpgid % 11 as double)/10 lon
        from (select * exclude (lat, lon), allowed[mpgid % len(allowed) + 1] anchor from client_groups join allowed_regions using (mpgid))"""),
    "allow_list": ((), "select distinct cast(l_partkey % 6 as int) maprule, l_suppkey region from lineitem"),
    "probes": ((), """
        select cast(l_partkey % 50 as int) ppip, l_suppkey region, l_quantity*10 distance, l_extendedprice/10 latency, l_discount*100 loss,
               l_returnflag pp_state from lineitem"""),
    "coverage": (("customers",), """
        select strftime(o_orderdate, '%Y%m') as \"day\", n_name country, cast(c_custkey % 20 as int) asnum, sum(o_totalprice) sum_demand,
               avg(cast(c_custkey % 7 as double)/7) in_country_pct, avg(cast(c_custkey % 9 as double)/9) in_asn_pct,
               avg(cast(c_custkey % 5 as double)/5) weighted_distance,
               case when n_name = 'NATION_3' then 0.0::double else avg(cast(c_custkey % 11 as double)/11) end has_pp_pct,
               avg(cast(c_custkey % 13 as double)/13) in_provider_pct
        from orders join customers on o_custkey = c_custkey group by 1, 2, 3"""),
    "members": ((), "select distinct event_type as \"name\", cast(user_id as int) asnum from events"),
    "plan": (("line_cases",), """
        select maprule, geoname, netname, cast(strftime(to_timestamp(ts) at time zone 'UTC', '%Y%m') as int) \"month\", cast(sum(q) as double) load,
               cast(max(q + maprule) as double) score, case when max(d) > 9 then 10000 else 30 end score_target
        from line_cases group by 1, 2, 3, 4"""),
}


def rounded(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form of a double, as in Spark."""
    return f"cast(round(cast(cast(cast({x} as double) as varchar) as decimal(38,20)), {digits}) as double)"


def percentile(x: str, p: float) -> str:
    """Exact interpolated percentile, term by term as Spark computes it."""
    items, pos = f"list({x} order by {x}) filter ({x} is not null)", f"({p}::double*(count({x})-1))"
    lo, hi = (f"({items})[cast({f}({pos}) as bigint)+1]" for f in ("floor", "ceil"))
    return f"(case when {lo} = {hi} then {lo} else (ceil({pos})-{pos})*{lo} + ({pos}-floor({pos}))*{hi} end)"


def miles(a: str, b: str, c: str, d: str) -> str:
    """Great-circle distance of two positions in degrees."""
    s = (f"least(pow(sin((radians({c})-radians({a}))/2), 2) + cos(radians({a}))*cos(radians({c}))"
         f"*pow(sin((radians({d})-radians({b}))/2), 2), 1.0::double)")
    return f"(2*3963.1676*atan2(sqrt({s}), sqrt(1.0::double-{s})))"


def with_inputs(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by the named expressions and all they need, each once."""
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names.split():
        visit(n)
    parts = [f"{n} as ({CTES[n][1]})" for n in seen] + [f"{n} as ({q})" for n, q in (extra or {}).items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
