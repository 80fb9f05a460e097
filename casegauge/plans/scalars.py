"""Row-level expressions, text, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.functions import metrics as M, text as X
from casegauge.operators.summary import DAY, fourier_basis, slot_numbers, time_window
from casegauge.operators.topn import top_n_per_key
from casegauge.plans.inputs_sql import rounded, with_inputs
from casegauge.plans.registry import query
from casegauge.sources.tables import split_fields


@query("sanitize_numeric", f"""select event_id, case when user_id % 7 = 0 or user_id % 11 = 0 then -100 else cast(trunc(value*100.0::double) as int) end clean from events""")
def _(x):
    k = F.col("user_id")
    raw = F.when(k % 7 == 0, F.lit(None).cast("double")).when(k % 11 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return x.table("events").select("event_id", M.sanitize_numeric(raw, 100).alias("clean"))


NAME_SQL = "'S.MR_' || (c_custkey % 50) || '.GEO_' || substr(c_mktsegment, 1, 1 + c_nationkey % 3) || '.N'"


@query("parse_case_name", f"""select c_custkey, {NAME_SQL} casename, cast(c_custkey % 50 as int) maprule, substr(c_mktsegment, 1, 1 + c_nationkey % 3) geoname,
    case when c_custkey % 4 = 0 then 'ANY' else c_mktsegment end netname,
    'MR_' || (c_custkey % 50) || ':GEO_' || substr(c_mktsegment, 1, 1 + c_nationkey % 3) || ':' || case when c_custkey % 4 = 0 then 'ANY' else c_mktsegment end as label
    from customer where c_nationkey % 3 = 1""")
def _(x):
    """Names taken apart; only two-letter geos are kept."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("S.MR_"), (k % 50).cast("string"), F.lit(".GEO_"),
                    F.substring("c_mktsegment", F.lit(1), 1 + F.col("c_nationkey") % 3), F.lit(".N"))
    net = F.when(k % 4 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    rows = x.table("customer").select("c_custkey", name.alias("casename"), net.alias("aslist"))
    rows = rows.select("c_custkey", "casename", *[c.alias(n) for n, c in X.parse_case_name("casename").items()],
                       X.default_network("aslist").alias("netname"))
    return rows.where(F.length("geoname") == 2).withColumn("label", X.case_label())


@query("peak_flag", """select event_id, n_name geo, cast(hour(ts) as int) as "hour", off,
    case when off is null then 0 when ((hour(ts) + off) % 24 + 24) % 24 >= 18 then 1 else 0 end peak
    from events left join (select n_nationkey, n_name, case n_regionkey when 0 then 2 when 1 then -4 when 2 then 9 when 3 then 5 else -7 end off
      from nation) on user_id % 30 = n_nationkey""")
def _(x):
    """Evening flag by the local hour of the geo; unknown geos count as off-peak."""
    zone = M.class_map("n_regionkey", {0: "Europe/Berlin", 1: "America/New_York", 2: "Asia/Tokyo", 3: "Asia/Kolkata"}, "America/Phoenix")
    dim = x.table("nation").select("n_nationkey", F.col("n_name").alias("geo"), M.utc_offset_hours(zone).alias("off"))
    e = x.table("events").select("event_id", (F.col("user_id") % 30).cast("int").alias("n_nationkey"), F.hour("ts").alias("hour"))
    return e.join(dim, "n_nationkey", "left").select("event_id", "geo", "hour", "off", M.peak_flag("hour", "off").alias("peak"))


@query("utc_offset_dim", """select n_nationkey, n_name geo, case n_regionkey when 0 then 2 when 1 then -4 when 2 then 9 when 3 then 5 else -7 end utc_offset from nation""")
def _(x):
    zone = M.class_map("n_regionkey", {0: "Europe/Berlin", 1: "America/New_York", 2: "Asia/Tokyo", 3: "Asia/Kolkata"}, "America/Phoenix")
    return x.table("nation").select("n_nationkey", F.col("n_name").alias("geo"), M.utc_offset_hours(zone).alias("utc_offset"))


@query("reference_names", """select p_partkey, case p_size % 3 when 0 then 'Web' when 1 then 'Secure' else 'Other' end service,
    replace(substr(p_name || ', ' || p_type, 1, 25), ',', ';') description, p_brand || ' [' || p_partkey || ']' label from part""")
def _(x):
    k = F.col("p_size") % 3
    name = F.concat(F.lit("a_"), F.col("p_brand"), F.lit(".x"))
    return x.table("part").select("p_partkey", M.class_map(k, {0: "Web", 1: "Secure"}, "Other").alias("service"),
                                  X.short_description(F.concat_ws(", ", "p_name", "p_type")).alias("description"),
                                  X.reference_label(name, "p_partkey").alias("label"))


@query("truncate_list", """select o_custkey, array_to_string(list(o_orderkey order by o_orderkey)[1:5], ':') first_orders from orders group by 1""")
def _(x):
    """First five items of a joined list; only five rows per key reach the list."""
    top = top_n_per_key(x.table("orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 6)
    joined = top.groupBy("o_custkey").agg(X.join_list(F.array_sort(F.collect_list("o_orderkey"))).alias("l"))
    return joined.select("o_custkey", X.truncate_list("l", 5).alias("first_orders"))


@query("threshold_filter", """select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax from lineitem where l_quantity > 48 or l_discount < 0.01 or l_tax > 0.07""")
def _(x):
    li = x.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return li.where((F.col("l_quantity") > 48) | (F.col("l_discount") < 0.01) | (F.col("l_tax") > 0.07))


@query("time_window_filter", f"""select 'open' bounds, count(*) n, min(t) first, max(t) last from (select cast(floor(epoch(o_orderdate)) as bigint) t from orders)
    where t > 883612800 and t < 946684800 union all select 'half', count(*), min(t), max(t) from (select cast(floor(epoch(o_orderdate)) as bigint) t from orders)
    where t >= 883612800 and t < 946684800""")
def _(x):
    t = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("t")
    figures = lambda name, b: time_window(x.table("orders"), "o_orderdate", 883612800, 946684800, b).select(t).agg(
        F.lit(name).alias("bounds"), F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))
    return figures("open", "()").unionByName(figures("half", "[)"))


@query("column_pick", "select s_suppkey region, s_name regionname, s_nationkey location from supplier")
def _(x):
    return x.table("supplier").select(F.col("s_suppkey").alias("region"), F.col("s_name").alias("regionname"), F.col("s_nationkey").alias("location"))


@query("default_token", """select c_custkey, cast(c_custkey % 9 as varchar) maprule, 'G' || c_nationkey geoname, case when c_custkey % 3 = 0 then 'ANY' else c_mktsegment end netname,
    cast(c_nationkey as varchar) load from customer where c_custkey % 10 <> 9""")
def _(x):
    """Records that may lack the network field, mixed separators, header lines in between."""
    k = F.col("c_custkey")
    net = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" | "), F.col("c_mktsegment")))
    line = F.concat((k % 9).cast("string"), F.lit("|G"), F.col("c_nationkey").cast("string"), net, F.lit(" "), F.col("c_nationkey").cast("string"))
    line = F.when(k % 10 == 9, F.lit("maprule|geoname|netname|score_target")).otherwise(line)
    rows = x.table("customer").select("c_custkey", line.alias("line"))
    return split_fields(rows, "line", ["maprule", "geoname", "netname", "load"], "netname", "score_target")


@query("union_all", """select l_suppkey id, l_orderkey ref from lineitem union all select s_suppkey, null from supplier""")
def _(x):
    a = x.table("lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_orderkey").alias("ref"))
    return a.unionByName(x.table("supplier").select(F.col("s_suppkey").alias("id")), allowMissingColumns=True)


@query("intersect", "select o_custkey k from orders intersect select c_custkey from customer where c_acctbal > 0")
def _(x):
    return x.table("orders").select(F.col("o_custkey").alias("k")).intersect(
        x.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")))


@query("except", "select c_custkey k from customer except select o_custkey from orders where o_totalprice > 400000")
def _(x):
    return x.table("customer").select(F.col("c_custkey").alias("k")).subtract(
        x.table("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("k")))


@query("distinct_values", with_inputs("case_sample", "select distinct maprule, geoname, netname from case_sample"))
def _(x):
    return x.case_sample().select(*CASE).distinct()


@query("set_union", """select grp, array_to_string(list_sort(list_distinct(list_concat(a, b))), ':') merged from
    (select o_custkey % 100 grp, list(distinct month(o_orderdate)) a, list(distinct day(o_orderdate)) b from orders group by 1)""")
def _(x):
    """Union of two small-domain sets (months and days of the month) per group."""
    o = x.table("orders").groupBy((F.col("o_custkey") % 100).alias("grp")).agg(
        F.collect_set(F.month("o_orderdate")).alias("a"), F.collect_set(F.dayofmonth("o_orderdate")).alias("b"))
    return o.select("grp", X.join_list(F.array_sort(F.array_union("a", "b"))).alias("merged"))


@query("date_functions", """select o_orderkey, strftime(o_orderdate, '%Y%m%d') datestamp, strftime(o_orderdate, '%H') as "hour",
    replace(cast(cast(o_orderdate as date) - 1 as varchar), '-', '') before, cast(weekofyear(o_orderdate) as int) iso_week,
    cast(floor(epoch(o_orderdate)) as bigint) // 86400 * 86400 day_start, cast(cast(o_orderdate as date) + 1 as date) next_day from orders""")
def _(x):
    d = F.col("o_orderdate").cast("date")
    t = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return x.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("datestamp"), F.date_format("o_orderdate", "HH").alias("hour"),
        F.regexp_replace(F.date_sub(d, 1).cast("string"), "-", "").alias("before"), F.weekofyear("o_orderdate").alias("iso_week"),
        (t - t % DAY).alias("day_start"), F.date_add(d, 1).alias("next_day"))


@query("elapsed_slots", with_inputs("region_sample", f"""select ts, cast(floor((ts - 1704067200)/600.0) as int) + 1 slot,
    {rounded('cos(-2*pi()*2*floor((ts - 1704067200)/600.0)/2016)', 6)} cos2 from (select distinct ts from region_sample)"""))
def _(x):
    """Slots by elapsed time from a start, so gaps do not shift the phase."""
    b = slot_numbers(x.region_sample(), "ts", start=1704067200, step=600)
    return b.select("ts", "slot", F.round(fourier_basis()[0], 6).alias("cos2"))
