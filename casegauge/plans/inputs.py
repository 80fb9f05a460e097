"""The shared test tables seen as service-quality feeds.

Each method projects whole tables onto one of the domain's feeds (case samples, region samples,
targets, machine counters, assignment logs, client groups, probes); `inputs_sql` states the same
projections in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casegauge.functions.metrics import guarded_ratio
from casegauge.functions.times import at_least
from casegauge.operators.summary import time_window
from casegauge.sources.tables import read_parquet

# Class codes of the synthetic regions and the days of their snapshots.
SERVICE_CLASSES = {"web": "W", "secure": "S"}
REGION_DAYS = ("20240129", "20240130")


def epoch(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def to_int(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("int")


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.folder, name)

    # -- case samples ---------------------------------------------------------------------------
    def line_cases(self, period: tuple[int, int, str] | None = None) -> DataFrame:
        """Line items with their case: rule from the supplier, geo from its nation. A period (start, end, bounds) is
        cut out of the raw table."""
        geo = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            "s_suppkey", F.col("n_name").alias("geoname"))
        li = self.table("lineitem")
        li = li if period is None else time_window(li, "l_shipdate", *period)
        return li.join(geo, li["l_suppkey"] == geo["s_suppkey"]).select(
            to_int(F.col("l_suppkey") % 4).alias("maprule"), "geoname", F.col("l_returnflag").alias("netname"),
            epoch("l_shipdate").alias("ts"), to_int("l_quantity").alias("q"),
            to_int(F.col("l_discount") * 100).alias("d"), to_int("l_extendedprice").alias("p"),
            F.col("l_linenumber").alias("line"))

    def case_sample(self, period: tuple[int, int, str] | None = None) -> DataFrame:
        g = self.line_cases(period).groupBy("maprule", "geoname", "netname", "ts").agg(
            F.max("q").alias("qx"), F.min("q").alias("qn"), F.max("d").alias("dx"), F.min("d").alias("dn"),
            F.sum("p").alias("total_bps"), F.sum(F.when(F.col("line") % 2 == 0, F.col("p")).otherwise(0)).alias("ping_bps"))
        io = F.col("maprule") != 3
        return g.select(
            "maprule", "geoname", "netname", "ts",
            (F.col("qx") + 5).alias("sp99"), F.col("qx").alias("sp95"),
            F.floor((F.col("qx") + F.col("qn")) / 2).cast("int").alias("sp90"), F.col("qn").alias("sp75"),
            F.lit(30).alias("star"), (F.col("dx") * 100 + 50).alias("dp99"), (F.col("dx") * 100).alias("dp95"),
            (F.col("dx") * 50).alias("dp90"), (F.col("dn") * 50).alias("dp75"), F.lit(500).alias("dtar"),
            (F.col("qn") * 2).alias("icy_pct"), F.lit(40).alias("icy_tar"), (F.col("qx") * 2).alias("ict_pct"),
            F.lit(60).alias("ict_tar"), "total_bps", "ping_bps",
            guarded_ratio("ping_bps", "total_bps", 10000).cast("int").alias("p2t_bps_pct"),
            F.when(io, F.col("dx") * 10).otherwise(-1).alias("ioratio"),
            F.when(io, F.lit(40)).otherwise(-1).alias("ioratio_tar"))

    def metric_feed(self, kind: str, sample: DataFrame) -> DataFrame:
        """One metric's feed from the stored case samples."""
        s, case = sample, ["maprule", "geoname", "netname", "ts"]
        if kind in ("score", "distance"):
            a, t = ("sp", "star") if kind == "score" else ("dp", "dtar")
            return s.select(*case, *[F.col(f"{a}{x}").alias(f"p{x}") for x in ("99", "95", "90", "75")],
                            F.col(t).alias("targetvalue"))
        if kind in ("in_country", "in_continent"):
            a = "icy" if kind == "in_country" else "ict"
            return s.select(*case, F.col(f"{a}_pct").alias(f"{kind}_pct"), F.col(f"{a}_tar").alias("targetvalue"))
        if kind == "io":
            return s.where("maprule <> 3").select(*case, F.col("ioratio").cast("double").alias("ioratio"),
                                                  F.col("ioratio_tar").alias("iotarget"), F.lit(100).alias("coverage"))
        return s.select(*case, "total_bps", "ping_bps", "p2t_bps_pct")

    # -- targets and case overview --------------------------------------------------------------
    def customers(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    def objectives(self) -> DataFrame:
        k = F.col("c_custkey")
        attr = F.element_at(F.array(*[F.lit(x) for x in ("SCORE", "DISTANCE", "IN-OUT-RATIO", "COGS")]),
                            (F.floor(k / 12) % 4 + 1).cast("int"))
        return self.customers().select(
            to_int(k % 6).alias("maprule"), F.when(k % 4 == 0, F.lit("GLOBAL")).otherwise(F.col("n_name")).alias("geoname"),
            F.when(k % 3 == 0, F.lit("ANY")).otherwise(F.col("c_mktsegment")).alias("netname"), attr.alias("attrname"),
            to_int(k % 90).alias("targetvalue"), F.when(k % 2 == 0, F.lit(80)).otherwise(F.lit(95)).alias("targetpct"))

    def overview(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.customers().select(
            F.concat(F.lit("C"), k.cast("string")).alias("casename"), to_int(k % 6).alias("mapruleid"),
            F.when(k % 5 == 0, F.lit("")).otherwise(F.col("n_name")).alias("geo"),
            F.when(k % 7 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("aslist"),
            to_int("c_acctbal").alias("metric"), (F.abs("c_acctbal") * 1000000).cast("long").alias("ra_load_total"),
            (k % 101).cast("double").alias("ping_perc"))

    def case_statistics(self) -> DataFrame:
        k = F.col("o_orderkey")
        level = F.element_at(F.array(*[F.lit(x).cast("decimal(8,6)") for x in ("0.99", "0.95", "0.90", "0.75")]), (k % 4 + 1).cast("int"))
        return self.table("orders").select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("casename"),
            F.when(F.floor(k / 4) % 2 == 0, F.lit("score")).otherwise(F.lit("distance")).alias("metric_type"),
            level.alias("config_percentile"), to_int(F.col("o_totalprice") / 1000).alias("metric_value"))

    def view_by_region(self) -> DataFrame:
        li, o, c = self.table("lineitem"), self.table("orders"), self.overview()
        rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("casename"), F.col("l_suppkey").alias("regionid"),
            (to_int(F.col("l_discount") * 100).cast("double") / 128).alias("percentage"))
        return rows.join(c.select("casename", "mapruleid", "geo", "aslist"), "casename")

    # -- machines and traffic -------------------------------------------------------------------
    def traffic(self) -> DataFrame:
        p = to_int("l_extendedprice").cast("long")
        big = lambda c: c.cast("long")
        return self.table("lineitem").select(
            F.concat(F.lit("m"), F.col("l_suppkey").cast("string")).alias("ghostip"), F.year("l_shipdate").alias("ts"),
            to_int(F.col("l_partkey") % 6).alias("maprule_id"), F.col("l_linenumber").alias("georegion"),
            big(F.col("l_quantity")).alias("hits"), (big(F.col("l_quantity")) + F.col("l_linenumber")).alias("connections"),
            big(F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))).alias("flytes"), p.alias("bytes"),
            big(F.col("l_extendedprice") * F.col("l_discount")).alias("bytes_in"), (p * 10).alias("cpu"),
            big(F.col("l_tax") * 1000000).alias("disk"))

    def machines(self) -> DataFrame:
        """Every machine in every year that has traffic; the years are bounded by the calendar."""
        k, year = F.col("s_suppkey"), F.year("l_shipdate")
        first, last = self.table("lineitem").agg(F.min(year), F.max(year)).first()
        return self.table("supplier").select(
            F.concat(F.lit("m"), k.cast("string")).alias("ghostip"), k.alias("region"), F.col("s_name").alias("regionname"),
            F.explode(F.sequence(F.lit(first), F.lit(last))).alias("ts"))

    def locations(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("region"), F.col("s_nationkey").alias("location"))

    def bandwidth_cost(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("location"),
                                           (F.col("n_nationkey").cast("double") / 8 + 0.5).alias("nominalrate"))

    # -- regions --------------------------------------------------------------------------------
    def regions(self) -> DataFrame:
        """Two daily snapshots; the first lacks every third region."""
        k = F.col("s_suppkey")
        rows = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        rows = rows.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            k.alias("region"), F.col("s_name").alias("name"), to_int(k % 10).alias("ecor"), F.col("r_name").alias("continent"),
            F.col("n_name").alias("country"), F.concat(F.lit("city"), (k % 50).cast("string")).alias("city"),
            (((k * 37) % 1200).cast("double") / 10 - 60).alias("latitude"),
            (((k * 91) % 3600).cast("double") / 10 - 180).alias("longitude"), to_int(k % 20).alias("asnum"),
            F.concat(F.lit("P"), (k % 7).cast("string")).alias("provider"), to_int(F.abs("s_acctbal")).alias("region_capacity"),
            to_int((k % 10) * 1000).alias("ecor_capacity"), F.when(k % 2 == 0, F.lit("private")).otherwise(F.lit("public")).alias("prp"),
            to_int(k % 9 + 1).alias("numghosts"),
            F.element_at(F.array(F.lit("web"), F.lit("secure"), F.lit("other")), (k % 3 + 1).cast("int")).alias("network"),
            to_int(F.abs("s_acctbal") * 10).alias("peak_bitcap_mbps"), to_int(F.abs("s_acctbal") * 5).alias("peak_flitcap_mfps"),
            to_int(k % 100).alias("numvips"))
        days = F.array(*[F.lit(d) for d in REGION_DAYS])
        return rows.withColumn("day", F.explode(days)).where((F.col("day") == REGION_DAYS[1]) | (F.col("region") % 3 != 0))

    def region_of(self, user: Column) -> Column:
        """Users dealt out over all suppliers."""
        low, high = self.table("supplier").agg(F.min("s_suppkey"), F.max("s_suppkey")).first()
        return user % F.lit(high - low + 1) + F.lit(low)

    def region_sample(self) -> DataFrame:
        # Binary fractions, so that sums and means do not depend on the order of addition.
        u, v, t = F.col("user_id"), F.col("value"), epoch("ts")
        w = (v * 100).cast("long").cast("double")
        return self.table("events").select(
            to_int(u % 5).alias("maprule"), F.col("event_type").alias("geoname"),
            F.when(u % 2 == 0, F.lit("ANY")).otherwise(F.lit("N1")).alias("netname"), self.region_of(u).alias("region"),
            (w / 128).alias("score"), to_int(v).alias("nsd_demand"), to_int(v * 2).alias("eu_demand"), (v * 100).cast("long").alias("ra_load"),
            (w / 1024).alias("case_percent_pre_norm_load"), (w / 512).alias("case_percent_load"),
            (w / 2048).alias("recorded_load_percentage"), F.date_format("ts", "yyyyMMdd").alias("datestamp"),
            F.date_format("ts", "HH").alias("hour"), (t - t % 600).alias("ts"))

    def score_targets(self) -> DataFrame:
        u = F.col("user_id")
        return self.table("events").select(
            to_int(u % 5).alias("maprule"), F.col("event_type").alias("geoname"),
            F.when(u % 2 == 0, F.lit("ANY")).otherwise(F.lit("N1")).alias("netname"), to_int("value").alias("targetvalue"))

    # -- assignment -----------------------------------------------------------------------------
    def assignment_log(self) -> DataFrame:
        """Numbers are cut to what is used before the join moves them."""
        li, o = self.table("lineitem"), self.table("orders")
        li = li.select("l_orderkey", "l_suppkey", "l_linenumber", to_int("l_quantity").alias("cnt"), to_int("l_extendedprice").alias("min_s"),
                       to_int(F.col("l_partkey") % 300).alias("min_r"))
        o = o.select("o_orderkey", "o_custkey", epoch("o_orderdate").alias("ts"))
        return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
            F.col("o_custkey").alias("mpgid"), to_int(F.col("l_suppkey") % 4).alias("mrid"), F.lit("NS").alias("mpg_type"),
            F.col("l_suppkey").alias("region"), F.col("l_linenumber").alias("link"), "cnt",
            "min_s", (F.col("min_s") + 100).alias("max_s"), "min_r", (F.col("min_r") + 1).alias("max_r"), F.lit(600.0).alias("dftime"),
            F.when(F.col("o_custkey") % 2 == 0, F.lit("u0")).otherwise(F.lit("u1")).alias("mpd_uuid"), "ts")

    def clients(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.customers().join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            k.alias("mpgid"), F.concat(F.lit("ns"), k.cast("string")).alias("nsip"), F.abs("c_acctbal").alias("ns_demand"),
            to_int(k % 20).alias("ns_asnum"), F.col("n_name").alias("ns_country"), F.col("r_name").alias("ns_continent"),
            (((k * 37) % 1200).cast("double") / 10 - 60).alias("ns_lat"),
            (((k * 91) % 3600).cast("double") / 10 - 180).alias("ns_lon"), F.abs("c_acctbal").alias("mpg_load"))

    def networks(self) -> DataFrame:
        """AS numbers of named networks, from the clients."""
        k = F.col("c_custkey")
        return self.table("customer").select(to_int(k % 20).alias("asnum"), F.col("c_mktsegment").alias("netname")).distinct()

    # -- client groups and probes ---------------------------------------------------------------
    def client_groups(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.customers().select(
            k.alias("mpgid"), (((k * 37) % 1200).cast("double") / 10 - 60).alias("lat"),
            (((k * 91) % 3600).cast("double") / 10 - 180).alias("lon"), F.col("n_name").alias("country"),
            F.abs("c_acctbal").alias("load"), to_int(k % 20).alias("asnum"))

    def allowed_regions(self) -> DataFrame:
        """Regions that a group may use: the suppliers of its own orders, a list bounded by the supplier dimension."""
        li, o = self.table("lineitem"), self.table("orders")
        return li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy(F.col("o_custkey").alias("mpgid")).agg(
            F.array_sort(F.collect_set("l_suppkey")).alias("allowed"))

    def near_groups(self) -> DataFrame:
        """Client groups placed a short way from one of the regions they may use."""
        g, k = self.client_groups().drop("lat", "lon").join(self.allowed_regions(), "mpgid"), F.col("mpgid")
        anchor = F.get("allowed", (k % F.size("allowed")).cast("int"))
        return g.withColumns({
            "lat": ((anchor * 37) % 1200).cast("double") / 10 - 60 + (k % 7).cast("double") / 10,
            "lon": ((anchor * 91) % 3600).cast("double") / 10 - 180 + (k % 11).cast("double") / 10})

    def addresses(self) -> DataFrame:
        """Name servers of the client groups, from their orders; some groups have none."""
        rows = self.table("orders").where(F.col("o_custkey") % 10 != 0)
        return rows.select(F.col("o_custkey").alias("mpgid"), F.concat(F.lit("ns"), (F.col("o_orderkey") % 997).cast("string")).alias("nsip")).distinct()

    def allow_list(self) -> DataFrame:
        """Rules and the regions they may use, from the parts they have carried."""
        return self.table("lineitem").select(to_int(F.col("l_partkey") % 6).alias("maprule"), F.col("l_suppkey").alias("region")).distinct()

    def probes(self) -> DataFrame:
        return self.table("lineitem").select(
            to_int(F.col("l_partkey") % 50).alias("ppip"), F.col("l_suppkey").alias("region"),
            (F.col("l_quantity") * 10).alias("distance"), (F.col("l_extendedprice") / 10).alias("latency"),
            (F.col("l_discount") * 100).alias("loss"), F.col("l_returnflag").alias("pp_state"))

    # -- coverage, members, plan ----------------------------------------------------------------
    def coverage(self, newest: bool = False) -> DataFrame:
        """Coverage per month; with `newest` of the newest month, whose bound reaches the scan of the orders."""
        o, c = self.table("orders"), self.customers()
        if newest:
            last = o.agg(F.date_trunc("month", F.max("o_orderdate")).cast("timestamp").alias("m")).select(F.unix_timestamp("m")).first()[0]
            o = o if last is None else o.where(at_least(o, "o_orderdate", last))
        k = F.col("c_custkey")
        frac = lambda n: F.avg((k % n).cast("double") / n)
        return o.join(c, o["o_custkey"] == k).groupBy(
            F.date_format("o_orderdate", "yyyyMM").alias("day"), F.col("n_name").alias("country"), to_int(k % 20).alias("asnum")).agg(
            F.sum("o_totalprice").alias("sum_demand"), frac(7).alias("in_country_pct"), frac(9).alias("in_asn_pct"),
            frac(5).alias("weighted_distance"), F.when(F.col("n_name") == "NATION_3", F.lit(0.0)).otherwise(frac(11)).alias("has_pp_pct"),
            frac(13).alias("in_provider_pct"))

    def members(self) -> DataFrame:
        """Distinct (network, AS number) pairs."""
        return self.table("events").select(F.col("event_type").alias("name"), to_int("user_id").alias("asnum")).distinct()

    def plan(self) -> DataFrame:
        """Planned load and score per case and month."""
        month = F.date_format(F.timestamp_seconds("ts"), "yyyyMM").cast("int")
        return self.line_cases().groupBy("maprule", "geoname", "netname", month.alias("month")).agg(
            F.sum("q").cast("double").alias("load"), F.max(F.col("q") + F.col("maprule")).cast("double").alias("score"),
            F.when(F.max("d") > 9, F.lit(10000)).otherwise(F.lit(30)).alias("score_target"))
