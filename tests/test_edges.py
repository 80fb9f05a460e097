"""Hand-made rows for the cases where the semantics are easy to get wrong."""

import math

import pytest
from pyspark.sql import functions as F

from casegauge.functions import geo as G, metrics as M, text as X
from casegauge.functions.stats import correlation_p_value
from casegauge.operators import assignment as A, clusters as C, joins as J, summary as S
from casegauge.operators.assignment import assignment_stats, client_entropy, duration_share
from casegauge.operators.lists import explode_list, joined_lists
from casegauge.operators.quantiles import percentile_array
from casegauge.operators.ratios import violation_share
from casegauge.operators.regression import distance_latency_stats
from casegauge.operators.topn import top_n_shares
from casegauge.sources import snapshots as P


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_percentile_is_interpolated_then_truncated(spark):
    df = spark.range(1, 11).select(F.col("id").cast("int").alias("v"))
    p = df.agg(percentile_array("v", [0.9584]).alias("p")).first().p[0]
    assert p == pytest.approx(9.6256)
    s = df.select(F.lit(1).alias("maprule"), F.lit("A").alias("geoname"), F.lit("n").alias("netname"), F.col("v").alias("sp95"), F.lit(4).alias("star"))
    row = S.case_summary(s, [S.score_metric("95")]).first()
    assert (row.sp95_t95, row.sp95_t50) == (9, 5)
    assert (row.sp95d_area, row.sp95d_max, row.sp95d_freq) == (21, 6, 6)
    assert row.avg_sp95d == round(21 / 10 / 4 * 100, 2)


def test_hinges_and_nulls(spark):
    r = one(spark, at=M.excess_over(F.lit(5), F.lit(5)), below=M.excess_over(F.lit(4), F.lit(5)), above=M.excess_over(F.lit(7), F.lit(5)),
            null=M.excess_over(F.lit(None).cast("int"), F.lit(5)), short=M.shortfall(F.lit(3), F.lit(5)), null2=M.shortfall(F.lit(None).cast("int"), F.lit(5)))
    assert tuple(r) == (0, 0, 2, 0, 2, 0)


def test_window_bounds(spark):
    df = spark.range(0, 5).withColumnRenamed("id", "ts")
    ids = lambda b: [r.ts for r in S.time_window(df, "ts", 1, 3, b).orderBy("ts").collect()]
    assert ids("()") == [2] and ids("[)") == [1, 2] and ids("(]") == [2, 3]
    assert [r.ts for r in S.recent(df, "ts", 4, 2).orderBy("ts").collect()] == [3, 4]


def test_zero_denominators(spark):
    r = one(spark, a=M.guarded_ratio(F.lit(1), F.lit(0), 100, 2), b=M.guarded_ratio(F.lit(1), F.lit(0), 100, 2, None),
            c=M.pct_change(F.lit(5), F.lit(0)), d=M.pct_change(F.lit(15), F.lit(10)), e=M.target_ratio(F.lit(3), F.lit(0)),
            f=M.target_ratio(F.lit(300), F.lit(2)), g=M.change_label(F.lit(15), F.lit(10)))
    assert tuple(r) == (0.0, None, 0, 50, None, 10.0, "15 (50%)")
    rows = [(1, "A", "n", 5, 0, 100, 100)]
    df = spark.createDataFrame(rows, "maprule int, geoname string, netname string, sp95 int, star int, icy_pct int, icy_tar int")
    s = S.case_summary(df, [S.score_metric("95"), S.STANDARD[8]]).first()
    assert s.avg_sp95d is None and s.avg_icyd == 0.0


def test_sanitize(spark):
    r = one(spark, a=M.sanitize_numeric(F.lit(float("inf")), 100), b=M.sanitize_numeric(F.lit(None), 100), c=M.sanitize_numeric(F.lit(float("nan"))),
            d=M.sanitize_numeric(F.lit(1.239), 100))
    assert tuple(r) == (-100, -100, -1, 123)


def test_wildcards(spark):
    t = spark.createDataFrame([(1, "GLOBAL", "ANY"), (1, "US", "ANY"), (1, "GLOBAL", "x"), (1, "", "")], "maprule int, geoname string, netname string")
    c = spark.createDataFrame([(1, "", ""), (1, "US", ""), (1, "US", "x"), (1, "GLOBAL", "ANY")], "mapruleid int, geo string, aslist string")
    got = {(r.geoname, r.netname, r.geo, r.aslist) for r in J.wildcard_join(t, c).collect()}
    assert got == {("GLOBAL", "ANY", "", ""), ("US", "ANY", "US", ""), ("", "", "", ""), ("GLOBAL", "ANY", "GLOBAL", "ANY")}


def test_left_join_miss(spark):
    s = spark.createDataFrame([(1, "A", "n", 10), (2, "A", "n", 10)], "maprule int, geoname string, netname string, ts int")
    io = spark.createDataFrame([(1, "A", "n", 10, 44.5, 40, 90)], "maprule int, geoname string, netname string, ts int, ioratio double, iotarget int, coverage int")
    rows = {r.maprule: (r.ioratio, r.ioratio_tar, r.load_coverage, r.iod) for r in J.with_io_ratio(s, io).collect()}
    assert rows == {1: (45, 40, 90, 5), 2: (-1, -1, -1, -1)}


def test_bit_flags(spark):
    df = spark.range(4).select(M.is_even("id").alias("p"), M.is_local("id").alias("l"))
    assert [tuple(r) for r in df.collect()] == [(1, 0), (0, 0), (1, 1), (0, 1)]
    f = lambda s, r: one(spark, v=M.is_continent_fallback(F.lit(s), F.lit(r))).v
    assert (f(65533, 254), f(65534, 253), f(65534, 254)) == (0, 0, 1)


def series(spark, value, zero_pings=0):
    return spark.range(2016).select(
        F.lit(1).alias("maprule"), F.lit("A").alias("geoname"), F.lit("n").alias("netname"), (F.col("id") * 600).alias("ts"),
        value.alias("sp95"), F.lit(1).alias("star"), F.when(F.col("id") < zero_pings, 0).otherwise(1).alias("ping_bps"))


def test_cycle_strength(spark):
    summary = lambda df: S.case_summary(S.with_basis(df, "ts"), [S.score_metric("95")], cycles=True).first()
    flat = summary(series(spark, F.lit(7)))
    assert (flat.sp95_cw, flat.sp95_cd) == (0.0, 0.0)
    wave = summary(series(spark, (F.lit(1000) + 1000 * F.cos(F.col("id") * 2 * math.pi * 2 / 2016)).cast("int")))
    assert wave.sp95_cw == pytest.approx(0.5, abs=0.001) and wave.sp95_cd == pytest.approx(0.0, abs=0.001)


def test_cycle_is_dropped_above_a_fifth_of_zero_pings(spark):
    value = (F.lit(1000) + 1000 * F.cos(F.col("id") * 2 * math.pi * 2 / 2016)).cast("int")
    five = series(spark, value).where("ts < 600 * 5")
    kept = five.withColumn("ping_bps", F.when(F.col("ts") == 0, 0).otherwise(1))
    dropped = five.withColumn("ping_bps", F.when(F.col("ts") <= 600, 0).otherwise(1))
    strength = lambda df: S.case_summary(S.with_basis(df, "ts"), [S.score_metric("95")], cycles=True).first()
    assert strength(kept).sp95_cw > 0 and strength(kept).zp_ratio == 20.0
    assert strength(dropped).sp95_cw == 0.0


def test_top_n_ties_and_zero_total(spark):
    rows = [("a", i, 10, 1.0) for i in range(40)] + [("z", 1, 0, 0.5), ("z", 2, 0, 0.25)]
    df = spark.createDataFrame(rows, "k string, region int, load int, share double")
    out = top_n_shares(df, ["k"], "load", "share", "region").collect()
    a = sorted((r.rank, r.region, r.cum_share, r.load_ratio, r.max_cum_share) for r in out if r.k == "a")
    assert len(a) == 30 and a[-1] == (30, 29, 30.0, round(100 / 30, 4), 30.0)
    assert {r.load_ratio for r in out if r.k == "z"} == {-1.0}


def test_entropy(spark):
    h = lambda *p: spark.createDataFrame([(x,) for x in p], "p double").agg(M.entropy("p").alias("h")).first().h
    assert h(1.0) == 0.0 and h(0.5, 0.5) == pytest.approx(math.log(2)) and h(0.5, 0.0) == pytest.approx(0.5 * math.log(2))
    assert h(1.0, 0.5) == pytest.approx(0.5 * math.log(2))


def test_distances(spark):
    d = lambda *p: one(spark, v=G.haversine_miles(*[F.lit(float(x)) for x in p])).v
    assert d(10, 20, 10, 20) == 0.0
    assert d(0, 0, 0, 180) == pytest.approx(math.pi * G.EARTH_RADIUS_MILES)
    assert d(0, 179.5, 0, -179.5) == pytest.approx(math.radians(1) * G.EARTH_RADIUS_MILES)
    assert d(90, 0, 90, 123) == pytest.approx(0.0, abs=1e-6)


def test_centroid(spark):
    df = spark.createDataFrame([("a", 10.0, -170.0, 2.0), ("b", 0.0, 179.0, 1.0), ("b", 0.0, -179.0, 1.0), ("c", 1.0, 1.0, 0.00001)],
                               "k string, lat double, lon double, load double")
    rows = {r.k: tuple(r)[1:] for r in C.weighted_centroid(df, ["k"]).collect()}
    assert rows["a"] == (10.0, -170.0, 1.0, 0.0)
    assert abs(rows["b"][1]) == 180.0 and rows["b"][0] == 0.0
    assert "c" not in rows


def clusters(spark):
    groups = [(1, 10.0, 10.0, "X", 1.0, [1, 2]), (2, 10.5, 10.0, "Y", 3.0, [2, 1, 1]), (3, 10.0, 10.0, "X", 1.0, [1])]
    g = spark.createDataFrame(groups, "mpgid int, lat double, lon double, country string, load double, allowed array<int>")
    regions = [(1, 10.0, 10.0, "X", "web", "private", 5000, 5000, 3), (2, 10.0, 10.2, "X", "secure", "private", 4000, 4000, 4),
               (3, -60.0, 10.0, "X", "web", "public", 9000, 9000, 5)]
    r = spark.createDataFrame(regions, "region int, latitude double, longitude double, country string, network string, prp string, "
                                       "peak_bitcap_mbps int, peak_flitcap_mfps int, numvips int")
    serving = C.serving_regions(r, {"web": "W", "secure": "S"})
    return C.group_regions(C.reachable_regions(g, serving)), serving


def test_same_set_in_another_order_merges(spark):
    grouped, serving = clusters(spark)
    c = {r.region_list: r for r in C.attach_public(C.cluster_by_set(grouped), serving).collect()}
    assert set(c) == {"1:2", "1"}
    assert (c["1:2"].nmpg, c["1:2"].load, c["1:2"].geoname, c["1:2"].cap_w, c["1:2"].cap_s, c["1:2"].nvips) == (2, 4.0, "X:Y", 5.0, 4.0, 7)
    # no public region near: kept, with zeros and the marker word
    assert (c["1"].pub_nreg, c["1"].pub_bit_gbps, c["1"].cl_por, c["1"].cl_porsigma) == (0, 0.0, 1.0, 0.0)
    lists = {r.region_list: (r.pub_nreg, r.pub_list) for r in C.public_lists(C.cluster_by_set(grouped), serving).collect()}
    assert lists["1"] == (0, "NULL")


def test_region_criticality(spark):
    grouped, serving = clusters(spark)
    c = C.cluster_by_set(grouped)
    members = explode_list(c, ["region_list"], "region_list", "region").withColumn("region", F.col("region").cast("long"))
    allow = spark.createDataFrame([(7, 1), (7, 2), (8, 1), (9, 99)], "maprule int, region long")
    out = {r.region: r for r in C.region_criticality(c, members, allow, serving.withColumn("region", F.col("region").cast("long"))).collect()}
    # cluster 1:2 -> rule 7 shares 5/9, 4/9; rule 8 share 1 for region 1; cluster 1 -> region 1 alone
    assert out[1].b_ratio == pytest.approx((5 / 9 + 1) / 2 + 1, abs=1e-6)
    assert out[2].b_ratio == pytest.approx(4 / 9 / 2, abs=1e-6)
    assert out[1].dw_b_ratio == pytest.approx(4 * (5 / 9 + 1) / 2 + 1, abs=1e-3)
    none = C.region_criticality(c, members, allow.where("region = 99"), serving).collect()
    assert [(r.region, r.b_ratio, r.clusters) for r in none] == [(0, 2.0, 2)]


def test_criticality_of_rule_groups_and_public_regions(spark):
    c = spark.createDataFrame([("1:2", "A:B", 4.0, 2), ("3", "C", 1.0, 1)], "region_list string, geoname string, load double, nmpg long")
    members = spark.createDataFrame([("1:2", 1), ("1:2", 2), ("1:2", 9), ("1:2", 9), ("3", 3)], "region_list string, region long")  # 9 is public, near
    regions = spark.createDataFrame([(1, 2.0, 1.0, 1), (2, 2.0, 1.0, 1), (3, 5.0, 1.0, 1), (9, 4.0, 0.0, 2)], "region long, bit_gbps double, flit_gfps double, numvips int")
    allow = spark.createDataFrame([(1, 1), (1, 9), (2, 1), (2, 2), (7, 9), (7, 77)], "maprule int, region long")
    out = {(r.rule_group, r.region): r for r in C.region_criticality(c, members, allow, regions, groups={"W": [1, 2]}, others="S").collect()}
    assert set(out) == {("W", 1), ("W", 2), ("W", 9), ("W", 0), ("S", 9), ("S", 0)}
    # rule 1: 2 of 6 and 4 of 6; rule 2: half and half
    assert out["W", 1].b_ratio == pytest.approx((1 / 3 + 1 / 2) / 2, abs=1e-6) and out["W", 9].b_ratio == pytest.approx(1 / 3, abs=1e-6)
    assert out["W", 2].b_ratio == 0.25 and out["W", 2].dw_b_ratio == 1.0 and out["W", 9].f_ratio == 0.0
    assert (out["S", 9].b_ratio, out["S", 9].f_ratio, out["S", 9].geo_list) == (1.0, 0.0, "A:B")
    assert (out["S", 0].clusters, out["W", 0].clusters, out["W", 0].geo_list) == (1, 1, "C")


def test_addresses_of_clusters(spark):
    grouped = spark.createDataFrame([("1:2", 1), ("1:2", 2), ("3", 3), ("4", 4)], "region_list string, mpgid int")
    rows = [(1, f"a{i}") for i in range(7)] + [(2, "a0"), (2, "b"), (4, None), (99, "z")]
    out = {r.region_list: (r.n_nsips, r.first_nsips) for r in C.cluster_addresses(grouped, spark.createDataFrame(rows, "mpgid int, nsip string")).collect()}
    assert out == {"1:2": (8, "a0:a1:a2:a3:a4"), "3": (0, "NULL"), "4": (0, "NULL")}


def test_selected_clients(spark):
    c = spark.createDataFrame([(1, 1.0, 0.0, 0.0), (2, 1.5, 0.0, 0.0), (3, 9.0, None, 0.0), (4, None, 1.0, 1.0)], "mpgid int, ns_demand double, ns_lat double, ns_lon double")
    assert [r.mpgid for r in A.selected_clients(c).collect()] == [2]
    assert sorted(r.mpgid for r in A.selected_clients(c, None).collect()) == [1, 2, 4]


def test_coverage_curve(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.5,)], "load double")
    out = C.coverage_curve(df, F.col("load"), [0.1, 1.0, 2.0, 3.0]).orderBy("threshold").collect()
    assert [(r.threshold, r.clusters, r.load_share) for r in out] == [(0.1, 3, 1.0), (1.0, 2, 0.875), (2.0, 1, 0.625), (3.0, 0, 0.0)]


def test_regression_needs_more_than_ten_points(spark):
    rows = [("ten", float(i), float(2 * i + 1), 1.0) for i in range(10)] + [("eleven", float(i), float(2 * i + 1), 1.0) for i in range(11)]
    rows += [("ten", 1.0, 10000.0, 1.0), ("edge", 1.0, 9999.9, 1.0), ("edge", 1.0, 10000.0, 1.0)]
    df = spark.createDataFrame(rows, "p string, distance double, latency double, loss double")
    out = {r.p: r for r in distance_latency_stats(df, ["p"], p_value=True).collect()}
    assert (out["ten"].n_valid, out["ten"].r, out["ten"].avg_lat, out["ten"].p95_dist, out["ten"].rpv) == (10, 0.0, -1.0, -1.0, 1.0)
    assert (out["eleven"].slope, out["eleven"].intercept, out["eleven"].err, out["eleven"].r) == (2.0, 1.0, 0.0, 1.0)
    assert (out["edge"].n_valid, out["edge"].valid_ratio) == (1, 50.0)


def test_p_value(spark):
    # two-sided p of r over n points; for n = 4 (two degrees of freedom) it is 1 - |r| exactly
    df = spark.createDataFrame([(0.5, 4), (-0.9, 4), (0.0, 30), (1.0, 30), (0.3, 12)], "r double, n long")
    p = [r.p for r in df.select(correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()]
    assert p[0] == pytest.approx(0.5, abs=1e-9) and p[1] == pytest.approx(0.1, abs=1e-9)
    assert p[2] == pytest.approx(1.0, abs=1e-9) and p[3] == pytest.approx(0.0, abs=1e-12)
    t, dof = 0.3 * math.sqrt(10 / (1 - 0.09)), 10
    step, tail = 1e-3, 0.0
    density = lambda u: math.gamma((dof + 1) / 2) / math.sqrt(dof * math.pi) / math.gamma(dof / 2) * (1 + u * u / dof) ** (-(dof + 1) / 2)
    tail = sum(density(t + (i + 0.5) * step) * step for i in range(200000))
    assert p[4] == pytest.approx(2 * tail, abs=1e-5)


def test_lists(spark):
    df = spark.createDataFrame([("a", 0.5, 2), ("a", 0.5, 1), ("a", 0.7, 3)], "k string, s double, r int")
    row = joined_lists(df, ["k"], {"l": F.col("r")}, [-F.col("s"), F.col("r")]).first()
    assert (row.l, row["items"]) == ("3:1:2", 3)
    r = one(spark, e=X.join_list(F.array().cast("array<int>")), t=X.truncate_list(F.lit("1:2:3:4:5:6"), 5), n=X.default_network(F.lit("")))
    assert tuple(r) == ("NULL", "1:2:3:4:5", "ANY")


def test_names(spark):
    parts = X.parse_case_name(F.lit("S.MR_12.GEO_US.x"))
    assert tuple(one(spark, **parts)) == (12, "US")
    assert one(spark, v=X.reference_label(F.lit("a_main.map"), F.lit(7))).v == "main [7]"
    assert one(spark, v=X.short_description(F.lit("a,b" + "c" * 40))).v == "a;b" + "c" * 22


def test_peak(spark):
    f = lambda h, o: one(spark, v=M.peak_flag(F.lit(h), F.lit(o).cast("int"))).v
    assert (f(17, 0), f(18, 0), f(3, -9), f(20, 9), f(12, None)) == (0, 1, 1, 0, 0)


def test_assignment(spark):
    log = [(1, 5, "NS", 10, 1, 3, 2, 102, 1, 2, 600.0, "u", 0), (1, 5, "NS", 11, 1, 1, 3, 103, 1, 2, 600.0, "u", 0), (1, 5, "NS", 10, 1, 1, 2, 102, 1, 2, 600.0, "u", 600)]
    l = spark.createDataFrame(log, "mpgid int, mrid int, mpg_type string, region int, link int, cnt int, min_s int, max_s int, min_r int, max_r int, dftime double, mpd_uuid string, ts int")
    reg = spark.createDataFrame([(10, 1, "EU", "X", 0.0, 0.0, "private", "1"), (11, 2, "EU", "Y", 0.0, 1.0, "public", "1")],
                                "region int, ecor int, continent string, country string, latitude double, longitude double, prp string, day string")
    s = duration_share(l, reg)
    rows = {r.region: r for r in s.collect()}
    assert (rows[10].mpd_dftime, rows[11].mpd_dftime, rows[10].prp, rows[11].prp) == (1050.0, 150.0, 1050.0, 0.0)
    cl = spark.createDataFrame([(1, "ns1", 2.0, 9, "X", "EU", 0.0, 0.0, 1.0)],
                               "mpgid int, nsip string, ns_demand double, ns_asnum int, ns_country string, ns_continent string, ns_lat double, ns_lon double, mpg_load double")
    r = assignment_stats(s, cl).first()
    assert (r.regions, r.region_links, r.dftime_ratio, r.num_region_mapped) == ("10:11", "10_1:11_1", "100.0:14.3", 2)
    assert (r.in_country_ratio, r.in_cont_ratio, r.private_ratio, r.ping_ratio) == (87.5, 100.0, 87.5, 87.5)
    assert r.mapping_entropy == pytest.approx(-(0.143 * math.log(0.143)), abs=1e-6)
    p = 150 / 1200
    assert client_entropy(s, cl, normalise=True).first().mapping_entropy == pytest.approx(-(p * math.log(p) + (1 - p) * math.log(1 - p)), abs=1e-6)


def test_violation_zero_weight(spark):
    names = "score95_q95 score95_med score_tar dis95_q95 dis95_med dis_tar ict_q05 ict_med ict_tar icy_q05 icy_med icy_tar ioratio_q95 ioratio_med ioratio_tar".split()
    df = spark.createDataFrame([("A", 1, 0) + (5,) * 15], "geo string, rule int, w int, " + ", ".join(f"{n} int" for n in names))
    out = violation_share(df, "w", [["geo"], ["geo", "rule"]], ["geo", "rule"])
    assert out.count() == 2 and {r.scr95fw for r in out.collect()} == {None} and {r.scr95f for r in out.collect()} == {0.0}
    assert violation_share(df, "w", [["geo"]], ["geo", "rule"], positive_load_only=True).count() == 0


def test_snapshots(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-08",), ("2024-01-09",), ("2024-01-20",), ("2024-01-21",)], "d string").select(F.to_date("d").alias("d"))
    kept = [str(r.d) for r in P.thin_snapshots(days, "d", "2024-01-27").orderBy("d").collect()]
    assert kept == ["2024-01-01", "2024-01-08", "2024-01-20", "2024-01-21"]
    t = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "a")], "ts int, v string")
    assert {r.ts for r in P.last_good_snapshot(t, "ts", 1).collect()} == {2}
    assert P.asof_partition(t, "ts", 3).first().ts == 3 and P.asof_partition(t, "ts", 3, strict=True).first().ts == 2
    assert {r.ts for r in P.retain(t, "ts", 5, 3).collect()} == {2, 3} and {r.ts for r in P.retain(t, "ts", 5, 3, inclusive=False).collect()} == {3}
    assert [r.ts for r in P.latest_partition(t, "ts").collect()] == [3]
    hours = spark.createDataFrame([(0,), (7200,)], "h long")
    assert [r.h for r in P.missing_partitions(hours.withColumn("k", F.lit(1)), ["k"], "h", 3600).collect()] == [3600]
    assert sorted(r.h for r in P.last_hours(hours, "h", 10900, hours=3).collect()) == [3600]


def test_summaries_keep_null_groups_and_null_keys(spark):
    """A case without loads, and rows without a case, have their row in the result."""
    df = spark.createDataFrame([(1, "A", "n", None, 5, 7), (2, "A", "n", 100, 5, 7), (None, "A", "n", 50, 5, 7), (None, "A", "n", 150, 5, 9)],
                               "maprule int, geoname string, netname string, total_bps long, ping_bps long, p2t_bps_pct int")
    got = {r.maprule: (r.peak95_kbps, r.p2t_bps_pct_min) for r in S.load_stats(df).collect()}
    assert got == {1: (None, 7), 2: (100.0, 7), None: (145.0, 7)}
    io = df.selectExpr("maprule", "geoname", "netname", "total_bps ra_load", "cast(total_bps as double) io", "cast(ping_bps as double) cpu")
    rows = {r.maprule: (r.ra_load_t95, r.case_count) for r in S.io_rollup_summary(io, counters=["ra_load"], ratios=["io"], mixed=["cpu"]).collect()}
    assert rows == {1: (None, 1), 2: (100, 1), None: (145, 2)}


def test_clients_listed_twice_and_null_rules(spark):
    """A repeated client counts its assignments twice; a null rule and a null type are groups of their own."""
    row = lambda rule, region, d, kind="NS": ("u", 1, rule, kind, region, 1, 2 * d, 3 * d, d, d, d, 0.0, 0.0, d, 1, "EU", "X", 0.0, 0.0, d)
    s = spark.createDataFrame([row(5, 10, 600.0), row(5, 11, 300.0), row(None, 10, 600.0, None)],
                              "mpd_uuid string, mpgid int, mrid int, mpg_type string, region int, link int, min_s double, max_s double, min_r double, max_r double, ping double, "
                              "local double, cont_fb double, mpd_dftime double, ecor int, continent string, country string, latitude double, longitude double, prp double")
    cl = "mpgid int, nsip string, ns_demand double, ns_asnum int, ns_country string, ns_continent string, ns_lat double, ns_lon double, mpg_load double"
    client = (1, "a", 2.0, 9, "X", "AS", 0.0, 1.0, None)
    got = lambda rows, **o: {(r.nsip, r.mrid): r for r in assignment_stats(s, spark.createDataFrame(rows, cl), **o).collect()}
    twice = got([client, client, (1, None, *client[2:])])
    assert set(twice) == {("a", 5), ("a", None), (None, 5), (None, None)}
    assert (twice["a", 5].regions, twice["a", 5].num_region_mapped, twice["a", 5].sum_dftime, twice["a", 5].listed) == ("10:10:11:11", 4, 1800.0, 4)
    assert (twice[None, 5].regions, twice[None, 5].in_country_ratio, twice[None, 5].in_cont_ratio, twice[None, 5].avg_min_s) == ("10:11", 100.0, 0.0, 2.0)
    assert twice["a", 5].mapping_entropy == pytest.approx(2 * twice[None, 5].mapping_entropy, abs=2e-6) and twice["a", 5].avg_distance == pytest.approx(69.17, abs=0.01)
    normal = lambda ps: -sum(p * math.log(p) for p in ps)
    assert got([client, client], normalise_entropy=True)["a", 5].mapping_entropy == pytest.approx(normal([1 / 3, 1 / 3, 1 / 6, 1 / 6]), abs=1e-6)
