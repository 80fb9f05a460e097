"""Summaries per case: percentiles, deficits, cycles, load."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegauge import CASE
from casegauge.functions.metrics import complement_pct, excess_over, guarded_ratio, shortfall
from casegauge.operators import summary as S
from casegauge.operators.joins import baseline_join, baseline_pivot, period_compare
from casegauge.operators.quantiles import ranked_percentiles
from casegauge.operators.ratios import (clean_summary, deficiency_total, fresh_rows, severity, target_profile,
                                        violation_share)
from casegauge.operators.rolling import rolling_summary
from casegauge.plans.inputs import Inputs
from casegauge.plans.inputs_sql import percentile, rounded, with_inputs
from casegauge.plans.registry import query

KEYS = "maprule, geoname, netname"
YEAR_START, YEAR_END = 915148800, 946684800  # 1999-01-01, 2000-01-01
NOW = 1041379200  # 2003-01-01


def sample(x: Inputs):
    return x.case_sample()


def metric_sql(m: S.Metric) -> list[str]:
    d = f"greatest({m.target} - {m.value}, 0)" if m.low_is_bad else f"greatest({m.value} - {m.target}, 0)"
    out = [f"cast(trunc({percentile(m.value, p)}) as int) {m.name}_{t}" for t, p in m.probs.items()]
    area, tar = f"cast(sum({d}) as bigint)", f"{m.target_agg}({m.target})"
    out += [f"{area} {m.name}d_area", f"max({d}) {m.name}d_max",
            f"cast(count(*) filter ({d} > 0) as bigint) {m.name}d_freq"]
    if m.low_is_bad:
        mean = f"100.0::double*{area}/nullif(count(*)*(100-{tar}), 0)"
    else:
        mean = f"cast({area} as double)/count(*)/nullif({tar}, 0)*100"
    out.append(f"case when sum({d}) > 0 then {rounded(mean, 2)} else 0.0::double end avg_{m.name}d")
    return out


def cycle_sql(m: S.Metric) -> list[str]:
    out = []
    for b, label in ((2, "cw"), (14, "cd")):
        v = f"cast({m.value} as double)"
        c = (f"case when sum({v}) > 0 then sqrt(pow(sum({v}*cos{b}), 2) + pow(sum({v}*sin{b}), 2))/sum({v}) else 0 end")
        if m.damped_by_ping:
            c = f"case when count(*) filter (ping_bps < 1)/cast(count(*) as double) > 0.2 then 0 else {c} end"
        out.append(f"{rounded(f'({c})*{m.cycle_scale}', m.cycle_digits)} {m.name}_{label}")
    return out


def summary_sql(metrics, keys=KEYS, cycles=False) -> str:
    cols = [c for m in metrics for c in metric_sql(m) + (cycle_sql(m) if cycles else [])]
    targets = {m.target_name: f"{m.target_agg}({m.target}) {m.target_name}" for m in metrics}
    if cycles:
        cols += ["cast(count(*) filter (ping_bps < 1) as bigint) zero_ping_count",
                 rounded("cast(count(*) filter (ping_bps < 1) as double)/count(*)*100", 2) + " zp_ratio"]
    return f"select {keys}, {', '.join(cols)}, {', '.join(targets.values())}, count(*) n_count from sample group by {keys}"


SAMPLE = {"sample": "select * from case_sample"}
BASIS = {**SAMPLE, "basis": """select ts, slot, cos(-2*pi()*2*(slot-1)/2016) cos2, sin(-2*pi()*2*(slot-1)/2016) sin2,
    cos(-2*pi()*14*(slot-1)/2016) cos14, sin(-2*pi()*14*(slot-1)/2016) sin14
    from (select ts, row_number() over (order by ts) slot from (select distinct ts from sample))"""}
SUMMARY = {**SAMPLE, "summary": summary_sql(S.STANDARD)}


def with_sample(body, extra=None):
    return with_inputs("case_sample", body, {**SAMPLE, **(extra or {})})


def with_summary(body, extra=None):
    return with_inputs("case_sample", body, {**SUMMARY, **(extra or {})})


@query("case_summary", with_sample(summary_sql(S.STANDARD)))
def _(x):
    return S.case_summary(sample(x))


@query("case_summary_cycles", with_inputs("case_sample", summary_sql(S.STANDARD, cycles=True).replace(
    "from sample group", "from sample join basis using (ts) group"), BASIS))
def _(x):
    return S.case_summary(S.with_basis(sample(x), "ts"), cycles=True)


@query("case_summary_io", with_inputs("case_sample", summary_sql(S.WITH_IO, cycles=True).replace(
    "from sample group", "from sample join basis using (ts) group"), BASIS))
def _(x):
    return S.case_summary(S.with_basis(sample(x), "ts"), S.WITH_IO, cycles=True)


@query("time_slots", with_inputs("case_sample", f"""select ts, cast(slot as int) slot, {rounded('cos2', 6)} cos2, {rounded('sin2', 6)} sin2,
    {rounded('cos14', 6)} cos14, {rounded('sin14', 6)} sin14 from basis""", BASIS))
def _(x):
    b = S.slot_numbers(sample(x), "ts").select("ts", "slot", *S.fourier_basis())
    return b.select("ts", "slot", *[F.round(c, 6).alias(c) for c in ("cos2", "sin2", "cos14", "sin14")])


@query("load_stats", with_sample(f"""select {KEYS}, {rounded(percentile('total_bps', 0.95), 4)} peak95_kbps,
    {rounded('cast(sum(ping_bps) as double)/1024/1024', 4)} ping_mbps, min(p2t_bps_pct) p2t_bps_pct_min from sample group by {KEYS}"""))
def _(x):
    return S.load_stats(sample(x))


@query("price_percentiles", f"""select l_returnflag, {rounded(percentile('l_extendedprice', 0.05), 4)} p05,
    {rounded(percentile('l_extendedprice', 0.5), 4)} p50, {rounded(percentile('l_extendedprice', 0.9584), 4)} p9584
    from lineitem group by l_returnflag""")
def _(x):
    p = ranked_percentiles(x.table("lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.9584], ["p05", "p50", "p9584"])
    return p.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("p05", "p50", "p9584")])


@query("average_load", with_sample(
    f"select {KEYS}, {rounded('8.0::double*cast(sum(total_bps) as double)/count(*)', 3)} stat_bps from sample group by {KEYS}"))
def _(x):
    return S.average_load(sample(x))


NARROW = (S.score_metric("95"), S.STANDARD[8])


def rolling_sql(days, step=1):
    body = summary_sql(NARROW, KEYS + ", window_end")
    return with_inputs("case_sample", body, {"sample": f"""
        select *, unnest(range(cast(floor(ts/{step * 86400}.0) as bigint)*{step * 86400} + {step * 86400},
                               cast(floor(ts/{step * 86400}.0) as bigint)*{step * 86400} + {days * 86400} + 1, {step * 86400})) window_end
        from case_sample"""})


@query("summary_1d", rolling_sql(1))
def _(x):
    return rolling_summary(x.case_sample(), "ts", 1, NARROW)


@query("summary_3d", rolling_sql(3))
def _(x):
    return rolling_summary(x.case_sample(), "ts", 3, NARROW)


@query("summary_14d", rolling_sql(14, 7))
def _(x):
    return rolling_summary(x.case_sample(), "ts", 14, NARROW, step_days=7)


@query("summary_at_period", with_inputs("case_sample", summary_sql(S.STANDARD), {
    "sample": f"select * from case_sample where ts >= {YEAR_START} and ts < {YEAR_END}"}))
def _(x):
    return S.case_summary(x.case_sample((YEAR_START, YEAR_END, "[)")))


@query("recent_samples", with_inputs("case_sample", f"select * from case_sample where ts > {YEAR_END} - 31536000 and ts < {NOW}"))
def _(x):
    return x.case_sample((YEAR_END - 31536000, NOW, "()"))


@query("window_samples", with_inputs("case_sample", f"select * from case_sample where ts > {YEAR_START} and ts < {YEAR_END}"))
def _(x):
    return x.case_sample((YEAR_START, YEAR_END, "()"))


@query("recent_events", "select event_id, event_type, user_id from events where ts > timestamp '2024-01-29 00:00:00' - interval 5 minute")
def _(x):
    return S.recent(x.table("events"), "ts", 1706486400).select("event_id", "event_type", "user_id")


@query("deficits", with_inputs("case_sample", f"""select {KEYS}, ts, greatest(sp95 - star, 0) sp95d, greatest(dp95 - dtar, 0) dp95d,
    greatest(icy_tar - icy_pct, 0) icyd, greatest(ict_tar - ict_pct, 0) ictd, 100 - icy_pct ocy_pct, 100 - ict_pct oct_pct,
    case when total_bps > 0 then {rounded('100.0::double*ping_bps/total_bps', 2)} else 0 end ping_pct,
    case when dp75 > 0 then {rounded('cast(dp95 as double)/dp75', 3)} end dp_spread from case_sample"""))
def _(x):
    return x.case_sample().select(
        *CASE, "ts", excess_over("sp95", "star").alias("sp95d"), excess_over("dp95", "dtar").alias("dp95d"),
        shortfall("icy_pct", "icy_tar").alias("icyd"), shortfall("ict_pct", "ict_tar").alias("ictd"),
        complement_pct("icy_pct").alias("ocy_pct"), complement_pct("ict_pct").alias("oct_pct"),
        guarded_ratio("ping_bps", "total_bps", 100, 2).alias("ping_pct"),
        guarded_ratio("dp95", "dp75", 1, 3, None).alias("dp_spread"))


# -- periods and baselines ------------------------------------------------------------------------
COMPARED = ("sp95_t95", "sp95_t90", "dp95_t95", "icy_t95", "n_count")


def year_of(x, year_start):
    return S.case_summary(x.case_sample((year_start, year_start + 365 * 86400, "[)")))


@query("period_compare", with_inputs("case_sample", f"""select {KEYS}, {', '.join(f'a.{v}, b.{v} {v}_1y' for v in COMPARED)}
    from now_ a join before_ b using ({KEYS})""", {
        "now_": summary_sql(S.STANDARD).replace("from sample", f"from (select * from case_sample where ts >= {YEAR_START} and ts < {YEAR_START + 365 * 86400})"),
        "before_": summary_sql(S.STANDARD).replace("from sample", f"from (select * from case_sample where ts >= {YEAR_START - 365 * 86400} and ts < {YEAR_START})")}))
def _(x):
    return period_compare(year_of(x, YEAR_START), year_of(x, YEAR_START - 365 * 86400), CASE, COMPARED, "_1y")


DEFICITS = ("avg_sp95d", "avg_dp95d", "avg_icyd", "avg_ictd")
BASELINES = {"g": 0, "d": 1, "b": 2}
TARGETS = ("star", "dtar", "icy_tar", "ict_tar")


@query("baseline_levels", with_summary(f"""select s.maprule, s.geoname, s.netname, {', '.join(f's.{v}' for v in (*DEFICITS, *TARGETS))},
    {', '.join(f'{k}.{v} {k}_{v}' for v in DEFICITS for k in BASELINES)} from summary s
    {' '.join(f'join (select * from summary where maprule = {r}) {k} on s.geoname = {k}.geoname and s.netname = {k}.netname' for k, r in BASELINES.items())}
    where s.avg_sp95d > 0 or s.avg_dp95d > 0 or s.avg_icyd > 0 or s.avg_ictd > 0"""))
def _(x):
    s = S.case_summary(sample(x)).select(*CASE, *DEFICITS, *TARGETS)
    return baseline_join(s, BASELINES, DEFICITS)


PIVOTED = {"sp95d_area": "sp95", "dp95d_area": "dp95", "icyd_area": "icy"}


@query("baseline_pivot", with_summary("select geoname, netname, " + ", ".join(
    [f"cast(sum(case when maprule = {r} then {v} else 0 end) as bigint) {k}{n}" for v, n in PIVOTED.items() for k, r in BASELINES.items()]
    + [f"cast(sum(case when maprule not in (0, 1, 2) then {v} else 0 end) as bigint) v{n}" for v, n in PIVOTED.items()])
    + " from summary group by geoname, netname"))
def _(x):
    return baseline_pivot(S.case_summary(sample(x)), BASELINES, PIVOTED, ["geoname", "netname"])


# -- reports over the summary ---------------------------------------------------------------------
@query("deficiency_total", with_summary(
    f"select {KEYS}, {', '.join(DEFICITS)}, {rounded('avg_sp95d + avg_dp95d + avg_icyd + avg_ictd', 2)} deficiency from summary"))
def _(x):
    return deficiency_total(S.case_summary(sample(x)))


SWAPPED = ("NATION_1", "NATION_4", "NATION_7", "NATION_11", "NATION_19")
SEV = "1 - exp(-({0})*ln(2.0::double)/100)"


@query("severity_index", with_summary(f"""select {KEYS}, {rounded(SEV.format('avg_sp95d'), 6)} sev_score,
    {rounded(SEV.format('avg_dp95d'), 6)} sev_distance,
    {rounded(SEV.format(f'case when geoname in {SWAPPED} then avg_ictd else avg_icyd end'), 6)} sev_geo,
    case when geoname in {SWAPPED} then ict_tar else icy_tar end geo_target from summary"""))
def _(x):
    return severity(S.case_summary(sample(x)), SWAPPED)


def capped(a, b):
    return f"least(10.0::double, {rounded(f'cast({a} as double)/{b}', 2)})"


@query("target_profile", with_inputs("case_sample", f"""select {KEYS}, {capped('sp95_t95', 'star')} score_hi, {capped('sp95_t50', 'star')} score_med,
    {capped('dp95_t95', 'dtar')} dist_hi, {capped('dp95_t50', 'dtar')} dist_med,
    {capped('(100 - icy_t95)', '(100 - icy_tar)')} ocy_hi, {capped('(100 - icy_t50)', '(100 - icy_tar)')} ocy_med,
    {capped('(100 - ict_t95)', '(100 - ict_tar)')} oct_hi, {capped('(100 - ict_t50)', '(100 - ict_tar)')} oct_med,
    {capped('(1 - (ping_mbps + 0.001::double)/(total_mbps + 0.001::double))', '0.05::double')} nonping,
    {capped('p2t_bps_pct_min', '9500.0::double')} ping_share
    from summary join (select {KEYS}, {rounded('cast(sum(ping_bps) as double)/1024/1024', 4)} ping_mbps,
      {rounded('cast(sum(total_bps) as double)/1024/1024', 4)} total_mbps, min(p2t_bps_pct) p2t_bps_pct_min from sample group by {KEYS}) using ({KEYS})""", SUMMARY))
def _(x):
    mega = lambda c: F.round(F.sum(c).cast("double") / 1024 / 1024, 4)
    w = sample(x)
    load = w.groupBy(*CASE).agg(mega("ping_bps").alias("ping_mbps"), mega("total_bps").alias("total_mbps"),
                                F.min("p2t_bps_pct").alias("p2t_bps_pct_min"))
    return target_profile(S.case_summary(w).join(load, list(CASE)))


@query("clean_summary", with_summary("""select * exclude (geoname, sp99_t95, n_count, avg_sp99d), 'N' || right(geoname, 1) geoname,
    coalesce(nullif(avg_sp99d, 0), 0) avg_sp99d from summary where length(geoname) = 8 and maprule > 0"""))
def _(x):
    s = S.case_summary(sample(x))
    code = F.when(F.length("geoname") == 8, F.concat(F.lit("N"), F.substring("geoname", -1, 1))).otherwise(F.col("geoname"))
    s = s.withColumns({"geoname": code, "avg_sp99d": F.when(F.col("avg_sp99d") != 0, F.col("avg_sp99d"))})
    return clean_summary(s, ["sp99_t95", "n_count"])


VIOLATION_INPUT = """
    select geoname, maprule, netname, star score_tar, dtar dis_tar, icy_tar, ict_tar, io_tar ioratio_tar, sp95_t95 score95_q95, sp95_t50 score95_med,
           dp95_t95 dis95_q95, dp95_t50 dis95_med, ict_t95 ict_q05, ict_t50 ict_med, icy_t95 icy_q05, icy_t50 icy_med, io_t95 ioratio_q95,
           io_t50 ioratio_med, n_count - 5 tbps_med, '2003-01-01' enddate from summary"""
FLAGS = {"scr95": "score95_q95 > score_tar", "scr50": "score95_med > score_tar", "dis95": "dis95_q95 > dis_tar", "dis50": "dis95_med > dis_tar",
         "ict05": "ict_q05 < ict_tar", "ict50": "ict_med < ict_tar", "icy05": "icy_q05 < icy_tar", "icy50": "icy_med < icy_tar",
         "ior95": "ioratio_q95 > ioratio_tar", "ior50": "ioratio_med > ioratio_tar"}


def violation_sql(where=""):
    flag = lambda c: f"case when {c} then 1 else 0 end"
    cols = [f"{rounded(f'avg({flag(c)})', 2)} {n}f" for n, c in FLAGS.items()]
    cols += [f"{rounded(f'cast(sum({flag(c)}*tbps_med) as double)/nullif(sum(tbps_med), 0)', 2)} {n}fw" for n, c in FLAGS.items()]
    return with_inputs("case_sample", f"select geoname, maprule, {', '.join(cols)} from v {where} group by grouping sets ((geoname), (geoname, maprule))",
                       {**SAMPLE, "summary": summary_sql(S.WITH_IO), "v": VIOLATION_INPUT})


def violation_input(x):
    names = {"score_tar": "star", "dis_tar": "dtar", "icy_tar": "icy_tar", "ict_tar": "ict_tar", "ioratio_tar": "io_tar",
             "score95_q95": "sp95_t95", "score95_med": "sp95_t50", "dis95_q95": "dp95_t95", "dis95_med": "dp95_t50",
             "ict_q05": "ict_t95", "ict_med": "ict_t50", "icy_q05": "icy_t95", "icy_med": "icy_t50",
             "ioratio_q95": "io_t95", "ioratio_med": "io_t50"}
    s = S.case_summary(sample(x), S.WITH_IO)
    rows = s.select("geoname", "maprule", "netname", *[F.col(v).alias(k) for k, v in names.items()],
                    (F.col("n_count") - 5).alias("tbps_med"), F.lit("2003-01-01").alias("enddate"))
    return fresh_rows(rows, NOW)


@query("violation_share", violation_sql())
def _(x):
    return violation_share(violation_input(x), "tbps_med", [["geoname"], ["geoname", "maprule"]], ["geoname", "maprule"])


@query("violation_share_loaded", violation_sql("where tbps_med > 0"))
def _(x):
    return violation_share(violation_input(x), "tbps_med", [["geoname"], ["geoname", "maprule"]], ["geoname", "maprule"], True)
