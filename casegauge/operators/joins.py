"""Joins between samples, targets, dimensions and past periods.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is below
`spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles, splitting skewed partitions
(`spark.sql.adaptive.skewJoin`)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casegauge import CASE
from casegauge.functions.geo import grid_cell, grid_edge, haversine_miles, neighbour_cells
from casegauge.functions.metrics import as_col, excess_over, shortfall
from casegauge.operators.quantiles import null_safe_join
from casegauge.operators.spread import split_join, with_totals
from casegauge.sources.tables import stored

GLOBAL, ANY = "GLOBAL", "ANY"


def sample_join(score: DataFrame, distance: DataFrame, in_country: DataFrame, in_continent: DataFrame,
                load: DataFrame, on: Sequence[str] = (*CASE, "ts")) -> DataFrame:
    """The wide sample: metrics and deficits of five feeds that all know the case at that time."""
    on = list(on)
    levels = ("99", "95", "90", "75")

    def targets(df, prefix, target):
        return df.select(*on, *[F.col(f"p{x}").alias(f"{prefix}{x}") for x in levels],
                         F.col("targetvalue").alias(target),
                         *[excess_over(f"p{x}", "targetvalue").alias(f"{prefix}{x}d") for x in levels])

    def share(df, value, out, target, deficit):
        return df.select(*on, F.col(value).alias(out), F.col("targetvalue").alias(target),
                         shortfall(value, "targetvalue").alias(deficit))

    parts = [targets(score, "sp", "star"), targets(distance, "dp", "dtar"),
             share(in_country, "in_country_pct", "icy_pct", "icy_tar", "icyd"),
             share(in_continent, "in_continent_pct", "ict_pct", "ict_tar", "ictd"),
             load.select(*on, "total_bps", "ping_bps", "p2t_bps_pct")]
    return reduce(lambda a, b: a.join(b, on), parts)


def with_io_ratio(sample: DataFrame, io: DataFrame, on: Sequence[str] = (*CASE, "ts"), missing: int = -1) -> DataFrame:
    """Left join of the in/out ratio feed; cases without one get `missing`."""
    on = list(on)
    feed = io.select(*on, F.round("ioratio").cast("int").alias("ioratio"), F.col("iotarget").alias("ioratio_tar"),
                     F.col("coverage").alias("load_coverage"))
    feed = feed.withColumn("iod", excess_over("ioratio", "ioratio_tar"))
    names = ["ioratio", "ioratio_tar", "load_coverage", "iod"]
    return sample.join(feed, on, "left").na.fill(missing, subset=names)


def expand_wildcards(targets: DataFrame, wildcards: dict[str, str]) -> DataFrame:
    """Target rows under every spelling they match: a wildcard row also matches the empty name.

    A target has at most 2^len(wildcards) copies, each with different names, so an equi-join on the
    spelled names finds each pair once."""
    out = targets
    for name, token in wildcards.items():
        both = F.array(F.col(name), F.lit(""))
        out = out.withColumn(f"_{name}", F.explode(F.when(F.col(name) == token, both).otherwise(F.array(F.col(name)))))
    return out


def wildcard_join(targets: DataFrame, cases: DataFrame, rule=("maprule", "mapruleid"), geo=("geoname", "geo"),
                  net=("netname", "aslist"), how: str = "inner") -> DataFrame:
    """Targets to cases on rule, geo and network, where a GLOBAL / ANY target matches the empty name.

    The OR condition would leave only the rule as join key (few values, hence skew); spelled out,
    all three columns are hash keys."""
    t = expand_wildcards(targets, {geo[0]: GLOBAL, net[0]: ANY}).withColumn("_rule", F.col(rule[0]))
    names = ["_rule", f"_{geo[0]}", f"_{net[0]}"]
    c = cases.select("*", *[F.col(k).alias(n) for k, n in zip((rule[1], geo[1], net[1]), names)])
    return t.join(c, names, how).drop(*names)


def target_per_key(df: DataFrame, keys: Sequence[str], target="targetvalue", agg: str = "max",
                   name: str | None = None, where: Column | None = None) -> DataFrame:
    """Highest (or lowest) target per key, optionally of one attribute."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg({"max": F.max, "min": F.min}[agg](target).alias(name or target))


def targets_per_key(df: DataFrame, keys: Sequence[str], targets: dict[str, tuple[str, str]]) -> DataFrame:
    """Several targets per key in one pass: name -> (max or min, column)."""
    return df.groupBy(*keys).agg(*[{"max": F.max, "min": F.min}[agg](c).alias(name) for name, (agg, c) in targets.items()])


def attach_target(df: DataFrame, targets: DataFrame, keys: Sequence[str] = CASE, target="targetvalue",
                  name="score_target") -> DataFrame:
    """Inner join of the highest target per case. The rows of a hot case stay spread over tasks."""
    return split_join(df, target_per_key(targets, keys, target, "max", name), keys)


def period_compare(now: DataFrame, before: DataFrame, keys: Sequence[str], values: Sequence[str],
                   suffix: str, how: str = "inner") -> DataFrame:
    """Two periods of the same summary side by side; the older columns get a suffix."""
    old = before.select(*keys, *[F.col(v).alias(f"{v}{suffix}") for v in values])
    return now.select(*keys, *values).join(old, list(keys), how)


def baseline_join(summary: DataFrame, baselines: dict[str, int], values: Sequence[str], rule="maprule",
                  keys: Sequence[str] = ("geoname", "netname")) -> DataFrame:
    """Each deficient case next to the baseline rules of the same geo and network.

    All baselines must exist. One conditional aggregation replaces a self-join per baseline: the
    summary is read twice whatever the number of baselines."""
    is_base = F.col(rule).isin(list(baselines.values()))
    picks = [F.max(F.when(F.col(rule) == r, F.col(v))).alias(f"{label}_{v}")
             for v in values for label, r in baselines.items()]
    found = [F.count_if(F.col(rule) == r).alias(f"_has_{label}") for label, r in baselines.items()]
    base = summary.where(is_base).groupBy(*keys).agg(*picks, *found)
    complete = reduce(lambda a, b: a & b, [F.col(f"_has_{label}") > 0 for label in baselines])
    base = base.where(complete).drop(*[f"_has_{label}" for label in baselines])
    deficient = reduce(lambda a, b: a | b, [F.col(v) > 0 for v in values])
    return summary.where(deficient).join(base, list(keys))


def baseline_pivot(df: DataFrame, baselines: dict[str, int], values: dict[str, str], keys: Sequence[str],
                   rule="maprule", rest: str = "v") -> DataFrame:
    """Sums per key, split into one column per baseline rule and one for every other rule."""
    others = ~F.col(rule).isin(list(baselines.values()))
    aggs = []
    for value, name in values.items():
        for label, r in baselines.items():
            aggs.append(F.sum(F.when(F.col(rule) == r, F.col(value)).otherwise(F.lit(0))).alias(f"{label}{name}"))
        aggs.append(F.sum(F.when(others, F.col(value)).otherwise(F.lit(0))).alias(f"{rest}{name}"))
    return df.groupBy(*keys).agg(*aggs)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], strict: bool = True) -> DataFrame:
    """For each left row the newest right row of the same key before (or at) its timestamp.

    Asked times (distinct per key) and right rows are sorted together into slices by key and time, whose borders are sampled
    from the data: a hot key, or a crowded hour of it, gets as many slices as its rows ask for. An asked time finds its row
    in its own slice or, failing that, is given the newest one of the key's slices before, carried forward over one row
    per key and slice. The answers then meet the left rows, of which many may share one key and time, without gathering them.

    Null is a key like others. A left row without a time has no match, a right row without one is never found. Of right rows
    with the same key and time the largest values count."""
    keys = list(keys)
    row = F.struct(F.col(right_ts).alias("_t"), *[F.col(v) for v in values])
    known = (right.where(F.col(right_ts).isNotNull()).select(*keys, F.col(right_ts).alias("_at"), row.alias("_row"))
             .groupBy(*keys, "_at").agg(F.max("_row").alias("_row")))
    asked = left.where(F.col(left_ts).isNotNull()).select(*keys, F.col(left_ts).alias("_at")).distinct()
    # Right rows sort before asked times of the same instant unless the match must be strictly older.
    sided = known.withColumn("_side", F.lit(1 if strict else -1)).unionByName(asked.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    ordered = sided.repartitionByRange(*keys, "_at", "_side").withColumn("_slice", F.spark_partition_id())
    ordered = stored(ordered, "slices")  # rows keep their slice, whatever is computed anew

    found = F.col("_row").isNotNull()
    last = ordered.where(found).groupBy(*keys, "_slice").agg(F.max_by("_row", "_at").alias("_last"))
    slices = ordered.groupBy(*keys, "_slice").agg(F.count_if(~found).alias("_asked"))
    slices = null_safe_join(slices, last, [*keys, "_slice"], "left")
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = slices.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where(F.col("_asked") > 0)

    upto = W.partitionBy(*keys, "_slice").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    seen = ordered.withColumn("_seen", F.last("_row", ignorenulls=True).over(upto)).where(~found).select(*keys, "_slice", "_at", "_seen")
    hits = split_join(seen, carried.select(*keys, "_slice", "_carried"), [*keys, "_slice"], "left", nulls=True)
    hits = hits.select(*keys, F.col("_at").alias(left_ts), F.coalesce("_seen", "_carried").alias("_hit"))
    out = split_join(left, hits, [*keys, left_ts], "left", nulls=True)
    return out.select(*left.columns, F.col("_hit._t").alias(right_ts), *[F.col(f"_hit.{v}").alias(v) for v in values])


def distance_join(left: DataFrame, right: DataFrame, miles: float, left_pos=("lat", "lon"),
                  right_pos=("rg_lat", "rg_lon"), how: str = "inner", out: str = "distance") -> DataFrame:
    """Pairs at most `miles` apart (strictly less), by cells of a grid over the unit sphere.

    The right side is copied to its 27 touching cells; equal cells join by hash; the exact distance
    decides. Cells are three-dimensional, so poles and the date line need no special case. Pass
    distinct sites (as `clusters.region_sites`), not raw rows: co-located rows would form pairs only
    to be summed."""
    edge = grid_edge(miles)
    l = left.select(*[F.col(c).alias(f"_l_{c}") for c in left.columns], grid_cell(*left_pos, edge).alias("_lcell"))
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns],
                     F.explode(neighbour_cells(grid_cell(*right_pos, edge))).alias("_rcell"))
    d = haversine_miles(*[f"_l_{c}" for c in left_pos], *[f"_r_{c}" for c in right_pos])
    joined = l.join(r, (F.col("_lcell") == F.col("_rcell")) & (d < miles), how)
    return joined.select(*[F.col(f"_l_{c}").alias(c) for c in left.columns],
                         *[F.col(f"_r_{c}").alias(c) for c in right.columns], d.alias(out))


def explode_join(df: DataFrame, ids: str, dim: DataFrame, dim_key: str, how: str = "inner") -> DataFrame:
    """Id list exploded and joined to its dimension; repeated ids of one row count once."""
    one = df.withColumn("_id", F.explode(F.array_distinct(ids))).drop(ids)
    return one.join(dim.withColumnRenamed(dim_key, "_id"), "_id", how).withColumnRenamed("_id", dim_key)


def share_of_total(detail: DataFrame, keys: Sequence[str], value: str, share: str, total: str,
                   scale: float = 100.0, digits: int = 4) -> DataFrame:
    """Total per key (null is a key too) joined back to the detail rows, and each row's share.

    A grouped total, not a window: partial sums are added on the map side, and the join back leaves the rows of a hot key
    spread over tasks."""
    pct = F.round(F.try_divide(F.lit(scale) * F.col(value).cast("double"), F.col(total).cast("double")), digits)
    return with_totals(detail, keys, **{total: F.sum(value)}).withColumn(share, F.when(F.col(total) > 0, pct).otherwise(F.lit(0.0)))


def override_dimension(auto: DataFrame, manual: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Automatic dimension with manually kept values taking precedence."""
    m = manual.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = auto.join(m, key, "left")
    fixed = [F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in auto.columns]
    return out.select(*fixed)


def members_of(df: DataFrame, column: str, ids, dim_key: str | None = None, negate: bool = False) -> DataFrame:
    """Rows whose id is in (or not in) a short literal list or a list table."""
    if isinstance(ids, DataFrame):
        key = dim_key or column
        listed = ids.select(F.col(key).alias(column)).distinct()
        return df.join(listed, column, "left_anti" if negate else "left_semi")
    cond = as_col(column).isin(list(ids))
    return df.where(~cond if negate else cond)
