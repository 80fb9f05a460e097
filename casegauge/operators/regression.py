"""Distance/latency statistics and cross-validated linear fits, from partial-aggregable sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casegauge.functions.metrics import UNREACHABLE
from casegauge.functions.stats import correlation_p_value
from casegauge.operators.lists import items_with_totals
from casegauge.operators.quantiles import percentile_array
from casegauge.operators.spread import split_join

MIN_POINTS = 10


def distance_latency_stats(df: DataFrame, keys: Sequence[str], x="distance", y="latency", z="loss",
                           attributes: Sequence[str] = (), p_value: bool = False) -> DataFrame:
    """Per probe: valid count and share, correlation, linear fit, error, means and percentiles.

    Latencies of 10000 and more are unreachable. With at most 10 valid points the fit is constant
    (0, or -1 for the location figures). Percentiles are over whole miles, milliseconds and percents,
    a small domain. The largest residual needs the fitted line, hence a second pass over the data, in which the
    points of a hot probe stay spread over tasks."""
    keys = list(keys)
    ok = F.col(y) < UNREACHABLE
    vx, vy, vz = (F.when(ok, F.col(c).cast("double")) for c in (x, y, z))
    whole = lambda c: percentile_array(c.cast("long"), [0.95, 0.5])
    first = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_record"), F.count(vy).alias("n_valid"), F.corr(vx, vy).alias("_r"),
        F.regr_slope(vy, vx).alias("_a"), F.regr_intercept(vy, vx).alias("_b"),
        F.regr_syy(vy, vx).alias("_syy"), F.regr_sxy(vy, vx).alias("_sxy"),
        *[F.round(F.avg(v), 3).alias(f"_mean_{n}") for v, n in ((vx, "dist"), (vy, "lat"), (vz, "loss"))],
        *[whole(v).alias(f"_p_{n}") for v, n in ((vx, "dist"), (vy, "lat"), (vz, "loss"))],
        *[F.min(a).alias(a) for a in attributes])
    line = first.select(*keys, "_a", "_b")
    residual = F.abs(F.col("_a") * F.col(x) + F.col("_b") - F.col(y))
    worst = split_join(df.where(ok), line, keys).groupBy(*keys).agg(F.max(residual).alias("_worst"))
    fitted = F.col("n_valid") > MIN_POINTS
    take = lambda c, default: F.when(fitted, c).otherwise(F.lit(default))
    rmse = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("_syy") - F.col("_a") * F.col("_sxy"), F.col("n_valid").cast("double"))))
    out = first.join(worst, keys, "left")
    extra = [take(correlation_p_value(F.col("_r"), F.col("n_valid")), 1.0).alias("rpv")] if p_value else []
    return out.select(
        *keys, *attributes, "n_record", "n_valid",
        F.round(F.lit(100.0) * F.col("n_valid") / F.col("n_record"), 2).alias("valid_ratio"),
        F.round(take(F.col("_r"), 0.0), 6).alias("r"), *extra,
        F.round(take(F.col("_a"), 0.0), 3).alias("slope"), F.round(take(F.col("_b"), 0.0), 3).alias("intercept"),
        F.round(take(rmse, 0.0), 4).alias("err"), F.round(take(F.col("_worst"), 0.0), 3).alias("err_max"),
        *[take(F.col(f"_mean_{n}"), -1.0).alias(f"avg_{n}") for n in ("dist", "lat", "loss")],
        *[F.round(take(F.col(f"_p_{n}")[i], -1.0), 3).alias(f"{p}_{n}")
          for i, p in enumerate(("p95", "p50")) for n in ("dist", "lat", "loss")])


def valid_points(df: DataFrame, keys: Sequence[str], x="distance", y="latency") -> DataFrame:
    """The valid distances and latencies of each probe, one row per measurement, with their number."""
    rows = df.where(F.col(y) < UNREACHABLE).select(*keys, F.round(x, 3).alias("dist"), F.round(y, 3).alias("latency"))
    return items_with_totals(rows, keys, "points")


def linear_fit_cv(df: DataFrame, key: str, x: str, targets: Sequence[str], load: str, in_test, reps: int = 10,
                  min_rows: int = 20) -> DataFrame:
    """Per key: mean R^2, intercept and slope of target ~ x over repeated train/test splits.

    `in_test(rep)` is a boolean column for a repetition number column. Every row is copied once per
    repetition and reduced to sums on the map side; R^2 on the test rows follows from their sums, so
    neither the model nor the residuals need another pass."""
    rows = df.select(key, x, load, *targets, F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("_rep"),
                     *[c for c in df.columns if c not in (key, x, load, *targets)])
    rows = rows.withColumn("_test", in_test(F.col("_rep")))
    train = lambda c: F.when(~F.col("_test"), F.col(c).cast("double"))
    test = lambda c: F.when(F.col("_test"), F.col(c).cast("double"))
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n"), F.sum(load).alias("_load")]
    for t in targets:
        tx, ty = test(x), test(t)
        aggs += [F.regr_slope(train(t), train(x)).alias(f"_a_{t}"), F.regr_intercept(train(t), train(x)).alias(f"_b_{t}"),
                 F.regr_sxx(ty, tx).alias(f"_sxx_{t}"), F.regr_syy(ty, tx).alias(f"_syy_{t}"),
                 F.regr_sxy(ty, tx).alias(f"_sxy_{t}"), F.avg(tx).alias(f"_mx_{t}"), F.avg(ty).alias(f"_my_{t}"),
                 F.count(ty).alias(f"_m_{t}")]
    fits = rows.groupBy(key, "_rep").agg(*aggs).where(F.col("_n") >= min_rows)

    def r2(t):
        a, b = F.col(f"_a_{t}"), F.col(f"_b_{t}")
        sxx, syy, sxy = (F.col(f"_{s}_{t}") for s in ("sxx", "syy", "sxy"))
        shift = F.col(f"_my_{t}") - a * F.col(f"_mx_{t}") - b
        sse = syy - 2 * a * sxy + a * a * sxx + F.col(f"_m_{t}") * shift * shift
        return F.lit(1.0) - F.try_divide(sse, syy)

    out = [F.max("_n").alias("samples"), F.max("_load").alias("load")]
    for t in targets:
        out += [F.round(F.avg(r2(t)), 2).alias(f"{t}_r2"), F.round(F.avg(f"_b_{t}"), 2).alias(f"{t}_intercept"),
                F.round(F.avg(f"_a_{t}"), 3).alias(f"{t}_coeff")]
    return fits.groupBy(key).agg(*out)
