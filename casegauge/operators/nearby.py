"""Sums over what lies within a distance, without forming the pairs.

Both sides are laid into the cells of nested grids over the unit sphere, each level four times finer than the one before.
Two cells are compared as a whole: if all their points lie within the distance, every point of the one cell gets the totals of
the other; if none do, the pair of cells is dropped; in between they are cut into the cells of the next level, until few
points are left to be compared one by one. So sites that crowd one place cost their number of cells, not the square of
their number, wherever the crowd is."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casegauge.functions.geo import EARTH_RADIUS_MILES, grid_edge, haversine_miles, unit_vector
from casegauge.operators.spread import split_join
from casegauge.sources.tables import stored

LEVELS = 8  # below the first grid; each is four times finer
FEW = 1024  # pairs of points of two cells that are compared one by one
AXES = ("x", "y", "z")
SAFE = 1e-9  # relative margin of the comparison of whole cells; points near it are compared exactly


def nearby_sums(left: DataFrame, right: DataFrame, miles: float, sums: dict[str, str], left_pos=("lat", "lon"),
                right_pos=("rg_lat", "rg_lon"), few: int = FEW) -> DataFrame:
    """The left rows with the sum of each named column (name -> column) over the right rows less than `miles` away; 0 where
    there are none. Rows without a position are near nothing. Null values count as 0."""
    edge = grid_edge(miles)
    spots = _spots(left.groupBy(*left_pos).agg(F.count(F.lit(1)).alias("_n")), left_pos, edge)
    totals = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_s{i}") for i, c in enumerate(sums.values())]
    sites = _spots(right.groupBy(*right_pos).agg(*totals), right_pos, edge)
    spots, sites = stored(spots, "spots"), stored(sites, "sites")
    names = [f"_s{i}" for i in range(len(sums))]

    found, open_pairs = [], None
    for level in range(LEVELS + 1):
        pairs = stored(_judged(_pairs(spots, sites, names, open_pairs, level), miles, edge, level, few), "pairs")
        found += [_whole(spots, pairs.where("_case = 'whole'"), names, level), _single(spots, sites, pairs.where("_case = 'few'"), names, miles, level)]
        open_pairs = pairs.where("_case = 'open'")
        if not open_pairs.limit(1).count():
            break
    every = functools.reduce(DataFrame.unionByName, found).groupBy("_lat", "_lon").agg(*[F.sum(n).alias(n) for n in names])
    every = every.withColumnsRenamed({"_lat": left_pos[0], "_lon": left_pos[1]})
    out = split_join(left, every, list(left_pos), "left")
    kinds = dict(sites.dtypes)
    return out.select(*left.columns, *[F.coalesce(n, F.lit(0)).cast(kinds[n]).alias(name) for n, name in zip(names, sums)])


def _spots(df: DataFrame, pos: Sequence[str], edge: float) -> DataFrame:
    """`_lat`, `_lon` and the cell of the finest grid; the cells of coarser ones are its leading bits."""
    placed = df.where(F.col(pos[0]).isNotNull() & F.col(pos[1]).isNotNull()).withColumnsRenamed({pos[0]: "_lat", pos[1]: "_lon"})
    finest = edge / 4 ** LEVELS
    return placed.withColumns({f"_{a}": F.floor(c / finest).cast("long") for a, c in zip(AXES, unit_vector("_lat", "_lon"))})


def _cell(level: int, prefix: str) -> list[Column]:
    return [F.shiftright(f"_{a}", 2 * (LEVELS - level)).alias(f"_{prefix}{a}") for a in AXES]


def _names(prefix: str) -> list[str]:
    return [f"_{prefix}{a}" for a in AXES]


def _pairs(spots: DataFrame, sites: DataFrame, sums: list[str], around: DataFrame | None, level: int) -> DataFrame:
    """Pairs of cells of a level with their numbers of points and the totals of the right one: touching cells on the first
    level, then the parts of the pairs that were left open."""
    l = spots.groupBy(*_cell(level, "l")).agg(F.count(F.lit(1)).alias("_nl"))
    r = sites.groupBy(*_cell(level, "r")).agg(F.count(F.lit(1)).alias("_nr"), *[F.sum(s).alias(s) for s in sums])
    if around is None:
        steps = F.explode(F.array(*[F.struct(*[F.lit(d).alias(a) for a, d in zip(AXES, (i, j, k))]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
        near = r.withColumn("_step", steps).select("*", *[(F.col(f"_r{a}") + F.col(f"_step.{a}")).alias(f"_l{a}") for a in AXES]).drop("_step")
        return l.join(near, _names("l"))
    up = lambda p: [F.shiftright(f"_{p}{a}", 2).alias(f"_u{p}{a}") for a in AXES]
    above = around.select(*[F.col(n).alias(f"_u{n[1:]}") for n in (*_names("l"), *_names("r"))])
    parts = above.join(l.select("*", *up("l")), [f"_ul{a}" for a in AXES]).join(r.select("*", *up("r")), [f"_ur{a}" for a in AXES])
    return parts.drop(*[f"_u{p}{a}" for p in "lr" for a in AXES])


def _judged(pairs: DataFrame, miles: float, edge: float, level: int, few: int) -> DataFrame:
    """`_case` of every pair of cells that may hold near points: whole, few or open."""
    reach = 2 * math.sin(miles / (2 * EARTH_RADIUS_MILES)) if miles < math.pi * EARTH_RADIUS_MILES else 3.0
    size = edge / 4 ** level
    apart = [F.abs(F.col(f"_l{a}") - F.col(f"_r{a}")) for a in AXES]
    square = lambda terms: functools.reduce(lambda a, b: a + b, [t * t for t in terms]) * F.lit(size * size)
    least, most = square([F.greatest(d - 1, F.lit(0)) for d in apart]), square([d + 1 for d in apart])
    one_by_one = (F.col("_nl") * F.col("_nr") <= few) | F.lit(level == LEVELS)
    case = F.when(most < (reach * (1 - SAFE)) ** 2, F.lit("whole")).when(one_by_one, F.lit("few")).otherwise(F.lit("open"))
    return pairs.where(least <= (reach * (1 + SAFE)) ** 2).withColumn("_case", case)


def _whole(spots: DataFrame, pairs: DataFrame, sums: list[str], level: int) -> DataFrame:
    """Every point of a cell gets the totals of the cells that lie within the distance as a whole."""
    totals = pairs.groupBy(*_names("l")).agg(*[F.sum(s).alias(s) for s in sums])
    at = spots.select("_lat", "_lon", *_cell(level, "l"))
    return split_join(at, totals, _names("l")).select("_lat", "_lon", *sums)


def _single(spots: DataFrame, sites: DataFrame, pairs: DataFrame, sums: list[str], miles: float, level: int) -> DataFrame:
    """Points of two cells compared one by one."""
    l = spots.select(F.col("_lat").alias("_llat"), F.col("_lon").alias("_llon"), *_cell(level, "l"))
    r = sites.select(F.col("_lat").alias("_rlat"), F.col("_lon").alias("_rlon"), *_cell(level, "r"), *sums)
    rows = pairs.select(*_names("l"), *_names("r")).join(l, _names("l")).join(r, _names("r"))
    near = rows.where(haversine_miles("_llat", "_llon", "_rlat", "_rlon") < miles)
    return near.groupBy(F.col("_llat").alias("_lat"), F.col("_llon").alias("_lon")).agg(*[F.sum(s).alias(s) for s in sums])
