"""Spherical geometry in miles, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from casegauge.functions.metrics import as_col

EARTH_RADIUS_MILES = 3963.1676


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance."""
    la1, lo1, la2, lo2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    s = F.pow(F.sin((la2 - la1) / 2), F.lit(2.0)) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), F.lit(2.0))
    s = F.least(s, F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_MILES) * F.atan2(F.sqrt(s), F.sqrt(F.lit(1.0) - s))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Cartesian point of the unit sphere."""
    la, lo = F.radians(as_col(lat)), F.radians(as_col(lon))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def grid_edge(miles: float) -> float:
    """Cell edge of a unit-sphere grid in which points within `miles` lie in touching cells."""
    if miles >= math.pi * EARTH_RADIUS_MILES:
        return 2.0
    return 2 * math.sin(miles / (2 * EARTH_RADIUS_MILES)) * (1 + 1e-9)


def grid_cell(lat, lon, edge: float) -> Column:
    """Integer cell coordinates of a point as a struct."""
    x, y, z = unit_vector(lat, lon)
    return F.struct(*[F.floor(c / edge).cast("int").alias(n) for c, n in ((x, "cx"), (y, "cy"), (z, "cz"))])


def neighbour_cells(cell: Column) -> Column:
    """The cell and its 26 neighbours, as an array of structs."""
    steps = F.sequence(F.lit(-1), F.lit(1))

    def along_z(i, j):
        return F.transform(steps, lambda k: F.struct(
            (cell["cx"] + i).alias("cx"), (cell["cy"] + j).alias("cy"), (cell["cz"] + k).alias("cz")))

    return F.flatten(F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: along_z(i, j)))))


def centroid_aggs(lat, lon, weight) -> list[Column]:
    """Partial-aggregable sums behind `centroid_columns`."""
    w = as_col(weight).cast("double")
    x, y, z = unit_vector(lat, lon)
    return [F.sum(w * x).alias("_wx"), F.sum(w * y).alias("_wy"), F.sum(w * z).alias("_wz"),
            F.sum(w).alias("_w")]


def centroid_columns(prefix: str = "cl_") -> list[Column]:
    """Centroid latitude/longitude, relative radius `por` and dispersion `porsigma` (miles).

    All points lie on the sphere, so the weighted variance is R^2 (1 - |c|^2).
    """
    cx, cy, cz = (F.try_divide(F.col(c), F.col("_w")) for c in ("_wx", "_wy", "_wz"))
    length = F.sqrt(cx * cx + cy * cy + cz * cz)
    ratio = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(cz, length)))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - length * length))
    return [
        F.round(F.lit(90.0) - F.degrees(F.acos(ratio)), 3).alias(f"{prefix}lat"),
        F.round(F.degrees(F.atan2(cy, cx)), 3).alias(f"{prefix}lon"),
        F.round(length, 4).alias(f"{prefix}por"),
        F.round(spread * EARTH_RADIUS_MILES, 2).alias(f"{prefix}porsigma"),
    ]
