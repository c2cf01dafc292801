"""Geometry as column expressions: Albers projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ellipsoid GRS80 and the parameters of EPSG:5070.
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0, LAT1, LAT2 = (math.radians(x) for x in (23.0, -96.0, 29.5, 45.5))
ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)


def _q(s: float) -> float:
    return (1 - ECC2) * (s / (1 - ECC2 * s * s) - math.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - ECC2 * math.sin(lat) ** 2)


N = (_m(LAT1) ** 2 - _m(LAT2) ** 2) / (_q(math.sin(LAT2)) - _q(math.sin(LAT1)))
C = _m(LAT1) ** 2 + N * _q(math.sin(LAT1))
RHO0 = AXIS * math.sqrt(C - N * _q(math.sin(LAT0))) / N


def albers(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Equal-area x and y in metres of degrees (Snyder's forward formula for the ellipsoid)."""
    s = F.sin(F.radians(lat))
    q = (1 - ECC2) * (s / (1 - ECC2 * s * s) - F.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
    rho = AXIS * F.sqrt(C - N * q) / N
    theta = N * (F.radians(lon) - LON0)
    return rho * F.sin(theta), RHO0 - rho * F.cos(theta)


def inverse_albers(x: Column, y: Column, steps: int = 5) -> tuple[Column, Column]:
    """Latitude and longitude in degrees; latitude by a fixed number of refinements."""
    rho = F.hypot(x, RHO0 - y)
    theta = F.atan2(x, RHO0 - y)
    q = (C - rho * rho * N * N / AXIS**2) / N
    lat = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.asin(q / 2),
        lambda p, _: p
        + F.pow(1 - ECC2 * F.pow(F.sin(p), 2), 2)
        / (2 * F.cos(p))
        * (q / (1 - ECC2) - F.sin(p) / (1 - ECC2 * F.pow(F.sin(p), 2)) + F.log((1 - ECC * F.sin(p)) / (1 + ECC * F.sin(p))) / (2 * ECC)),
    )
    return F.degrees(lat), F.degrees(LON0 + theta / N)
