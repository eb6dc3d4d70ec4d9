"""Position of the sun as column expressions (the public low-precision formula of NOAA)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fourier coefficients of the equation of time (minutes) and of the declination (radians).
EQUATION_OF_TIME = (0.000075, 0.001868, -0.032077, -0.014615, -0.040849)
DECLINATION = (0.006918, -0.399912, 0.070257, -0.006758, 0.000907, -0.002697, 0.00148)


def _angles(utc: Column, lon: float) -> tuple[Column, Column]:
    """Declination and hour angle, in radians."""
    hour = F.hour(utc) + F.minute(utc) / 60 + F.second(utc) / 3600
    g = 2 * math.pi / 365 * (F.dayofyear(utc) - 1 + (hour - 12) / 24)
    e, d = EQUATION_OF_TIME, DECLINATION
    equation = 229.18 * (e[0] + e[1] * F.cos(g) + e[2] * F.sin(g) + e[3] * F.cos(2 * g) + e[4] * F.sin(2 * g))
    declination = d[0] + d[1] * F.cos(g) + d[2] * F.sin(g) + d[3] * F.cos(2 * g) + d[4] * F.sin(2 * g) + d[5] * F.cos(3 * g) + d[6] * F.sin(3 * g)
    minutes = hour * 60 + equation + 4 * lon
    return declination, F.radians(minutes / 4 - 180)


def elevation(utc: Column, lat: float, lon: float) -> Column:
    """Degrees above the horizon."""
    d, h = _angles(utc, lon)
    up = math.sin(math.radians(lat)) * F.sin(d) + math.cos(math.radians(lat)) * F.cos(d) * F.cos(h)
    return 90 - F.degrees(F.acos(F.greatest(F.least(up, F.lit(1.0)), F.lit(-1.0))))


def azimuth(utc: Column, lat: float, lon: float) -> Column:
    """Degrees clockwise from north."""
    d, h = _angles(utc, lon)
    a = F.atan2(F.sin(h), F.cos(h) * math.sin(math.radians(lat)) - F.tan(d) * math.cos(math.radians(lat)))
    return F.pmod(F.degrees(a) + 180, F.lit(360.0))


def sun_bin(elevation: Column, azimuth: Column, edges: tuple[float, ...] = (5, 15, 30, 45, 60), step: float = 30.0) -> Column:
    """Number of the sky bin: sector of azimuth times bands plus band of elevation; -1 below the lowest edge."""
    band = sum((F.when(elevation >= e, 1).otherwise(0) for e in edges[1:]), F.lit(0))
    sector = F.pmod(F.floor(azimuth / step), F.lit(int(360 / step)))
    return F.when(elevation < edges[0], -1).otherwise(sector * len(edges) + band).cast("int")


def bin_centre(number: int, edges: tuple[float, ...] = (5, 15, 30, 45, 60), step: float = 30.0) -> tuple[float, float]:
    """Elevation and azimuth in the middle of a sky bin."""
    tops = [*edges[1:], 90.0]
    sector, band = divmod(number, len(edges))
    return (edges[band] + tops[band]) / 2, (sector + 0.5) * step
