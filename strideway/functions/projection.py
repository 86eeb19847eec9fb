"""Transverse Mercator (UTM) projection, forward and inverse, as Column expressions: a third-order Krueger series on WGS-84."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_A, _FLATTENING, _SCALE, _EASTING = 6_378_137.0, 1 / 298.257223563, 0.9996, 500_000.0
_N = _FLATTENING / (2 - _FLATTENING)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ECCENTRICITY = 2 * math.sqrt(_N) / (1 + _N)
#: Series coefficients: forward, inverse, and from the conformal to the geographic latitude.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def utm(lon: Column, lat: Column, zone: int = 18) -> Column:
    """A struct of x and y in metres."""

    def plane(z: Column) -> Column:
        x, y = z["eta"], z["xi"]
        for j, a in enumerate(_ALPHA, 1):
            x = x + a * F.cos(2 * j * z["xi"]) * F.sinh(2 * j * z["eta"])
            y = y + a * F.sin(2 * j * z["xi"]) * F.cosh(2 * j * z["eta"])
        return F.struct((_EASTING + _SCALE * _RADIUS * x).alias("x"), (_SCALE * _RADIUS * y).alias("y"))

    def conformal(w: Column) -> Column:
        return F.struct(F.atan2(w["t"], F.cos(w["away"])).alias("xi"), F.atanh(F.sin(w["away"]) / F.sqrt(1 + w["t"] * w["t"])).alias("eta"))

    def start(s: Column) -> Column:
        return F.struct(F.sinh(F.atanh(s["sine"]) - _ECCENTRICITY * F.atanh(_ECCENTRICITY * s["sine"])).alias("t"), s["away"].alias("away"))

    first = F.struct(F.sin(F.radians(lat)).alias("sine"), F.radians(lon - _meridian(zone)).alias("away"))
    return _let(_let(_let(first, start), conformal), plane)


def utm_x(lon: Column, lat: Column, zone: int = 18) -> Column:
    return utm(lon, lat, zone)["x"]


def utm_y(lon: Column, lat: Column, zone: int = 18) -> Column:
    return utm(lon, lat, zone)["y"]


def _meridian(zone: int) -> float:
    return 6 * zone - 183.0


def with_plane(df: DataFrame, zone: int = 18) -> DataFrame:
    """A table of lon and lat with x and y, computed once: generating one row keeps the optimizer from copying the expression."""
    return df.drop("x", "y").select("*", F.explode(F.array(utm(F.col("lon"), F.col("lat"), zone))).alias("_plane")).select("*", "_plane.x", "_plane.y").drop("_plane")


def inverse(x: Column, y: Column, zone: int = 18) -> tuple[Column, Column]:
    """(lon, lat) of a northern point."""
    xi, eta = y / (_SCALE * _RADIUS), (x - _EASTING) / (_SCALE * _RADIUS)
    north, east = xi, eta
    for j, b in enumerate(_BETA, 1):
        north = north - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    conformal = F.asin(F.sin(north) / F.cosh(east))
    lat = conformal
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * conformal)
    return _meridian(zone) + F.degrees(F.atan2(F.sinh(east), F.cos(north))), F.degrees(lat)


def project_line(line: Column, zone: int = 18) -> Column:
    """A line of (lon, lat) points as one of (x, y) metres."""
    return F.transform(line, lambda p: utm(p["lon"], p["lat"], zone))
