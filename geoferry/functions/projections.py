"""Closed-form projections, as steps over points for ``map_points``.

A projection here is two lists of steps, from degrees and to degrees, and the points in degrees that have an image. A step
takes and gives a struct; a value used more than once is worked out in a step of its own, since Spark would compute it at
each use.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoferry.fixed_values import (
    EARTH_RADIUS,
    FLATTENING,
    MERCATOR_SRIDS,
    UTM_EASTING,
    UTM_NORTH,
    UTM_SCALE,
    UTM_SOUTH,
    UTM_SOUTHERN_NORTHING,
    WGS84_SRID,
)
from geoferry.functions.geometry import coordinate

Step = Callable[[Column], Column]


def _mercator(p: Column) -> Column:
    return coordinate(F.radians(p["x"]) * EARTH_RADIUS, F.asinh(F.tan(F.radians(p["y"]))) * EARTH_RADIUS)


def _mercator_inverse(p: Column) -> Column:
    x = F.degrees(p["x"] / EARTH_RADIUS)
    y = F.degrees(F.atan(F.exp(p["y"] / EARTH_RADIUS)) * 2 - math.pi / 2)
    return coordinate(x, y)


# Transverse Mercator by Krueger's series in the third flattening, to the third order: good to a
# millimetre within some thousand kilometres of the central meridian.
# Degrees from the central meridian to which it is used.
UTM_REACH = 25
_N = FLATTENING / (2 - FLATTENING)
_RADIUS = EARTH_RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_CONFORMAL = 2 * math.sqrt(_N) / (1 + _N)
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480]
_DELTA = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15]


def _series(factors: list[float], sign: int) -> Step:
    """Step that moves a point (xi in x, eta in y) by the series."""

    def moved(p: Column) -> Column:
        x, y = p["x"], p["y"]
        for order, factor in enumerate(factors, 1):
            x = x + F.sin(p["x"] * (2 * order)) * F.cosh(p["y"] * (2 * order)) * (sign * factor)
            y = y + F.cos(p["x"] * (2 * order)) * F.sinh(p["y"] * (2 * order)) * (sign * factor)
        return coordinate(x, y)

    return moved


def _central_meridian(zone: int) -> int:
    return zone * 6 - 183


def _utm(zone: int, northing: float) -> list[Step]:
    def conformal(p: Column) -> Column:
        # The tangent of the conformal latitude, and the longitude from the central meridian.
        sine = F.sin(F.radians(p["y"]))
        tangent = F.sinh(F.atanh(sine) - F.atanh(sine * _CONFORMAL) * _CONFORMAL)
        return coordinate(F.radians(p["x"] - _central_meridian(zone)), tangent)

    def spherical(p: Column) -> Column:
        xi = F.atan(p["y"] / F.cos(p["x"]))
        eta = F.atanh(F.sin(p["x"]) / F.sqrt(p["y"] * p["y"] + 1))
        return coordinate(xi, eta)

    def metres(p: Column) -> Column:
        return coordinate(p["y"] * (UTM_SCALE * _RADIUS) + UTM_EASTING, p["x"] * (UTM_SCALE * _RADIUS) + northing)

    return [conformal, spherical, _series(_ALPHA, 1), metres]


def _utm_inverse(zone: int, northing: float) -> list[Step]:
    def normal(p: Column) -> Column:
        return coordinate((p["y"] - northing) / (UTM_SCALE * _RADIUS), (p["x"] - UTM_EASTING) / (UTM_SCALE * _RADIUS))

    def conformal(p: Column) -> Column:
        beside = F.atan2(F.sinh(p["y"]), F.cos(p["x"]))
        return coordinate(beside, F.asin(F.sin(p["x"]) / F.cosh(p["y"])))

    def degrees(p: Column) -> Column:
        y = p["y"]
        for order, factor in enumerate(_DELTA, 1):
            y = y + F.sin(p["y"] * (2 * order)) * factor
        return coordinate(F.degrees(p["x"]) + _central_meridian(zone), F.degrees(y))

    return [normal, _series(_BETA, -1), conformal, degrees]


class Projection(NamedTuple):
    """Steps from and to degrees, and whether a point in degrees has an image."""

    forward: list[Step]
    inverse: list[Step]
    has_image: Step


def _not_a_pole(p: Column) -> Column:
    return F.abs(p["y"]) < 90


def _near(zone: int) -> Step:
    """Not a pole, and so near to the zone's central meridian that the series holds."""

    def inside(p: Column) -> Column:
        beside = F.pmod(p["x"] - (_central_meridian(zone) - 180), F.lit(360.0)) - 180
        return _not_a_pole(p) & (F.abs(beside) <= UTM_REACH)

    return inside


def projection_of(srid: int | None) -> Projection | None:
    """None for a reference that is not supported."""
    if srid == WGS84_SRID:
        return Projection([], [], lambda p: F.abs(p["y"]) <= 90)
    if srid in MERCATOR_SRIDS:
        return Projection([_mercator], [_mercator_inverse], _not_a_pole)
    for base, northing in ((UTM_NORTH, 0.0), (UTM_SOUTH, UTM_SOUTHERN_NORTHING)):
        if srid is not None and 1 <= srid - base <= 60:
            zone = srid - base
            return Projection(_utm(zone, northing), _utm_inverse(zone, northing), _near(zone))
    return None


def same_reference(srid: int | None, out_srid: int) -> bool:
    return srid == out_srid or {srid, out_srid} <= set(MERCATOR_SRIDS)
