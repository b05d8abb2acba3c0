"""Coordinates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0
ALPHABET = "23456789CFGHJMPQRVWX"  # the 20 symbols of plus codes


def plausible(lat: Column, lon: Column) -> Column:
    """Both numeric and negative, as everywhere in the city."""
    return F.coalesce((lat.try_cast("double") < 0) & (lon.try_cast("double") < 0), F.lit(False))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def area_code(lat: Column, lon: Column) -> Column:
    """The 10-digit plus code of a point, null outside the earth's ranges."""
    la = F.least(F.floor(F.round((lat + 90) * 8000, 6)), F.lit(180 * 8000 - 1)).cast("long")
    lo = F.floor(F.round((F.pmod(lon + 180, F.lit(360.0))) * 8000, 6)).cast("long")
    letters = F.lit(ALPHABET)
    parts = []
    for i in range(4, -1, -1):
        for v in (la, lo):
            parts.append(F.substring(letters, (F.floor(v / 20**i) % 20 + 1).cast("int"), F.lit(1)))
    code = F.concat(*parts[:8], F.lit("+"), *parts[8:])
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), code)


def utm_to_degrees(x: Column, y: Column, central_meridian: float = -45.0) -> tuple[Column, Column]:
    """(latitude, longitude) of UTM metres in the southern zone 23, to 7 decimals: the series inverse on the 1980 ellipsoid."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    m = (y - 10_000_000.0) / k0
    mu = m / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    c1, t1 = ep2 * F.pow(F.cos(p), 2), F.pow(F.tan(p), 2)
    s = 1 - e2 * F.pow(F.sin(p), 2)
    n1, r1 = a / F.sqrt(s), a * (1 - e2) / F.pow(s, 1.5)
    d = (x - 500_000.0) / (n1 * k0)
    lat = p - (n1 * F.tan(p) / r1) * (d**2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1**2 - 9 * ep2) * d**4 / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1**2 - 252 * ep2 - 3 * c1**2) * d**6 / 720)
    lon = (d - (1 + 2 * t1 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1**2 + 8 * ep2 + 24 * t1**2) * d**5 / 120) / F.cos(p)
    return F.round(F.degrees(lat), 7), F.round(central_meridian + F.degrees(lon), 7)
