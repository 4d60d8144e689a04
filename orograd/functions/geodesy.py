"""Great-circle distance and transverse-Mercator projection as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, c

# GRS80 ellipsoid and UTM zone 10 placement (fixed values)
_A, _F, _K0, _FALSE_EASTING, _LON0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, -123.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ECC = 2 * math.sqrt(_N) / (1 + _N)
# third-order Krueger series coefficients
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480]
_DELTA = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15]


def haversine_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
    dlat, dlon = F.radians(c(lat2) - c(lat1)), F.radians(c(lon2) - c(lon1))
    h = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(c(lat1))) * F.cos(F.radians(c(lat2))) * F.pow(F.sin(dlon / 2), 2))
    return 2 * 6371.0 * F.asin(F.sqrt(h))


def lonlat_to_utm(lon: ColumnLike, lat: ColumnLike) -> tuple[Column, Column]:
    """Longitude/latitude in degrees -> easting/northing in metres (zone 10 north)."""
    phi, lam = F.radians(c(lat)), F.radians(c(lon) - _LON0)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - _ECC * F.atanh(_ECC * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _FALSE_EASTING + _K0 * _RADIUS * x, _K0 * _RADIUS * y


def utm_to_lonlat(x: ColumnLike, y: ColumnLike) -> tuple[Column, Column]:
    """Easting/northing in metres (zone 10 north) -> longitude/latitude in degrees."""
    xi0, eta0 = c(y) / (_K0 * _RADIUS), (c(x) - _FALSE_EASTING) / (_K0 * _RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(_BETA, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta), F.cos(xi))
    return _LON0 + F.degrees(lam), F.degrees(phi)
