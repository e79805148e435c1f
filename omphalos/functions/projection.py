"""Transverse Mercator (UTM) <-> longitude/latitude as column expressions.

Krüger's series in the third flattening n, carried to n^4 (Krüger 1912;
Karney, "Transverse Mercator with an accuracy of a few nanometers", 2011).
Written once against a math namespace, so the same formula runs as Spark
columns (no UDF) and as numpy for tests. The reference data use ETRS89 /
UTM zone 30N (EPSG:25830); ETRS89 and WGS84 are taken as the same datum.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 ellipsoid and the UTM zone 30N false origin.
GRS80_A = 6_378_137.0
GRS80_INV_F = 298.257222101
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500_000.0
UTM_FALSE_NORTHING_NORTH = 0.0
UTM30_CENTRAL_MERIDIAN_DEG = -3.0


def _series(n: float):
    n2, n3, n4 = n * n, n**3, n**4
    rect = (1.0 + n2 / 4.0 + n4 / 64.0) / (1.0 + n)  # rectifying radius / a
    alpha = (
        n / 2.0 - 2.0 * n2 / 3.0 + 5.0 * n3 / 16.0 + 41.0 * n4 / 180.0,
        13.0 * n2 / 48.0 - 3.0 * n3 / 5.0 + 557.0 * n4 / 1440.0,
        61.0 * n3 / 240.0 - 103.0 * n4 / 140.0,
        49561.0 * n4 / 161280.0,
    )
    beta = (
        n / 2.0 - 2.0 * n2 / 3.0 + 37.0 * n3 / 96.0 - n4 / 360.0,
        n2 / 48.0 + n3 / 15.0 - 437.0 * n4 / 1440.0,
        17.0 * n3 / 480.0 - 37.0 * n4 / 840.0,
        4397.0 * n4 / 161280.0,
    )
    delta = (
        2.0 * n - 2.0 * n2 / 3.0 - 2.0 * n3 + 116.0 * n4 / 45.0,
        7.0 * n2 / 3.0 - 8.0 * n3 / 5.0 - 227.0 * n4 / 45.0,
        56.0 * n3 / 15.0 - 136.0 * n4 / 35.0,
        4279.0 * n4 / 630.0,
    )
    return rect, alpha, beta, delta


_F = 1.0 / GRS80_INV_F
_N = _F / (2.0 - _F)
_RECT, _ALPHA, _BETA, _DELTA = _series(_N)


class _Col:
    sin, cos, sinh, cosh = map(staticmethod, (F.sin, F.cos, F.sinh, F.cosh))
    asin, atan, atan2, atanh, sqrt = map(staticmethod, (F.asin, F.atan, F.atan2, F.atanh, F.sqrt))

    @staticmethod
    def stage(**exprs):
        return tuple(exprs.values())


class _StagedCol(_Col):
    """Column math that projects each intermediate once.

    Intermediates are added as temporary columns in successive projections;
    Catalyst keeps those projections apart because each intermediate is
    used several times, so none is re-evaluated (and the generated code
    stays small).
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self.temps: list[str] = []

    def stage(self, **exprs):
        names = {f"__tm_{k}": v for k, v in exprs.items()}
        self.df = self.df.withColumns(names)
        self.temps += list(names)
        return tuple(F.col(n) for n in names)


class _Np:
    sin, cos, sinh, cosh = np.sin, np.cos, np.sinh, np.cosh
    asin, atan, atan2, atanh, sqrt = np.arcsin, np.arctan, np.arctan2, np.arctanh, np.sqrt

    @staticmethod
    def stage(**exprs):
        return tuple(exprs.values())


def _inverse(m, easting, northing, lon0_deg, k0, e0, n0):
    scale = k0 * GRS80_A * _RECT
    xi, eta = m.stage(xi=(northing - n0) / scale, eta=(easting - e0) / scale)
    xi_p, eta_p = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi_p = xi_p - b * m.sin(2.0 * j * xi) * m.cosh(2.0 * j * eta)
        eta_p = eta_p - b * m.cos(2.0 * j * xi) * m.sinh(2.0 * j * eta)
    xi_p, eta_p = m.stage(xi_p=xi_p, eta_p=eta_p)
    (chi,) = m.stage(chi=m.asin(m.sin(xi_p) / m.cosh(eta_p)))  # conformal latitude
    lat = chi
    for j, d in enumerate(_DELTA, start=1):
        lat = lat + d * m.sin(2.0 * j * chi)
    lon = m.atan2(m.sinh(eta_p), m.cos(xi_p))
    return lon * (180.0 / math.pi) + lon0_deg, lat * (180.0 / math.pi)


def _forward(m, lon_deg, lat_deg, lon0_deg, k0, e0, n0):
    phi, lam = m.stage(phi=lat_deg * (math.pi / 180.0), lam=(lon_deg - lon0_deg) * (math.pi / 180.0))
    c = 2.0 * math.sqrt(_N) / (1.0 + _N)  # equals the eccentricity e
    (t,) = m.stage(t=m.sinh(m.atanh(m.sin(phi)) - c * m.atanh(c * m.sin(phi))))
    xi_p, eta_p = m.stage(xi_p=m.atan(t / m.cos(lam)), eta_p=m.atanh(m.sin(lam) / m.sqrt(1.0 + t * t)))
    xi, eta = xi_p, eta_p
    for j, a in enumerate(_ALPHA, start=1):
        xi = xi + a * m.sin(2.0 * j * xi_p) * m.cosh(2.0 * j * eta_p)
        eta = eta + a * m.cos(2.0 * j * xi_p) * m.sinh(2.0 * j * eta_p)
    scale = k0 * GRS80_A * _RECT
    return e0 + scale * eta, n0 + scale * xi


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utm_to_lonlat(
    easting,
    northing,
    central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG,
    k0: float = UTM_K0,
    false_easting: float = UTM_FALSE_EASTING,
    false_northing: float = UTM_FALSE_NORTHING_NORTH,
) -> tuple[Column, Column]:
    """(longitude, latitude) columns in degrees from UTM easting/northing columns (metres)."""
    return _inverse(_Col, _c(easting), _c(northing), central_meridian_deg, k0, false_easting, false_northing)


def lonlat_to_utm(
    lon,
    lat,
    central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG,
    k0: float = UTM_K0,
    false_easting: float = UTM_FALSE_EASTING,
    false_northing: float = UTM_FALSE_NORTHING_NORTH,
) -> tuple[Column, Column]:
    """(easting, northing) columns in metres from longitude/latitude columns (degrees)."""
    return _forward(_Col, _c(lon), _c(lat), central_meridian_deg, k0, false_easting, false_northing)


def with_lonlat(
    df: DataFrame,
    easting: str = "utm_x",
    northing: str = "utm_y",
    lon_col: str = "longitude",
    lat_col: str = "latitude",
    central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG,
) -> DataFrame:
    """``df`` plus longitude/latitude columns from its UTM columns (staged projections)."""
    m = _StagedCol(df)
    lon, lat = _inverse(m, F.col(easting), F.col(northing), central_meridian_deg,
                        UTM_K0, UTM_FALSE_EASTING, UTM_FALSE_NORTHING_NORTH)
    return m.df.withColumns({lon_col: lon, lat_col: lat}).drop(*m.temps)


def with_utm(
    df: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    x_col: str = "utm_x",
    y_col: str = "utm_y",
    central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG,
) -> DataFrame:
    """``df`` plus UTM easting/northing columns from its longitude/latitude (staged projections)."""
    m = _StagedCol(df)
    x, y = _forward(m, F.col(lon), F.col(lat), central_meridian_deg,
                    UTM_K0, UTM_FALSE_EASTING, UTM_FALSE_NORTHING_NORTH)
    return m.df.withColumns({x_col: x, y_col: y}).drop(*m.temps)


def utm_to_lonlat_np(easting, northing, central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG):
    return _inverse(_Np, np.asarray(easting, float), np.asarray(northing, float), central_meridian_deg,
                    UTM_K0, UTM_FALSE_EASTING, UTM_FALSE_NORTHING_NORTH)


def lonlat_to_utm_np(lon, lat, central_meridian_deg: float = UTM30_CENTRAL_MERIDIAN_DEG):
    return _forward(_Np, np.asarray(lon, float), np.asarray(lat, float), central_meridian_deg,
                    UTM_K0, UTM_FALSE_EASTING, UTM_FALSE_NORTHING_NORTH)


def meridian_arc_np(lat_deg: float) -> float:
    """Meridian distance from the equator (metres, k0 = 1), via the forward series."""
    _, n = _forward(_Np, np.array([0.0]), np.array([float(lat_deg)]), 0.0, 1.0, 0.0, 0.0)
    return float(n[0])
