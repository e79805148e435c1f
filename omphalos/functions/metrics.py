"""Distance metrics as one formula each, evaluated three ways.

Every formula is written once against a small math namespace, so the same
text yields a Spark ``Column`` (JVM-side, whole-stage codegen), a numpy
array expression (for the pandas UDF) and a plain float (for the row UDF).

Argument order is always (x1, y1, x2, y2) with x = longitude / easting and
y = latitude / northing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
EARTH_RADIUS_M = 6_371_000.0  # mean Earth radius used by the haversine metric
NAIVE_METRES_PER_DEGREE = 111_320.0  # the "1 degree = 111,320 m" shortcut being criticised
FAR_FROM_MEDIAN_M = 20_000.0  # threshold of the "far from median" share


class _ColumnMath:
    sin = staticmethod(F.sin)
    cos = staticmethod(F.cos)
    sqrt = staticmethod(F.sqrt)
    atan2 = staticmethod(F.atan2)
    radians = staticmethod(F.radians)

    @staticmethod
    def at_most_one(a):
        # not F.least: it skips nulls, which would turn a null coordinate into pi * R
        return F.when(a > F.lit(1.0), F.lit(1.0)).otherwise(a)


class _NumpyMath:
    sin = staticmethod(np.sin)
    cos = staticmethod(np.cos)
    sqrt = staticmethod(np.sqrt)
    atan2 = staticmethod(np.arctan2)
    radians = staticmethod(np.radians)

    @staticmethod
    def at_most_one(a):
        return np.minimum(a, 1.0)


class _ScalarMath:
    sin = staticmethod(math.sin)
    cos = staticmethod(math.cos)
    sqrt = staticmethod(math.sqrt)
    atan2 = staticmethod(math.atan2)
    radians = staticmethod(math.radians)

    @staticmethod
    def at_most_one(a):
        return min(a, 1.0)


COLUMN_MATH = _ColumnMath()
NUMPY_MATH = _NumpyMath()
SCALAR_MATH = _ScalarMath()


def _planar(m, x1, y1, x2, y2):
    dx = x2 - x1
    dy = y2 - y1
    return m.sqrt(dx * dx + dy * dy)


def _haversine(m, lon1, lat1, lon2, lat2):
    phi1 = m.radians(lat1)
    phi2 = m.radians(lat2)
    half_dphi = m.sin(m.radians(lat2 - lat1) / 2.0)
    half_dlam = m.sin(m.radians(lon2 - lon1) / 2.0)
    # Rounding can push `a` just above 1 for antipodal points; clamp so
    # sqrt(1 - a) stays real (the distance is then exactly pi * R).
    a = m.at_most_one(half_dphi * half_dphi + m.cos(phi1) * m.cos(phi2) * half_dlam * half_dlam)
    return 2.0 * EARTH_RADIUS_M * m.atan2(m.sqrt(a), m.sqrt(1.0 - a))


@dataclass(frozen=True)
class Metric:
    """A named distance: its formula, its unit and whether it is spherical."""

    name: str
    formula: Callable
    unit: str
    spherical: bool

    def column(self, x1, y1, x2, y2) -> Column:
        return self.formula(COLUMN_MATH, _col(x1), _col(y1), _col(x2), _col(y2))

    def numpy(self, x1, y1, x2, y2):
        return self.formula(NUMPY_MATH, x1, y1, x2, y2)

    def scalar(self, x1: float, y1: float, x2: float, y2: float) -> float:
        return self.formula(SCALAR_MATH, x1, y1, x2, y2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


METRICS: dict[str, Metric] = {
    # planar distance on longitude/latitude degrees: deliberately wrong, in degrees
    "euclidean": Metric("euclidean", _planar, "deg", False),
    "haversine": Metric("haversine", _haversine, "m", True),
    # planar distance on projected metres (UTM zone 30N in the reference data)
    "utm": Metric("utm", _planar, "m", False),
}

# Which coordinate columns each metric reads in a centers table.
COORDINATE_COLUMNS: dict[str, tuple[str, str]] = {
    "euclidean": ("longitude", "latitude"),
    "haversine": ("longitude", "latitude"),
    "utm": ("utm_x", "utm_y"),
}


def get_metric(metric: str | Metric | Callable) -> Metric:
    """Resolve a metric name, a ``Metric`` or a user callable ``(Column x4) -> Column``."""
    if isinstance(metric, Metric):
        return metric
    if isinstance(metric, str):
        if metric not in METRICS:
            raise ValueError(f"Unknown metric: {metric!r}. Use one of {sorted(METRICS)}.")
        return METRICS[metric]
    if callable(metric):
        fn = metric
        return Metric(getattr(fn, "__name__", "custom"), lambda m, a, b, c, d: _custom(m, fn, a, b, c, d), "?", False)
    raise ValueError(f"Unknown metric: {metric!r}")


def _custom(m, fn, x1, y1, x2, y2):
    """The caller's function gets columns natively, numpy arrays under the pandas
    UDF (for functions that exist in Python only) and floats under the row UDF."""
    return fn(x1, y1, x2, y2)


# Column builders.
def euclidean_degrees(lon1, lat1, lon2, lat2) -> Column:
    return METRICS["euclidean"].column(lon1, lat1, lon2, lat2)


def haversine(lon1, lat1, lon2, lat2) -> Column:
    return METRICS["haversine"].column(lon1, lat1, lon2, lat2)


def utm_distance(x1, y1, x2, y2) -> Column:
    return METRICS["utm"].column(x1, y1, x2, y2)


def naive_degrees_to_metres(deg) -> Column:
    return _col(deg) * F.lit(NAIVE_METRES_PER_DEGREE)


def percent_error(estimate, truth) -> Column:
    """(estimate - truth) / truth * 100; null when truth is 0."""
    return F.try_divide(_col(estimate) - _col(truth), _col(truth)) * F.lit(100.0)


def metres_to_km(m) -> Column:
    return _col(m) / F.lit(1000.0)


def longitude_scale(lat) -> Column:
    """Length of a degree of longitude relative to a degree of latitude: cos(lat)."""
    return F.cos(F.radians(_col(lat)))
