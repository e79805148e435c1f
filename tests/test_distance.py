"""The reference's scalar distance tests, run on the column expressions
(plus the numpy and pure-Python evaluations of the same formula).

Third-party geodesic checks are replaced by recorded haversine values
(R = 6,371,000 m)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from omphalos.functions.metrics import METRICS, euclidean_degrees, haversine, utm_distance

MADRID = (-3.7038, 40.4168)
BARCELONA = (2.1734, 41.3851)
PUERTA_DEL_SOL = (-3.7035, 40.4169)
PLAZA_MAYOR = (-3.7074, 40.4155)


def col_eval(spark, fn, *pairs):
    rows = [tuple(float(v) for p in pr for v in p) for pr in pairs]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    return [r[0] for r in df.select(fn("x1", "y1", "x2", "y2")).collect()]


def test_zero_distance_to_self(spark):
    for fn in (haversine, utm_distance, euclidean_degrees):
        assert col_eval(spark, fn, (MADRID, MADRID)) == [0.0]


def test_symmetry(spark):
    a, b = col_eval(spark, haversine, (MADRID, BARCELONA), (BARCELONA, MADRID))
    assert a == pytest.approx(b, rel=1e-15)


def test_madrid_barcelona(spark):
    (d,) = col_eval(spark, haversine, (MADRID, BARCELONA))
    assert d / 1000 == pytest.approx(505.4434712, abs=1e-6)


def test_short_distance_in_madrid(spark):
    (d,) = col_eval(spark, haversine, (PUERTA_DEL_SOL, PLAZA_MAYOR))
    assert d == pytest.approx(365.0285914, abs=1e-6)


def test_utm_is_planar_345(spark):
    assert col_eval(spark, utm_distance, ((0, 0), (3, 4))) == [5.0]


def test_euclidean_is_planar_345(spark):
    assert col_eval(spark, euclidean_degrees, ((0, 0), (3, 4))) == [5.0]


def test_one_degree_latitude(spark):
    (d,) = col_eval(spark, haversine, (MADRID, (MADRID[0], MADRID[1] + 1)))
    assert d / 1000 == pytest.approx(111.1949266, abs=1e-6)


def test_one_degree_longitude_shorter_than_latitude(spark):
    (d_lon,) = col_eval(spark, haversine, (MADRID, (MADRID[0] + 1, MADRID[1])))
    (d_lat,) = col_eval(spark, haversine, (MADRID, (MADRID[0], MADRID[1] + 1)))
    assert d_lon / 1000 == pytest.approx(84.6576096, abs=1e-6)
    assert d_lon < 0.8 * d_lat


def test_longitude_ratio_is_cos_latitude(spark):
    (d_lon,) = col_eval(spark, haversine, (MADRID, (MADRID[0] + 0.01, MADRID[1])))
    (d_lat,) = col_eval(spark, haversine, (MADRID, (MADRID[0], MADRID[1] + 0.01)))
    assert d_lon / d_lat == pytest.approx(math.cos(math.radians(MADRID[1])), abs=0.02)


def test_euclidean_degrees_ignores_foreshortening(spark):
    a, b = col_eval(spark, euclidean_degrees, (MADRID, (MADRID[0] + 1, MADRID[1])), (MADRID, (MADRID[0], MADRID[1] + 1)))
    assert a == b == 1.0


def test_antipodes_clamped_no_nan(spark):
    rng = np.random.default_rng(7)
    lon = rng.uniform(-180, 180, 2000)
    lat = rng.uniform(-89, 89, 2000)
    lon2 = np.where(lon > 0, lon - 180, lon + 180)
    pairs = [((0.0, 0.0), (180.0, 0.0))] + [((a, b), (c, -b)) for a, b, c in zip(lon, lat, lon2)]
    out = np.array(col_eval(spark, haversine, *pairs))
    assert not np.isnan(out).any()
    assert np.allclose(out, math.pi * 6_371_000, rtol=1e-7)  # ill-conditioned at the antipode, but finite
    npv = METRICS["haversine"].numpy(lon, lat, lon2, -lat)
    assert not np.isnan(npv).any()


def test_null_coordinate_gives_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "x1 double, y1 double, x2 double, y2 double")
    assert df.select(haversine("x1", "y1", "x2", "y2")).first()[0] is None


def test_three_evaluations_agree():
    rng = np.random.default_rng(1)
    a = rng.uniform(-10, 10, (4, 500))
    for m in METRICS.values():
        v = m.numpy(*a)
        s = np.array([m.scalar(*col) for col in a.T])
        assert np.allclose(v, s, rtol=1e-13, atol=1e-9)


def test_cos_scale(spark):
    from omphalos.functions.metrics import longitude_scale
    v = spark.range(1).select(longitude_scale(F.lit(60.0))).first()[0]
    assert v == pytest.approx(0.5)
