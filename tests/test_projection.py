import numpy as np
import pytest
from pyspark.sql import functions as F

from omphalos.functions.projection import (
    lonlat_to_utm_np, meridian_arc_np, utm_to_lonlat, utm_to_lonlat_np, with_lonlat, with_utm,
)


def test_puerta_del_sol_forward():
    e, n = lonlat_to_utm_np([-3.7035], [40.4169])
    assert e[0] == pytest.approx(440315.9983, abs=1e-4)
    assert n[0] == pytest.approx(4474268.2792, abs=1e-4)


def test_meridian_arc():
    assert meridian_arc_np(45.0) == pytest.approx(4984944.378, abs=1e-3)


def test_round_trip_numpy():
    rng = np.random.default_rng(0)
    lon, lat = rng.uniform(-6, 0, 20000), rng.uniform(36, 44, 20000)
    lo, la = utm_to_lonlat_np(*lonlat_to_utm_np(lon, lat))
    assert np.abs(lo - lon).max() < 1e-10
    assert np.abs(la - lat).max() < 1e-10


def test_columns_match_numpy(spark):
    rng = np.random.default_rng(3)
    pts = [(float(x), float(y)) for x, y in zip(rng.uniform(400000, 480000, 200), rng.uniform(4.4e6, 4.55e6, 200))]
    df = spark.createDataFrame(pts, "utm_x double, utm_y double")
    got = with_lonlat(df).toPandas()
    lo, la = utm_to_lonlat_np(got.utm_x, got.utm_y)
    assert np.allclose(got.longitude, lo, atol=1e-12)
    assert np.allclose(got.latitude, la, atol=1e-12)
    back = with_utm(with_lonlat(df).drop("utm_x", "utm_y")).toPandas()
    assert np.allclose(back.utm_x.sort_values().values, np.sort([p[0] for p in pts]), atol=1e-6)
    lon, lat = utm_to_lonlat("utm_x", "utm_y")
    inline = df.select(lon.alias("a"), lat.alias("b")).toPandas()
    assert np.allclose(inline.a, lo, atol=1e-12)


def test_staged_projection_has_no_udf(spark):
    df = spark.createDataFrame([(440315.9983, 4474268.2792)], "utm_x double, utm_y double")
    plan = with_lonlat(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    lon, lat = with_lonlat(df).select("longitude", "latitude").first()
    assert lon == pytest.approx(-3.7035, abs=1e-9) and lat == pytest.approx(40.4169, abs=1e-9)
    assert F  # keep the import used
