import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from omphalos.operators import stats
from omphalos.operators.stats import group_median
from omphalos.plans import layers, reports
from omphalos.sources import clean, io

from .conftest import SF


def test_strip_matches_python_str_strip(spark):
    chars = [chr(c) for c in range(0, 0x3001) if not (0xD800 <= c <= 0xDFFF)]
    spaces = [c for c in chars if c.isspace()]
    probes = [f"{c}a{c}" for c in chars if c != "\x00"]
    df = spark.createDataFrame([(p,) for p in probes], "s string")
    got = [r[0] for r in df.select(clean.strip_text("s")).collect()]
    want = [p.strip() for p in probes]
    assert got == want
    assert " " in spaces


def test_clean_records_fixture(spark):
    raw = [
        {"CODIGO": "1", "SITUACIÓN": "ALTA", "CENTRO": " \t a \n ", "TITULARIDAD": "PUBLICO",
         "UTM_X": "440315.9983", "UTM_Y": "4474268.2792"},
        {"CODIGO": "2", "SITUACIÓN": "ALTA", "CENTRO": "b", "TITULARIDAD": "PUBLICO", "UTM_X": "", "UTM_Y": "1"},
        {"CODIGO": "3", "SITUACIÓN": "BAJA", "CENTRO": "c", "TITULARIDAD": "PUBLICO", "UTM_X": "1", "UTM_Y": "1"},
        {"CODIGO": "4", "SITUACIÓN": "ALTA", "CENTRO": "d", "TITULARIDAD": "PUBLICO", "UTM_X": "abc", "UTM_Y": "1"},
        {"CODIGO": "5", "CENTRO": "e", "UTM_X": "1", "UTM_Y": "1"},
    ]
    path = tempfile.mkdtemp(prefix="omphalos-raw-") + "/raw.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"data": raw}, f, ensure_ascii=False, indent=1)
    df = io.load_raw_records(spark, path)
    out = clean.clean_records(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r["center_name"] == "a" and r["center_id"] == "1" and r["municipality"] == ""
    assert r["longitude"] == pytest.approx(-3.7035, abs=1e-9) and r["latitude"] == pytest.approx(40.4169, abs=1e-9)
    counts = {r["outcome"]: r["rows"] for r in clean.reject_counts(df).collect()}
    assert counts == {"kept": 1, "missing coordinate": 1, "inactive": 2, "bad coordinate": 1}
    kept, seen = clean.clean_observed(df)
    assert kept.collect() == out
    assert seen.get == counts | {"blank name": 0}
    kept, seen = clean.clean_observed(df.where("false"))
    assert kept.collect() == [] and set(seen.get.values()) == {0}
    with pytest.raises(Exception, match="not a number"):
        clean.clean_records(df, on_bad="fail").collect()


@pytest.mark.parametrize("pick", ["max", "min"])
def test_median_exact_whatever_the_sketch_says(spark, monkeypatch, pick):
    """A sketch that always names an extreme value: brackets miss, selection by rounds still finds the middle."""
    rng = np.random.default_rng(4)
    groups = {"even": rng.normal(size=20), "odd": np.exp(rng.normal(0, 2, 21)), "ties": np.repeat([1.0, 2.0, 5.0], 30), "ends": np.array([-np.inf, -np.inf, 0.0, np.inf])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in rng.permutation(vs)]
    df = spark.createDataFrame(rows, "g string, v double")
    monkeypatch.setattr(stats.F, "percentile_approx", lambda c, ps, accuracy: F.array(*[getattr(F, pick)(c)] * len(ps)))
    got = {r["g"]: r["median_v"] for r in group_median(df, "g", ["v"]).collect()}
    assert got == {g: np.median(v) for g, v in groups.items()}


def test_median_exact_even_odd(spark):
    rows = [("a", v) for v in (1.0, 2.0, 4.0, 8.0)] + [("b", v) for v in (5.0, 1.0, 3.0)] + [("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median_v"] for r in group_median(df, "g", ["v"]).collect()}
    assert got["a"] == 3.0 and got["b"] == 3.0 and "c" not in got


def test_median_large_group_with_small_sketch(spark):
    rng = np.random.default_rng(4)
    vals = np.round(rng.lognormal(0, 2, 20001), 3)
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, v double")
    got = group_median(df, "g", ["v"], accuracy=100).first()["median_v"]
    assert got == float(np.median(vals))


def test_write_and_load_round_trip(spark):
    df = spark.createDataFrame([("1", "n", "t", "G", "m", "e", 1.0, 2.0, 3.0, 4.0)], io.CENTERS_SCHEMA)
    base = tempfile.mkdtemp(prefix="omphalos-io-")
    for fmt in ("json", "csv", "parquet"):
        io.write_result(df, f"{base}/{fmt}", fmt, single_file=True)
    assert io.load_centers(spark, f"{base}/json", "jsonl").collect() == df.collect()
    assert io.load_centers(spark, f"{base}/parquet", "parquet").collect() == df.collect()
    assert io.load_centers(spark, f"{base}/csv", "csv").collect() == df.collect()
    with pytest.raises(ValueError):
        io.write_result(df, f"{base}/x", "xml")
    arr = f"{base}/array.json"
    with open(arr, "w") as f:
        json.dump([df.first().asDict()], f, indent=2)
    assert io.load_centers(spark, arr).collect() == df.collect()


def test_replicate(spark):
    df = spark.range(5).withColumnRenamed("id", "id")
    assert io.replicate(df, 1).count() == 5
    assert io.replicate(df, 0).count() == 5
    assert io.replicate(df, 7).count() == 35


def _centers(spark):
    from omphalos.sources.points import customer_centers
    return customer_centers(spark, SF)


def test_reports_shapes(spark):
    c = _centers(spark)
    assert reports.cross_validate_metrics(c).count() == 5
    r = reports.naive_degree_error(c).collect()
    assert all(x["error_pct"] is not None for x in r)
    d = reports.drop_farthest_shift(c).collect()
    assert all(x["centroid_shift_m"] > 0 for x in d)


def test_drop_farthest_singleton_is_null(spark):
    rows = [("a", "s", 1.0, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "center_id string, ownership string, utm_x double, utm_y double, "
                                     "longitude double, latitude double")
    r = reports.drop_farthest_shift(df).first()
    assert r["centroid_shift_m"] is None and r["farthest_id"] == "a"


def test_membership_check(spark):
    c = _centers(spark)
    from omphalos.operators.centroid import nearest_to_centroid
    p = nearest_to_centroid(c, "ownership", "utm_x", "utm_y", "utm")
    r = layers.membership_check(p, c, ["ownership", "center_id"]).first()
    assert r["missing"] == 0 and r["matched"] == r["picks"] == 5
    fake = p.withColumn("center_id", F.lit(-1))
    assert layers.membership_check(fake, c, ["ownership", "center_id"]).first()["missing"] == 5


def test_no_cross_join_or_python_in_native_plans(spark):
    c = _centers(spark)
    from omphalos.operators.centroid import nearest_to_centroid
    plan = nearest_to_centroid(c, "ownership", "longitude", "latitude", "haversine")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
