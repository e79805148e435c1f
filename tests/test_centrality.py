"""Centroid and medoid operators on hand-written fixtures (ties, nulls, NaN,
singletons, outliers, duplicate ids, identical coordinates, empty input)
and the staged medoid against the brute-force definition."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from omphalos.operators.central import most_central
from omphalos.operators.centroid import distance_to_centroid, nearest_to_centroid
from omphalos.operators.medoid import medoid

SCHEMA = "center_id string, g string, x double, y double"


def picks(df, col="center_id"):
    return sorted((r["g"], r[col]) for r in df.collect())


def fixture(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_tie_all_and_first(spark):
    df = fixture(spark, [("b2", "b", 7.0, 7.0), ("b1", "b", 5.0, 5.0)])
    for method in ("centroid", "medoid"):
        allp = most_central(df, "g", "center_id", "x", "y", "utm", method, ties="all")
        assert picks(allp) == [("b", "b1"), ("b", "b2")]
        first = most_central(df, "g", "center_id", "x", "y", "utm", method, ties="first")
        assert picks(first) == [("b", "b1")]


def test_null_nan_and_null_group_never_picked(spark):
    rows = [("a1", "a", 0.0, 0.0), ("a2", "a", 2.0, 0.0), ("a3", "a", 1.0, 0.1),
            ("bad", "a", None, 1.0), ("nan", "a", float("nan"), 1.0), ("ng", None, 1.0, 0.0)]
    df = fixture(spark, rows)
    c = nearest_to_centroid(df, "g", "x", "y", "utm")
    assert picks(c) == [("a", "a3")]
    assert c.first()["distance"] == pytest.approx(0.2 / 3)  # mean is (1, 0.1/3)
    m = medoid(df, "g", "center_id", "x", "y", "utm")
    assert picks(m) == [("a", "a3")]
    d = distance_to_centroid(df, "g", "x", "y", "utm").collect()
    assert len(d) == 5  # null group dropped
    assert {r["center_id"] for r in d if r["distance"] is None} == {"bad", "nan"}


def test_singleton(spark):
    df = fixture(spark, [("s", "s", 3.0, 4.0)])
    c = nearest_to_centroid(df, "g", "x", "y", "haversine").first()
    assert c["center_id"] == "s" and c["distance"] == 0.0
    m = medoid(df, "g", "center_id", "x", "y", "haversine").first()
    assert m["center_id"] == "s" and m["total_distance"] == 0.0


def test_outlier_moves_centroid_not_medoid(spark):
    rows = [(f"p{i}", "o", float(i % 3), float(i // 3)) for i in range(9)] + [("far", "o", 100.0, 100.0)]
    df = fixture(spark, rows)
    c = picks(nearest_to_centroid(df, "g", "x", "y", "utm"))
    m = picks(medoid(df, "g", "center_id", "x", "y", "utm"))
    assert m == [("o", "p4")]
    assert c != m


def test_duplicate_id_check(spark):
    df = fixture(spark, [("d", "g", 0.0, 0.0), ("d", "g", 1.0, 1.0)])
    with pytest.raises(ValueError, match="not unique"):
        medoid(df, "g", "center_id", "x", "y", "utm", check_unique=True)


def test_identical_coordinates_all_tie(spark):
    rows = [(f"c{i}", "k", 1.0, 1.0) for i in range(4)] + [("o1", "k", 0.0, 0.0), ("o2", "k", 2.0, 2.5)]
    df = fixture(spark, rows)
    assert [p[1] for p in picks(medoid(df, "g", "center_id", "x", "y", "utm"))] == ["c0", "c1", "c2", "c3"]
    assert picks(medoid(df, "g", "center_id", "x", "y", "utm", ties="first")) == [("k", "c0")]


def test_empty_input_keeps_schema(spark):
    df = fixture(spark, [])
    c = nearest_to_centroid(df, "g", "x", "y", "utm")
    m = medoid(df, "g", "center_id", "x", "y", "utm")
    assert c.count() == 0 and m.count() == 0
    assert "distance" in c.columns and "total_distance" in m.columns


def test_column_clash_rejected(spark):
    df = spark.createDataFrame([("a", "g", 0.0, 0.0, 1.0)], SCHEMA + ", distance double")
    with pytest.raises(ValueError, match="already has columns"):
        nearest_to_centroid(df, "g", "x", "y", "utm")


def test_unknown_arguments(spark):
    df = fixture(spark, [("a", "g", 0.0, 0.0)])
    for kw in ({"metric": "manhattan"}, {"method": "mode"}, {"implementation": "jit"}, {"ties": "some"}):
        with pytest.raises(ValueError):
            most_central(df, "g", "center_id", "x", "y", **{**{"metric": "utm"}, **kw}).collect()


def test_three_implementations_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(f"i{i}", f"g{i % 4}", float(rng.uniform(-4, -3)), float(rng.uniform(40, 41))) for i in range(400)]
    df = fixture(spark, rows)
    out = {}
    for impl in ("native", "udf", "pandas_udf"):
        r = distance_to_centroid(df, "g", "x", "y", "haversine", impl).select("center_id", "distance").collect()
        out[impl] = dict((a, b) for a, b in r)
    for k, v in out["native"].items():
        assert out["udf"][k] == pytest.approx(v, rel=1e-12)
        assert out["pandas_udf"][k] == pytest.approx(v, rel=1e-12)


def _brute(rows, metric):
    from omphalos.functions.metrics import METRICS
    m = METRICS[metric]
    best = {}
    groups = {}
    for cid, g, x, y in rows:
        groups.setdefault(g, []).append((cid, x, y))
    for g, pts in groups.items():
        xs = np.array([p[1] for p in pts])
        ys = np.array([p[2] for p in pts])
        tot = [float(np.sum(m.numpy(np.full_like(xs, x), np.full_like(ys, y), xs, ys))) for _, x, y in pts]
        lo = min(tot)
        best[g] = (sorted(p[0] for p, t in zip(pts, tot) if t <= lo * (1 + 1e-12) + 1e-9), lo)
    return best


@pytest.mark.parametrize("metric,shape", [("utm", "clustered"), ("haversine", "uniform"), ("euclidean", "ring")])
def test_staged_medoid_equals_brute_force(spark, metric, shape):
    rng = np.random.default_rng(11)
    rows = []
    for g, n in (("big", 3000), ("mid", 400), ("tiny", 3)):
        if shape == "clustered":
            c = rng.normal(0, 1, (n, 2)) * np.where(rng.uniform(size=(n, 1)) < 0.8, 500, 8000)
            xy = c + [440000, 4474000]
        elif shape == "uniform":
            xy = np.c_[rng.uniform(-4.5, -3, n), rng.uniform(40, 41, n)]
        else:
            a = rng.uniform(0, 2 * math.pi, n)
            xy = np.c_[-3.7 + np.cos(a) * rng.uniform(0.9, 1, n), 40.4 + np.sin(a) * rng.uniform(0.9, 1, n)]
        rows += [(f"{g}{i}", g, float(x), float(y)) for i, (x, y) in enumerate(xy)]
    # a hot location: many copies of one point
    rows += [(f"copy{i}", "big", rows[0][2], rows[0][3]) for i in range(500)]
    df = fixture(spark, rows)
    stats = {}
    got = medoid(df, "g", "center_id", "x", "y", metric, stats=stats).collect()
    want = _brute(rows, metric)
    for g, (ids, tot) in want.items():
        mine = sorted(r["center_id"] for r in got if r["g"] == g)
        assert mine == ids, g
        assert [r["total_distance"] for r in got if r["g"] == g][0] == pytest.approx(tot, rel=1e-9)
    assert stats["candidates"] < len(rows)


def _all_pairs(rows, dist):
    best = {}
    for g in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == g]
        xs, ys = (np.array([r[k] for r in own]) for k in (2, 3))
        tot = [float(np.sum(dist(x, y, xs, ys))) for _, _, x, y in own]
        best[g] = sorted(r[0] for r, t in zip(own, tot) if t <= min(tot) * (1 + 1e-12))
    return sorted((g, i) for g, ids in best.items() for i in ids)


@pytest.mark.parametrize("name", ["manhattan", "railway", "discrete"])
@pytest.mark.parametrize("implementation", ["native", "pandas_udf"])
def test_medoid_of_any_metric(spark, monkeypatch, name, implementation):
    """Distances without an embedding: by the sums of axes, by way of the origin, and 0 or 1."""
    from omphalos.operators import medoid as module

    native = implementation == "native"
    size, root, choose = (F.abs, F.sqrt, lambda c, a, b: F.when(c, a).otherwise(b)) if native else (np.abs, np.sqrt, np.where)
    one = (lambda v: F.lit(v)) if native else (lambda v: v)
    radius = lambda x, y: root(x * x + y * y)
    forms = {
        "manhattan": lambda a, b, c, d: size(a - c) + size(b - d),
        "railway": lambda a, b, c, d: choose((a == c) & (b == d), one(0.0), radius(a, b) + radius(c, d)),
        "discrete": lambda a, b, c, d: choose((a == c) & (b == d), one(0.0), one(1.0)),
    }
    np_choose, np_radius = np.where, lambda x, y: np.sqrt(x * x + y * y)
    plain = {
        "manhattan": lambda a, b, c, d: np.abs(a - c) + np.abs(b - d),
        "railway": lambda a, b, c, d: np_choose((a == c) & (b == d), 0.0, np_radius(a, b) + np_radius(c, d)),
        "discrete": lambda a, b, c, d: np_choose((a == c) & (b == d), 0.0, 1.0),
    }
    monkeypatch.setattr(module, "TARGET", 4)
    rng = np.random.default_rng(6)
    rows = [(f"p{i:03}", "big" if i < 330 else f"g{i % 3}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 5, (400, 2)))]
    rows += [(f"copy{k}", "big", rows[7][2], rows[7][3]) for k in range(5)]
    df = fixture(spark, rows + [("bad", "big", float("nan"), 1.0), ("lost", None, 0.0, 0.0)])
    got = medoid(df, "g", "center_id", "x", "y", forms[name], tie_decimals=6, implementation=implementation)
    assert picks(got) == _all_pairs(rows, plain[name])


@pytest.mark.parametrize("limit", [0, 200_000])
def test_distances_to_outer_members_leave_few_candidates_of_any_metric(spark, monkeypatch, limit):
    """Cells bound a distance that isn't built in."""
    from omphalos.operators import medoid as module

    monkeypatch.setattr(module, "TARGET", 4)
    rng = np.random.default_rng(12)
    rows = [(f"p{i:04}", "a" if i % 3 else "b", float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-50, 50, (3000, 2)))]
    rows += [(f"copy{k}", "a", rows[7][2], rows[7][3]) for k in range(5)] + [("alone", "c", 1.0, 2.0)]
    stats = {}
    sides = lambda a, b, c, d: F.abs(a - c) + F.abs(b - d)
    got = medoid(fixture(spark, rows), "g", "center_id", "x", "y", sides, tie_decimals=6, stats=stats,
                 broadcast_rows=limit, pairs_per_task=100_000)
    assert picks(got) == _all_pairs(rows, lambda a, b, c, d: np.abs(a - c) + np.abs(b - d))
    assert stats["cells"] > 0 and stats["rounds"] >= 1 and stats["candidates"] < 60


def test_a_distance_that_is_no_metric_is_summed_for_all(spark):
    square = lambda a, b, c, d: (a - c) * (a - c) + (b - d) * (b - d)
    rng = np.random.default_rng(3)
    rows = [(f"p{i:03}", f"g{i % 2}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 5, (150, 2)))]
    got = medoid(fixture(spark, rows), "g", "center_id", "x", "y", square, bound="none")
    assert picks(got) == _all_pairs(rows, square)


@pytest.mark.parametrize("limit", [0, 200_000])
def test_rounds_split_cells_until_few_candidates_are_left(spark, monkeypatch, limit):
    from omphalos.operators import medoid as module

    monkeypatch.setattr(module, "TARGET", 2)
    rng = np.random.default_rng(21)
    rows = [(f"p{i:04}", "a" if i % 3 else "b", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 4000, (3000, 2)))]
    stats = {}
    got = medoid(fixture(spark, rows), "g", "center_id", "x", "y", "utm", first_grid=4, stats=stats, broadcast_rows=limit, pairs_per_task=100_000)
    assert picks(got) == [(g, ids[0]) for g, (ids, _) in sorted(_brute(rows, "utm").items())]
    assert stats["rounds"] >= 2 and stats["candidates"] < 60


def test_salted_final_stage_matches(spark):
    rng = np.random.default_rng(2)
    rows = [(f"p{i}", f"g{i % 2}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (1200, 2)))]
    df = fixture(spark, rows)
    a = picks(medoid(df, "g", "center_id", "x", "y", "utm"))
    b = picks(medoid(df, "g", "center_id", "x", "y", "utm", broadcast_rows=0, pairs_per_task=1000))
    assert a == b == [(g, ids[0]) for g, (ids, _) in sorted(_brute(rows, "utm").items())]


def test_medoid_ties_under_rounding_keep_every_row(spark):
    """Totals 30.1 and 30.2 are one at no decimals; neither may be pruned before."""
    rows = [("a", "g", 0.0, 0.0), ("b", "g", 0.1, 0.0), ("c", "g", 10.0, 0.0), ("d", "g", -10.0, 0.0), ("e", "g", -10.0, 0.0)]
    df = fixture(spark, rows)
    for grid in (1, 32):
        got = medoid(df, "g", "center_id", "x", "y", "utm", tie_decimals=0, first_grid=grid)
        assert [i for _, i in picks(got)] == ["a", "b"]
    assert picks(medoid(df, "g", "center_id", "x", "y", "utm")) == [("g", "a")]


@pytest.mark.parametrize("n", [3, 5, 8])
def test_medoid_ties_of_a_polygon_are_not_float_noise(spark, n):
    rows = [(f"{i}", "g", 440000 + 1000 * math.cos(2 * math.pi * i / n), 4474000 + 1000 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    df = fixture(spark, rows)
    assert picks(most_central(df, "g", "center_id", "x", "y", "utm", "medoid", ties="first")) == [("g", "0")]
    assert len(picks(medoid(df, "g", "center_id", "x", "y", "utm"))) == n


def test_medoid_pick_survives_coordinates_that_are_evaluated_again(spark):
    """Each evaluation adds noise far below a rounding step, as a second evaluation of a projection may."""
    from pyspark.sql import functions as F

    rows = [(f"p{i}", f"g{i % 3}", 1000.0 * (i % 7) + i, 500.0 * (i % 5)) for i in range(90)]
    df = fixture(spark, rows).withColumn("x", F.col("x") + F.rand() * 1e-9)
    got = medoid(df, "g", "center_id", "x", "y", "utm", ties="first").collect()
    assert sorted(r["g"] for r in got) == ["g0", "g1", "g2"]


def test_medoid_evaluates_other_columns_for_picked_rows_only(spark):
    rows = [(f"p{i}", f"g{i % 2}", float(i % 7), float(i % 5)) for i in range(400)]
    seen = spark.sparkContext.accumulator(0)

    def label(i):
        seen.add(1)
        return "row " + i

    df = fixture(spark, rows).withColumn("label", F.udf(label, "string")("center_id"))
    got = medoid(df, "g", "center_id", "x", "y", "utm").collect()
    assert sorted(r["label"] for r in got) == sorted("row " + i for g in _brute(rows, "utm").values() for i in g[0])
    assert seen.value == len(got) < len(rows)


def test_infinite_coordinates_take_no_part(spark):
    rows = [("a", "g", 1.0, 1.0), ("b", "g", 2.0, 2.0), ("c", "g", 3.0, 3.0), ("z", "g", float("inf"), 1.0), ("y", "g", 1.0, float("-inf"))]
    df = fixture(spark, rows)
    assert picks(nearest_to_centroid(df, "g", "x", "y", "utm")) == [("g", "b")]
    assert picks(medoid(df, "g", "center_id", "x", "y", "utm")) == [("g", "b")]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_centroid_pick_moves_no_rows_behind_a_broadcast(spark, limit, monkeypatch):
    """Both ways give the same picks; with small per-group tables no exchange carries the rows."""
    from omphalos.operators import attach

    monkeypatch.setattr(attach.Small.__init__, "__defaults__", (limit,))
    rng = np.random.default_rng(8)
    rows = [(f"p{i:04}", "hot" if i % 3 else f"g{i % 50}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 9, (900, 2)))]
    got = nearest_to_centroid(fixture(spark, rows), "g", "x", "y", "utm")
    want = {}
    for g in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == g]
        cx, cy = np.mean([r[2] for r in own]), np.mean([r[3] for r in own])
        want[g] = min(own, key=lambda r: (r[2] - cx) ** 2 + (r[3] - cy) ** 2)[0]
    assert {r["g"]: r["center_id"] for r in got.collect()} == want
    if limit:
        plan = got._jdf.queryExecution().executedPlan().toString()
        below = [plan[m.end():].split("\n")[1] for m in re.finditer("Exchange hashpartitioning", plan)]
        assert below and all("partial_min" in line for line in below) and "BroadcastHashJoin" in plan


def test_hot_groups_are_dealt_in_proportion(spark, monkeypatch):
    """A group of a third of all rows goes to as many tasks as it has shares; the others to one each."""
    from omphalos.operators import attach

    monkeypatch.setattr(attach, "SHARE", 50)
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 100).cast("string"))).alias("g"), "id")
    assert [tuple(r) for r in attach.hot_groups(rows, ["g"]).collect()] == [("hot", 6)]
    few = attach.Small(rows.groupBy("g").agg(F.count("*").alias("n")), limit=0)
    assert not few.local
    assert few.join(rows, "g").select("id", "n").distinct().count() == 900
    monkeypatch.setattr(attach, "MOST_HOT", 1)
    assert attach.hot_groups(rows, ["g"]).collect() == []
