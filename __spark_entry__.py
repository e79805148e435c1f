"""

Every query reads the driver's parquet tables (through the point views in
``omphalos.sources.points``) and returns a DataFrame; the matching oracle
is DuckDB SQL over the same tables. Doubles are rounded in both (metres to
3 decimals, degrees to 9, ratios to 6) so the value hashes compare exactly.
The medoid oracles are the all-pairs definition, which DuckDB can afford
at sf0.01; the Spark side never builds all pairs.
"""

from __future__ import annotations

import importlib
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omphalos.functions import projection as proj
from omphalos.functions.metrics import longitude_scale
from omphalos.operators.attach import Small
from omphalos.operators.central import most_central
from omphalos.operators.centroid import distance_to_centroid, nearest_to_centroid
from omphalos.operators.medoid import medoid
from omphalos.operators.stats import distinct_groups, group_median, group_sizes
from omphalos.plans import layers, reports
from omphalos.session import scratch_dir
from omphalos.sources import clean, io
from omphalos.sources import points as pts


def _optional(module: str):
    """The module, or None where its folder isn't there; faults inside it are not hidden."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as missing:
        if missing.name is None or not (module + ".").startswith(missing.name + "."):
            raise
        return None


#: The corpus operators come as a folder and a file that may be absent.
CORPUS = _optional("omphalos.llm.entries")
PIPELINE = _optional("corpus_pipeline") if CORPUS else None

SF_SMOKE = "/root/testdata/sf0.001"
M, DEG, RATIO = 3, 9, 6


# ====================================================================== Spark

def _round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _centroid(view, metric, implementation="native", ties="all"):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        c = view(spark, sf)
        x, y = ("utm_x", "utm_y") if metric == "utm" else ("longitude", "latitude")
        out = nearest_to_centroid(c, "ownership", x, y, metric, implementation, ties, id_col="center_id")
        return _round(out.select("ownership", "center_id", "distance"), {"distance": DEG if metric == "euclidean" else M})
    return q


def _medoid(view, metric, ties="all", x="utm_x", y="utm_y"):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        if metric != "utm":
            xx, yy = "longitude", "latitude"
        else:
            xx, yy = x, y
        digits = DEG if metric == "euclidean" else M
        out = medoid(view(spark, sf), "ownership", "center_id", xx, yy, metric, ties=ties, tie_decimals=digits)
        return out.select("ownership", "center_id", "total_distance")
    return q


def q_distance_to_centroid(spark, sf):
    c = pts.customer_centers(spark, sf)
    out = distance_to_centroid(c, "ownership", "utm_x", "utm_y", "utm")
    return _round(out.select("ownership", "center_id", "centroid_x", "centroid_y", "distance"),
                  {"centroid_x": M, "centroid_y": M, "distance": M})


def q_most_central_medoid_first(spark, sf):
    c = pts.customer_centers(spark, sf)
    out = most_central(c, "ownership", "center_id", metric="haversine", method="medoid", ties="first")
    return _round(out.select("ownership", "center_id", "total_distance"), {"total_distance": M})


def q_cross_validate(spark, sf):
    r = reports.cross_validate_metrics(pts.customer_centers(spark, sf))
    return _round(r, {"utm_distance_m": M, "haversine_distance_m": M})


def q_naive_error(spark, sf):
    r = reports.naive_degree_error(pts.customer_centers(spark, sf))
    return _round(r, {"degree_distance": DEG, "naive_metres": M, "true_metres": M, "error_pct": RATIO})


def q_metric_agreement(spark, sf):
    return reports.metric_agreement(pts.customer_centers(spark, sf))


def q_centroid_vs_medoid(spark, sf):
    return _round(reports.centroid_vs_medoid(pts.customer_centers(spark, sf)), {"apart_m": M})


def q_method_metric_table(spark, sf):
    t = reports.method_metric_table(pts.customer_centers(spark, sf))
    return _round(t, {"longitude": DEG, "latitude": DEG})


def q_gap_invariance(spark, sf):
    t = reports.method_metric_table(pts.customer_centers(spark, sf))
    return _round(reports.gap_and_invariance(t), {"gap_km": RATIO})


def q_skew_diagnostics(spark, sf):
    r = reports.skew_diagnostics(pts.customer_centers(spark, sf))
    return _round(r, {"mean_to_median_m": M, "pct_far_from_median": RATIO,
                      "centroid_pick_to_median_m": M, "medoid_pick_to_median_m": M})


def q_drop_farthest(spark, sf):
    return _round(reports.drop_farthest_shift(pts.customer_centers(spark, sf)), {"centroid_shift_m": M})


def q_group_median(spark, sf):
    return group_median(pts.orders_centers(spark, sf), "ownership", ["utm_x", "utm_y"])


def q_group_sizes(spark, sf):
    c = pts.events_centers(spark, sf)
    return group_sizes(c, "ownership").join(distinct_groups(c, "ownership"), "ownership")


def q_clean_records(spark, sf):
    out = clean.clean_records(pts.customer_raw_records(spark, sf))
    return _round(out, {"longitude": DEG, "latitude": DEG})


def q_reject_counts(spark, sf):
    return clean.reject_counts(pts.customer_raw_records(spark, sf))


def q_map_layers(spark, sf):
    r = layers.map_layers(pts.customer_centers(spark, sf))
    return _round(r, {"longitude": DEG, "latitude": DEG})


def q_membership(spark, sf):
    c = pts.orders_centers(spark, sf)
    picks = nearest_to_centroid(c, "ownership", "longitude", "latitude", "haversine")
    return layers.membership_check(picks, c, ["ownership", "center_id"])


def q_replicated_centroid(spark, sf):
    c = io.replicate(pts.customer_centers(spark, sf), 3)
    out = nearest_to_centroid(c, "ownership", "utm_x", "utm_y", "utm")
    return _round(out.select("ownership", "center_id", "distance"), {"distance": M})


def _layout(c: DataFrame) -> DataFrame:
    """Centers with all columns of the point table; those the view lacks are null."""
    return c.select(*[(F.col(f.name) if f.name in c.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in io.CENTERS_SCHEMA])


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_clean_observed(spark, sf):
    """Rows kept and dropped as the cleaning pass itself counted them while its result was written."""
    out, counts = clean.clean_observed(pts.customer_raw_records(spark, sf))
    out.write.parquet(_scratch(spark, "clean-observed"))
    rows = [(k, n) for k, n in counts.get.items() if n]  # one for each outcome, five at most
    return spark.createDataFrame(rows, "outcome string, rows long")


def q_json_array_roundtrip(spark, sf):
    """Centers written as multi-line JSON arrays of up to 500 records, a file each, and read back."""
    path = _scratch(spark, "json-array")
    centers = _layout(pts.customer_centers(spark, sf))
    part = F.floor(F.col("center_id").cast("long") / 500).alias("part")
    arrays = centers.select(F.struct(*centers.columns).alias("r"), part).groupBy("part").agg(F.collect_list("r").alias("all"))
    text = F.to_json("all", {"pretty": "true"}).alias("value")
    arrays.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return _round(io.load_centers(spark, path, "json"), {"longitude": DEG, "latitude": DEG})


def _roundtrip(fmt: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        path = _scratch(spark, f"roundtrip-{fmt}")
        io.write_result(_layout(pts.customer_centers(spark, sf)), path, fmt)
        return _round(io.load_centers(spark, path, fmt), {"longitude": DEG, "latitude": DEG})
    return q


def q_raw_wrapper_clean(spark, sf):
    """Records in wrapper files of up to 500, read back and cleaned."""
    raw, path = pts.customer_raw_records(spark, sf), _scratch(spark, "wrapper")
    numbered = raw.select(F.struct(*io.RAW_FIELDS).alias("r"), F.floor(F.col("CODIGO").cast("long") / 500).alias("part"))
    numbered.groupBy("part").agg(F.collect_list("r").alias("data")).write.partitionBy("part").json(path)
    out = clean.clean_records(io.load_raw_records(spark, path + "/part=*"))
    return _round(out, {"longitude": DEG, "latitude": DEG})


def q_snapshot_sorted(spark, sf):
    """Rows of a snapshot, and how many come before one of a smaller id in their file or an earlier file."""
    path = _scratch(spark, "snapshot")
    io.write_snapshot(_layout(pts.orders_centers(spark, sf)), path, fmt="parquet")
    rows = spark.read.parquet(path).select(
        "center_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    w = Window.partitionBy("file").orderBy("at")
    inside = rows.withColumn("_before", F.lag("center_id").over(w)).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_before") > F.col("center_id"), 1)).alias("bad"),
        F.min("center_id").alias("low"), F.max("center_id").alias("high"))
    files = inside.withColumn("_before", F.max("high").over(  # one row for each file
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)))
    bad = F.sum("bad") + F.count(F.when(F.col("_before") > F.col("low"), 1))
    return files.agg(F.sum("n").alias("rows"), bad.cast("long").alias("out_of_order"))


def q_preview_picks(spark, sf):
    c = pts.customer_centers(spark, sf)
    out = nearest_to_centroid(c, "ownership", "utm_x", "utm_y", "utm")
    return _round(io.preview(out, "ownership", "center_name", "distance"), {"distance": M})


def q_prepared_sizes(spark, sf):
    kept = io.prepare_for_reuse(pts.events_centers(spark, sf))
    try:
        return Small(group_sizes(kept.where(F.col("ownership").isNotNull()), "ownership")).df
    finally:
        kept.unpersist()


def _custom_metric(implementation: str):
    """A distance that isn't built in, as columns or (for what exists in Python only) over arrays."""
    def q(spark: SparkSession, sf: str) -> DataFrame:
        size = F.abs if implementation == "native" else abs
        out = nearest_to_centroid(pts.customer_centers(spark, sf), "ownership", "utm_x", "utm_y",
                                  lambda a, b, c, d: size(a - c) + size(b - d), implementation)
        return _round(out.select("ownership", "center_id", "distance"), {"distance": M})
    return q


def _custom_medoid(implementation: str):
    """The medoid under a distance that isn't built in."""
    def q(spark: SparkSession, sf: str) -> DataFrame:
        size = F.abs if implementation == "native" else abs
        out = medoid(pts.customer_centers(spark, sf), "ownership", "center_id", "utm_x", "utm_y",
                     lambda a, b, c, d: size(a - c) + size(b - d), tie_decimals=M, implementation=implementation)
        return out.select("ownership", "center_id", "total_distance")
    return q


def q_argument_checks(spark, sf):
    """What calls with a wrong argument raise, and the rows that a right one returns."""
    c = pts.customer_centers(spark, sf)
    calls = {
        "right": {}, "method": {"method": "mode"}, "metric": {"metric": "manhattan"}, "implementation": {"implementation": "jit"},
        "ties": {"ties": "some"}, "column": {"x_col": "no_such", "y_col": "utm_y"},
        "medoid metric": {"method": "medoid", "metric": "manhattan"}, "medoid bound": {"method": "medoid", "bound": "guess"},
    }
    out = []
    for name, change in calls.items():
        try:
            outcome = str(most_central(c, "ownership", "center_id", **change).count())
        except ValueError:
            outcome = "ValueError"
        out.append((name, outcome))
    return spark.createDataFrame(out, "argument string, outcome string")


def q_map_aspect(spark, sf):
    mean = pts.customer_centers(spark, sf).groupBy("ownership").agg(F.avg("latitude").alias("lat"))
    return mean.select("ownership", F.round(longitude_scale("lat"), DEG).alias("aspect"))


def q_clean_bad_literals(spark, sf):
    """Why records with odd number literals are dropped, by literal."""
    raw = pts.customer_raw_records(spark, sf).withColumn(SITUATION, F.lit("ALTA")).withColumn("CENTRO", F.lit("x"))
    literals = F.array(*[F.lit(x) for x in BAD_LITERALS])
    odd = raw.withColumn("UTM_X", F.element_at(literals, (F.col("CODIGO").cast("int") % len(BAD_LITERALS) + 1)))
    rows = clean.classify(odd)
    return (rows.where(F.col("UTM_Y").isNotNull() & (F.col("UTM_Y") != ""))
            .groupBy(F.col("UTM_X").alias("literal"), F.coalesce("reject_reason", F.lit("kept")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("rows")))


SITUATION = "SITUACIÓN"
BAD_LITERALS = ("1.5", "1.5d", "1.5f", "0x1p3", "NaN", "Infinity", "-Infinity", "1e999", "+.5e2", "5.", "1_000", " 7 ")


def q_medoid_tied_first(spark, sf):
    out = medoid(pts.mirrored_parts(spark, sf), "ownership", "center_id", "utm_x", "utm_y", "utm", ties="first")
    return _round(out.select("ownership", "center_id", "total_distance"), {"total_distance": M})


def q_medoid_tied_rounding(spark, sf):
    out = medoid(pts.mirrored_parts(spark, sf), "ownership", "center_id", "utm_x", "utm_y", "utm", tie_decimals=0)
    return out.select("ownership", "center_id", "total_distance")


def entry(spark: SparkSession) -> DataFrame:
    return _centroid(pts.customer_centers, "haversine")(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "centroid_haversine": _centroid(pts.customer_centers, "haversine"),
        "centroid_utm": _centroid(pts.customer_centers, "utm"),
        "centroid_euclidean": _centroid(pts.customer_centers, "euclidean"),
        "centroid_haversine_udf": _centroid(pts.customer_centers, "haversine", "udf"),
        "centroid_haversine_pandas_udf": _centroid(pts.customer_centers, "haversine", "pandas_udf"),
        "centroid_orders_haversine_first": _centroid(pts.orders_centers, "haversine", ties="first"),
        "centroid_lineitem_planar": _centroid(pts.lineitem_points, "utm"),
        "distance_to_centroid": q_distance_to_centroid,
        "medoid_customer_haversine": _medoid(pts.customer_centers, "haversine"),
        "medoid_customer_utm": _medoid(pts.customer_centers, "utm"),
        "medoid_customer_euclidean": _medoid(pts.customer_centers, "euclidean"),
        "medoid_events_utm": _medoid(pts.events_centers, "utm"),
        "medoid_orders_haversine": _medoid(pts.orders_centers, "haversine"),
        "medoid_part_planar": _medoid(pts.part_points, "utm"),
        "medoid_embeddings_planar": _medoid(pts.embedding_points, "utm"),
        "most_central_medoid_first": q_most_central_medoid_first,
        "report_cross_validate": q_cross_validate,
        "report_naive_error": q_naive_error,
        "report_metric_agreement": q_metric_agreement,
        "report_centroid_vs_medoid": q_centroid_vs_medoid,
        "report_method_metric_table": q_method_metric_table,
        "report_gap_invariance": q_gap_invariance,
        "report_skew_diagnostics": q_skew_diagnostics,
        "report_drop_farthest": q_drop_farthest,
        "group_median": q_group_median,
        "group_sizes": q_group_sizes,
        "clean_records": q_clean_records,
        "reject_counts": q_reject_counts,
        "map_layers": q_map_layers,
        "membership_check": q_membership,
        "replicated_centroid": q_replicated_centroid,
        "clean_observed": q_clean_observed,
        "io_roundtrip_json_array": q_json_array_roundtrip,
        "io_roundtrip_jsonl": _roundtrip("jsonl"),
        "io_roundtrip_csv": _roundtrip("csv"),
        "io_roundtrip_parquet": _roundtrip("parquet"),
        "raw_wrapper_clean": q_raw_wrapper_clean,
        "snapshot_sorted": q_snapshot_sorted,
        "preview_picks": q_preview_picks,
        "prepared_group_sizes": q_prepared_sizes,
        "centroid_custom_metric": _custom_metric("native"),
        "centroid_custom_metric_pandas_udf": _custom_metric("pandas_udf"),
        "medoid_custom_metric": _custom_medoid("native"),
        "medoid_custom_metric_pandas_udf": _custom_medoid("pandas_udf"),
        "argument_checks": q_argument_checks,
        "map_aspect": q_map_aspect,
        "clean_bad_literals": q_clean_bad_literals,
        "medoid_tied_first": q_medoid_tied_first,
        "medoid_tied_rounding": q_medoid_tied_rounding,
    }
    if CORPUS:
        found |= CORPUS.QUERIES
    if CORPUS and PIPELINE:
        found["pipeline"] = PIPELINE.run
    return found


# ===================================================================== DuckDB

def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _lonlat_ctes(src: str, out: str) -> str:
    """CTEs adding longitude/latitude (inverse UTM series) to ``src`` as ``out``."""
    scale = proj.UTM_K0 * proj.GRS80_A * proj._RECT
    xi_p = " - ".join(["xi"] + [f"{_d(b)} * sin({_d(2 * j)} * xi) * cosh({_d(2 * j)} * eta)"
                                for j, b in enumerate(proj._BETA, 1)])
    eta_p = " - ".join(["eta"] + [f"{_d(b)} * cos({_d(2 * j)} * xi) * sinh({_d(2 * j)} * eta)"
                                  for j, b in enumerate(proj._BETA, 1)])
    lat = " + ".join(["chi"] + [f"{_d(d)} * sin({_d(2 * j)} * chi)" for j, d in enumerate(proj._DELTA, 1)])
    return f"""{out}_p1 AS (SELECT *, (utm_y - {_d(proj.UTM_FALSE_NORTHING_NORTH)}) / {_d(scale)} AS xi,
              (utm_x - {_d(proj.UTM_FALSE_EASTING)}) / {_d(scale)} AS eta FROM {src}),
{out}_p2 AS (SELECT *, {xi_p} AS xi_p, {eta_p} AS eta_p FROM {out}_p1),
{out}_p3 AS (SELECT *, asin(sin(xi_p) / cosh(eta_p)) AS chi, atan2(sinh(eta_p), cos(xi_p)) AS lam FROM {out}_p2),
{out} AS (SELECT * EXCLUDE (xi, eta, xi_p, eta_p, chi, lam),
              lam * {_d(180.0 / math.pi)} + {_d(proj.UTM30_CENTRAL_MERIDIAN_DEG)} AS longitude,
              ({lat}) * {_d(180.0 / math.pi)} AS latitude FROM {out}_p3)"""


def _spread(key: str) -> str:
    return (f"({_d(pts.EASTING0)} + CAST(({key} * {pts.SPREAD_MULT}) % {pts.SPREAD_MOD} - {pts.SPREAD_MID} AS DOUBLE)"
            f" * {_d(pts.SPREAD_STEP_M)})")


_VIEWS = {
    "customer": ("c_custkey", "c_name", "c_mktsegment", _spread("c_custkey"), f"{_d(pts.NORTHING0)} + c_acctbal",
                 "customer", True),
    "orders": ("o_orderkey", "o_orderstatus", "o_orderpriority", _spread("o_custkey"),
               f"{_d(pts.NORTHING0)} + o_totalprice / {_d(10)}", "orders", True),
    "events": ("event_id", "event_type", "event_type", _spread("user_id"),
               f"{_d(pts.NORTHING0)} + value * {_d(100)}", "events", True),
    "part": ("p_partkey", "p_name", "p_brand", "CAST(p_size AS DOUBLE)", "p_retailprice", "part", False),
    "lineitem": ("l_orderkey * 10 + l_linenumber", "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice",
                 "lineitem", False),
    "embeddings": ("vec_id", "CAST(vec_id AS VARCHAR)", "CAST(label AS VARCHAR)", "CAST(embedding[1] AS DOUBLE)",
                   "CAST(embedding[2] AS DOUBLE)", "embeddings", False),
}


def _centers(view: str = "customer") -> str:
    """CTE text ending in ``centers`` for a point view."""
    cid, name, grp, x, y, table, lonlat = _VIEWS[view]
    base = f"""base AS (SELECT {cid} AS center_id, {name} AS center_name, {grp} AS ownership,
  {x} AS utm_x, {y} AS utm_y FROM {table})"""
    if not lonlat:
        return base + ",\ncenters AS (SELECT * FROM base)"
    return base + ",\n" + _lonlat_ctes("base", "centers")


def _hav(x1: str, y1: str, x2: str, y2: str) -> str:
    a = (f"(pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) * cos(radians({y2}))"
         f" * pow(sin(radians({x2} - {x1}) / 2), 2))")
    a = f"least({a}, {_d(1.0)})"
    return f"(2 * {_d(6371000.0)} * atan2(sqrt({a}), sqrt(1 - {a})))"


def _planar(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"sqrt(pow({x2} - {x1}, 2) + pow({y2} - {y1}, 2))"


_DIST = {"haversine": _hav, "utm": _planar, "euclidean": _planar}


def _xy(metric: str) -> tuple[str, str]:
    return ("utm_x", "utm_y") if metric == "utm" else ("longitude", "latitude")


def _ok(x: str, y: str, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"({a}{x} IS NOT NULL AND {a}{y} IS NOT NULL AND NOT isnan({a}{x}) AND NOT isnan({a}{y}))"


def _centroid_sql(view: str, metric: str, ties: str = "all", replicate: int = 1) -> str:
    x, y = _xy(metric)
    digits = DEG if metric == "euclidean" else M
    order = "distance" if ties == "all" else "distance, center_id"
    fn = "rank" if ties == "all" else "row_number"
    src = "centers" if replicate == 1 else f"(SELECT c.* FROM centers c CROSS JOIN range({replicate}))"
    return f"""WITH {_centers(view)},
src AS (SELECT * FROM {src} WHERE ownership IS NOT NULL AND {_ok(x, y)}),
cen AS (SELECT ownership, avg({x}) AS cx, avg({y}) AS cy FROM src GROUP BY ownership),
dist AS (SELECT s.ownership, s.center_id, {_DIST[metric](x, y, 'cx', 'cy')} AS distance
         FROM src s JOIN cen USING (ownership)),
rk AS (SELECT *, {fn}() OVER (PARTITION BY ownership ORDER BY {order}) AS r FROM dist)
SELECT ownership, center_id, round(distance, {digits}) AS distance FROM rk WHERE r = 1"""


def _medoid_totals_sql(metric: str, src: str = "centers") -> str:
    x, y = _xy(metric)
    d = _DIST[metric](f"a.{x}", f"a.{y}", f"b.{x}", f"b.{y}")
    digits = DEG if metric == "euclidean" else M
    return f"""pts AS (SELECT * FROM {src} WHERE ownership IS NOT NULL AND {_ok(x, y)}),
tot AS (SELECT a.ownership, a.center_id, round(sum({d}), {digits}) AS total_distance
        FROM pts a JOIN pts b ON a.ownership = b.ownership GROUP BY a.ownership, a.center_id)"""


def _medoid_sql(view: str, metric: str, ties: str = "all") -> str:
    order = "total_distance" if ties == "all" else "total_distance, center_id"
    fn = "rank" if ties == "all" else "row_number"
    return f"""WITH {_centers(view)},
{_medoid_totals_sql(metric)},
rk AS (SELECT *, {fn}() OVER (PARTITION BY ownership ORDER BY {order}) AS r FROM tot)
SELECT ownership, center_id, total_distance FROM rk WHERE r = 1"""


def _picks_cte(prefix: str, metric: str, method: str, carry: str = "") -> str:
    """CTE ``{prefix}`` with one pick per group (lowest id on ties):
    ownership, center_id and carried columns of ``centers``."""
    x, y = _xy(metric)
    if method == "centroid":
        return f"""{prefix}_cen AS (SELECT ownership, avg({x}) AS cx, avg({y}) AS cy FROM centers GROUP BY ownership),
{prefix}_d AS (SELECT c.*, {_DIST[metric](f'c.{x}', f'c.{y}', 'cx', 'cy')} AS d
               FROM centers c JOIN {prefix}_cen USING (ownership)),
{prefix} AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY ownership ORDER BY d, center_id) AS r
             FROM {prefix}_d) WHERE r = 1)"""
    d = _DIST[metric](f"a.{x}", f"a.{y}", f"b.{x}", f"b.{y}")
    digits = DEG if metric == "euclidean" else M
    return f"""{prefix}_t AS (SELECT a.ownership, a.center_id, round(sum({d}), {digits}) AS d
                FROM centers a JOIN centers b ON a.ownership = b.ownership GROUP BY a.ownership, a.center_id),
{prefix} AS (SELECT c.*, t.d FROM (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER
             (PARTITION BY ownership ORDER BY d, center_id) AS r FROM {prefix}_t) WHERE r = 1) t
             JOIN centers c USING (ownership, center_id))"""


def _report_sql() -> dict[str, str]:
    cc = _centers("customer")
    out = {}
    out["report_cross_validate"] = f"""WITH {cc},
{_picks_cte('u', 'utm', 'centroid')},
{_picks_cte('h', 'haversine', 'centroid')}
SELECT u.ownership, u.center_id AS utm_pick, round(u.d, {M}) AS utm_distance_m,
       h.center_id AS haversine_pick, round(h.d, {M}) AS haversine_distance_m, u.center_id = h.center_id AS same_pick
FROM u JOIN h USING (ownership)"""
    out["report_naive_error"] = f"""WITH {cc},
{_picks_cte('e', 'euclidean', 'centroid')},
r AS (SELECT ownership, center_id AS euclidean_pick, d AS degree_distance, d * {_d(111320)} AS naive_metres,
             {_hav('longitude', 'latitude', 'cx', 'cy')} AS true_metres
      FROM e JOIN e_cen USING (ownership))
SELECT ownership, euclidean_pick, round(degree_distance, {DEG}) AS degree_distance,
       round(naive_metres, {M}) AS naive_metres, round(true_metres, {M}) AS true_metres,
       round((naive_metres - true_metres) / true_metres * 100, {RATIO}) AS error_pct FROM r"""
    out["report_metric_agreement"] = f"""WITH {cc},
{_picks_cte('u', 'utm', 'centroid')},
{_picks_cte('h', 'haversine', 'centroid')},
{_picks_cte('e', 'euclidean', 'centroid')}
SELECT u.ownership, u.center_id AS utm_pick, h.center_id AS haversine_pick, e.center_id AS euclidean_pick,
       (u.center_id = h.center_id AND h.center_id = e.center_id) AS all_agree
FROM u JOIN h USING (ownership) JOIN e USING (ownership)"""
    out["report_centroid_vs_medoid"] = f"""WITH {cc},
{_picks_cte('c', 'utm', 'centroid')},
{_picks_cte('m', 'utm', 'medoid')},
sz AS (SELECT ownership, count(*) AS group_size FROM centers GROUP BY ownership)
SELECT c.ownership, sz.group_size, c.center_id AS centroid_pick, m.center_id AS medoid_pick,
       c.center_id = m.center_id AS same_pick, round({_planar('c.utm_x', 'c.utm_y', 'm.utm_x', 'm.utm_y')}, {M}) AS apart_m
FROM c JOIN m USING (ownership) JOIN sz USING (ownership)"""
    table_parts = []
    ctes = []
    for metric in ("euclidean", "haversine", "utm"):
        for method in ("centroid", "medoid"):
            pre = f"{method[0]}{metric[0]}"
            ctes.append(_picks_cte(pre, metric, method))
            table_parts.append(f"SELECT '{method}' AS method, '{metric}' AS metric, ownership, center_id, center_name, "
                               f"longitude, latitude FROM {pre}")
    table = " UNION ALL ".join(table_parts)
    out["report_method_metric_table"] = f"""WITH {cc},
{','.join(ctes)}
SELECT method, metric, ownership, center_id, center_name, round(longitude, {DEG}) AS longitude,
       round(latitude, {DEG}) AS latitude FROM ({table})"""
    out["report_gap_invariance"] = f"""WITH {cc},
{','.join(ctes)},
t AS ({table}),
pm AS (SELECT ownership, metric,
              max(CASE WHEN method = 'centroid' THEN center_id END) AS cid,
              max(CASE WHEN method = 'medoid' THEN center_id END) AS mid FROM t GROUP BY ownership, metric),
inv AS (SELECT ownership, count(DISTINCT (cid, mid)) = 1 AS same_across_metrics FROM pm GROUP BY ownership),
cpk AS (SELECT * FROM t WHERE method = 'centroid' AND metric = 'utm'),
mpk AS (SELECT * FROM t WHERE method = 'medoid' AND metric = 'utm')
SELECT cpk.ownership, cpk.center_id AS centroid_pick, mpk.center_id AS medoid_pick,
       round({_hav('cpk.longitude', 'cpk.latitude', 'mpk.longitude', 'mpk.latitude')} / 1000, {RATIO}) AS gap_km,
       inv.same_across_metrics
FROM cpk JOIN mpk USING (ownership) JOIN inv USING (ownership)"""
    out["report_skew_diagnostics"] = f"""WITH {cc},
{_picks_cte('c', 'utm', 'centroid')},
{_picks_cte('m', 'utm', 'medoid')},
md AS (SELECT ownership, median(utm_x) AS mx, median(utm_y) AS my, avg(utm_x) AS ax, avg(utm_y) AS ay
       FROM centers GROUP BY ownership),
far AS (SELECT ownership, avg(CASE WHEN {_planar('utm_x', 'utm_y', 'mx', 'my')} > {_d(20000)} THEN 1.0 ELSE 0.0 END)
               * 100 AS pct FROM centers JOIN md USING (ownership) GROUP BY ownership)
SELECT md.ownership, round({_planar('ax', 'ay', 'mx', 'my')}, {M}) AS mean_to_median_m,
       round(far.pct, {RATIO}) AS pct_far_from_median,
       round({_planar('c.utm_x', 'c.utm_y', 'mx', 'my')}, {M}) AS centroid_pick_to_median_m,
       round({_planar('m.utm_x', 'm.utm_y', 'mx', 'my')}, {M}) AS medoid_pick_to_median_m
FROM md JOIN far USING (ownership) JOIN c USING (ownership) JOIN m USING (ownership)"""
    out["report_drop_farthest"] = f"""WITH {cc},
mean AS (SELECT ownership, avg(utm_x) AS ax, avg(utm_y) AS ay, count(*) AS n FROM centers GROUP BY ownership),
d AS (SELECT c.ownership, c.center_id, {_planar('c.utm_x', 'c.utm_y', 'ax', 'ay')} AS dist
      FROM centers c JOIN mean USING (ownership)),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ownership ORDER BY dist DESC, center_id) AS r FROM d)
      WHERE r = 1),
rest AS (SELECT c.ownership, avg(c.utm_x) AS nx, avg(c.utm_y) AS ny FROM centers c JOIN f USING (ownership)
         WHERE c.center_id <> f.center_id GROUP BY c.ownership)
SELECT mean.ownership, mean.n AS group_size, f.center_id AS farthest_id,
       round({_planar('ax', 'ay', 'nx', 'ny')}, {M}) AS centroid_shift_m
FROM mean JOIN f USING (ownership) LEFT JOIN rest USING (ownership)"""
    out["map_layers"] = f"""WITH {cc},
{_picks_cte('c', 'utm', 'centroid')},
{_picks_cte('m', 'utm', 'medoid')},
sz AS (SELECT ownership, count(*) AS group_size FROM centers GROUP BY ownership),
l AS (SELECT 'member' AS layer, ownership, center_id, longitude, latitude FROM centers
      UNION ALL SELECT 'centroid_pick', ownership, center_id, longitude, latitude FROM c
      UNION ALL SELECT 'medoid_pick', ownership, center_id, longitude, latitude FROM m)
SELECT layer, ownership, center_id, round(longitude, {DEG}) AS longitude, round(latitude, {DEG}) AS latitude,
       group_size FROM l JOIN sz USING (ownership)"""
    return out


_WS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"


def _strip_sql(c: str) -> str:
    return f"coalesce(regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g'), '')"


def _raw_sql() -> str:
    x = _spread("c_custkey")
    return f"""raw AS (SELECT CAST(c_custkey AS VARCHAR) AS codigo,
  CASE WHEN c_acctbal < 0 THEN 'BAJA' ELSE 'ALTA' END AS situacion,
  CASE WHEN c_nationkey = 3 THEN chr(9) || chr(160) || ' ' ELSE ' ' || chr(9) || c_name || chr(160) || chr(10) END AS centro,
  lower(c_mktsegment) || chr(8195) AS tipo_ext, ' ' || c_mktsegment AS titularidad,
  'N' || CAST(c_nationkey AS VARCHAR) || ' ' AS municipio, CAST(NULL AS VARCHAR) AS dat,
  CASE WHEN c_nationkey = 5 THEN '' WHEN c_nationkey = 7 THEN 'n/a' ELSE CAST({x} AS VARCHAR) END AS ux,
  CAST({_d(pts.NORTHING0)} + c_acctbal AS VARCHAR) AS uy FROM customer),
cls AS (SELECT *, CASE
   WHEN situacion IS NULL OR situacion <> 'ALTA' THEN 'inactive'
   WHEN ux IS NULL OR ux = '' OR uy IS NULL OR uy = '' THEN 'missing coordinate'
   WHEN {_strip_sql('centro')} = '' THEN 'blank name'
   WHEN TRY_CAST(ux AS DOUBLE) IS NULL OR TRY_CAST(uy AS DOUBLE) IS NULL THEN 'bad coordinate' END AS reason
  FROM raw)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "centroid_haversine": _centroid_sql("customer", "haversine"),
        "centroid_utm": _centroid_sql("customer", "utm"),
        "centroid_euclidean": _centroid_sql("customer", "euclidean"),
        "centroid_haversine_udf": _centroid_sql("customer", "haversine"),
        "centroid_haversine_pandas_udf": _centroid_sql("customer", "haversine"),
        "centroid_orders_haversine_first": _centroid_sql("orders", "haversine", ties="first"),
        "centroid_lineitem_planar": _centroid_sql("lineitem", "utm"),
        "distance_to_centroid": f"""WITH {_centers('customer')},
cen AS (SELECT ownership, avg(utm_x) AS cx, avg(utm_y) AS cy FROM centers GROUP BY ownership)
SELECT ownership, center_id, round(cx, {M}) AS centroid_x, round(cy, {M}) AS centroid_y,
       round({_planar('utm_x', 'utm_y', 'cx', 'cy')}, {M}) AS distance FROM centers JOIN cen USING (ownership)""",
        "medoid_customer_haversine": _medoid_sql("customer", "haversine"),
        "medoid_customer_utm": _medoid_sql("customer", "utm"),
        "medoid_customer_euclidean": _medoid_sql("customer", "euclidean"),
        "medoid_events_utm": _medoid_sql("events", "utm"),
        "medoid_orders_haversine": _medoid_sql("orders", "haversine"),
        "medoid_part_planar": _medoid_sql("part", "utm"),
        "medoid_embeddings_planar": _medoid_sql("embeddings", "utm"),
        "most_central_medoid_first": _medoid_sql("customer", "haversine", ties="first"),
        "group_median": f"""WITH {_centers('orders')}
SELECT ownership, median(utm_x) AS median_utm_x, median(utm_y) AS median_utm_y FROM centers GROUP BY ownership""",
        "group_sizes": f"""WITH {_centers('events')}
SELECT ownership, count(*) AS group_size FROM centers WHERE ownership IS NOT NULL GROUP BY ownership""",
        "clean_records": f"""WITH {_raw_sql()},
kept AS (SELECT coalesce(codigo, '') AS center_id, {_strip_sql('centro')} AS center_name,
                {_strip_sql('tipo_ext')} AS center_type, {_strip_sql('titularidad')} AS ownership,
                {_strip_sql('municipio')} AS municipality, {_strip_sql('dat')} AS education_area,
                TRY_CAST(ux AS DOUBLE) AS utm_x, TRY_CAST(uy AS DOUBLE) AS utm_y FROM cls WHERE reason IS NULL),
{_lonlat_ctes('kept', 'lonlat')}
SELECT * EXCLUDE (longitude, latitude), round(longitude, {DEG}) AS longitude, round(latitude, {DEG}) AS latitude
FROM lonlat""",
        "reject_counts": f"""WITH {_raw_sql()}
SELECT coalesce(reason, 'kept') AS outcome, count(*) AS rows FROM cls GROUP BY 1""",
        "membership_check": f"""WITH {_centers('orders')},
cen AS (SELECT ownership, avg(longitude) AS cx, avg(latitude) AS cy FROM centers GROUP BY ownership),
d AS (SELECT ownership, center_id, {_hav('longitude', 'latitude', 'cx', 'cy')} AS dist FROM centers JOIN cen USING (ownership)),
p AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ownership ORDER BY dist) AS r FROM d) WHERE r = 1)
SELECT count(*) AS picks,
       CAST(count(*) FILTER (WHERE EXISTS (SELECT 1 FROM centers c WHERE c.ownership = p.ownership
                                           AND c.center_id = p.center_id)) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM centers c WHERE c.ownership = p.ownership
                                               AND c.center_id = p.center_id)) AS BIGINT) AS missing FROM p""",
        "replicated_centroid": _centroid_sql("customer", "utm", replicate=3),
    }
    layout = f"""WITH {_centers('customer')}
SELECT CAST(center_id AS VARCHAR) AS center_id, center_name, CAST(NULL AS VARCHAR) AS center_type, ownership,
       CAST(NULL AS VARCHAR) AS municipality, CAST(NULL AS VARCHAR) AS education_area, utm_x, utm_y,
       round(longitude, {DEG}) AS longitude, round(latitude, {DEG}) AS latitude FROM centers"""
    manhattan_medoid = f"""WITH {_centers('customer')},
tot AS (SELECT a.ownership, a.center_id, round(sum(abs(a.utm_x - b.utm_x) + abs(a.utm_y - b.utm_y)), {M}) AS total_distance
        FROM centers a JOIN centers b ON a.ownership = b.ownership GROUP BY a.ownership, a.center_id)
SELECT ownership, center_id, total_distance FROM (SELECT *, rank() OVER (PARTITION BY ownership ORDER BY total_distance) AS r FROM tot) WHERE r = 1"""
    wrong = ", ".join(f"('{a}', 'ValueError')" for a in ("method", "metric", "implementation", "ties", "column", "medoid metric", "medoid bound"))
    checks = f"""SELECT * FROM (VALUES {wrong}) t(argument, outcome)
UNION ALL SELECT 'right', CAST(count(*) AS VARCHAR) FROM ({_centroid_sql("customer", "utm")})"""
    manhattan = f"""WITH {_centers('customer')},
cen AS (SELECT ownership, avg(utm_x) AS cx, avg(utm_y) AS cy FROM centers WHERE ownership IS NOT NULL GROUP BY ownership),
d AS (SELECT ownership, center_id, abs(utm_x - cx) + abs(utm_y - cy) AS distance FROM centers JOIN cen USING (ownership)),
rk AS (SELECT *, rank() OVER (PARTITION BY ownership ORDER BY distance) AS r FROM d)
SELECT ownership, center_id, round(distance, {M}) AS distance FROM rk WHERE r = 1"""
    literals = ", ".join(f"'{x}'" for x in BAD_LITERALS)
    mirrored = """mirrored AS (SELECT center_id * 4 + k AS center_id, ownership, utm_x * CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS utm_x,
  utm_y * CASE WHEN k < 2 THEN 1 ELSE -1 END AS utm_y FROM centers, range(4) AS t(k)),
tot AS (SELECT a.ownership, a.center_id, sum(sqrt((a.utm_x - b.utm_x) ** 2 + (a.utm_y - b.utm_y) ** 2)) AS t
        FROM mirrored a JOIN mirrored b ON a.ownership = b.ownership GROUP BY a.ownership, a.center_id)"""
    sql |= {
        "clean_observed": sql["reject_counts"],
        "io_roundtrip_json_array": layout,
        "io_roundtrip_jsonl": layout,
        "io_roundtrip_csv": layout,
        "io_roundtrip_parquet": layout,
        "raw_wrapper_clean": sql["clean_records"],
        "snapshot_sorted": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM orders",
        "preview_picks": f"""WITH {_centers('customer')},
cen AS (SELECT ownership, avg(utm_x) AS cx, avg(utm_y) AS cy FROM centers GROUP BY ownership),
d AS (SELECT ownership, center_name, {_planar('utm_x', 'utm_y', 'cx', 'cy')} AS distance FROM centers JOIN cen USING (ownership)),
rk AS (SELECT *, rank() OVER (PARTITION BY ownership ORDER BY distance) AS r FROM d)
SELECT ownership, center_name, round(distance, {M}) AS distance FROM rk WHERE r = 1""",
        "prepared_group_sizes": sql["group_sizes"],
        "centroid_custom_metric": manhattan,
        "centroid_custom_metric_pandas_udf": manhattan,
        "medoid_custom_metric": manhattan_medoid,
        "medoid_custom_metric_pandas_udf": manhattan_medoid,
        "argument_checks": checks,
        "map_aspect": f"""WITH {_centers('customer')}
SELECT ownership, round(cos(radians(avg(latitude))), {DEG}) AS aspect FROM centers GROUP BY ownership""",
        "clean_bad_literals": f"""WITH {_raw_sql()},
odd AS (SELECT list_extract([{literals}], CAST(codigo AS INT) % {len(BAD_LITERALS)} + 1) AS literal FROM raw WHERE uy IS NOT NULL AND uy <> '')
SELECT literal, CASE WHEN regexp_full_match(trim(literal), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                     AND literal <> '1e999' THEN 'kept' ELSE 'bad coordinate' END AS outcome, count(*) AS rows
FROM odd GROUP BY ALL""",
        "medoid_tied_first": f"""WITH {_centers('part')}, {mirrored},
rk AS (SELECT *, row_number() OVER (PARTITION BY ownership ORDER BY round(t, 3), center_id) AS r FROM tot)
SELECT ownership, center_id, round(t, {M}) AS total_distance FROM rk WHERE r = 1""",
        "medoid_tied_rounding": f"""WITH {_centers('part')}, {mirrored},
rk AS (SELECT *, rank() OVER (PARTITION BY ownership ORDER BY round(t, 0)) AS r FROM tot)
SELECT ownership, center_id, round(t, 0) AS total_distance FROM rk WHERE r = 1""",
    }
    sql.update(_report_sql())
    if CORPUS:
        sql |= CORPUS.ORACLE_SQL
    if CORPUS and PIPELINE and PIPELINE.ORACLE_SQL:
        sql["pipeline"] = PIPELINE.ORACLE_SQL
    return sql
