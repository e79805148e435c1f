"""Comparison reports over a centers table (C5-C12), each one DataFrame.

The reference prints these tables from single-machine pandas loops; here
each is a Spark plan over all groups at once. Picks inside reports keep one
member per group (lowest id on ties). Column defaults follow the centers
layout: group ``ownership``, id ``center_id``, ``utm_x/utm_y`` metres and
``longitude/latitude`` degrees.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import (
    FAR_FROM_MEDIAN_M, METRICS, metres_to_km, naive_degrees_to_metres, percent_error,
)
from ..operators.attach import Small
from ..operators.centroid import centre_bounds, within
from ..operators.guards import usable_point
from ..operators.medoid import medoid
from ..operators.stats import agreement, group_median, share_beyond

UTM, HAV, EUC = METRICS["utm"], METRICS["haversine"], METRICS["euclidean"]


@dataclass(frozen=True)
class Layout:
    group: str = "ownership"
    id: str = "center_id"
    name: str = "center_name"
    utm_x: str = "utm_x"
    utm_y: str = "utm_y"
    lon: str = "longitude"
    lat: str = "latitude"

    def coords(self, metric: str) -> tuple[str, str]:
        return (self.utm_x, self.utm_y) if metric == "utm" else (self.lon, self.lat)


DEFAULT = Layout()


def _centroid_picks(df: DataFrame, L: Layout, metrics: list[str], carry: list[str]) -> DataFrame:
    """One row per group: for each metric the member nearest the mean as a struct
    ``pick_<metric>`` = (d, id, *carry), plus the means and the group size.

    Two scans for any number of metrics: the means with bounds on the least
    distances, then the rows within one of the bounds (see ``centre_bounds``)."""
    pair = {n: "u" if n == "utm" else "g" for n in metrics}
    both = {"u": (L.utm_x, L.utm_y), "g": (L.lon, L.lat)}
    bounds = centre_bounds(df, L.group, both, {n: (pair[n], n, "native") for n in metrics})
    j = bounds.join(df.select(*dict.fromkeys([L.group, L.id, *carry, *both["u"], *both["g"]])), L.group)
    dist = {f"_d_{n}": F.when(usable_point(*both[pair[n]]), METRICS[n].column(*both[pair[n]], f"_x_{pair[n]}", f"_y_{pair[n]}")) for n in metrics}
    near = within(j, dist, {f"_d_{n}": f"_limit_{n}" for n in metrics}, list(dict.fromkeys([L.group, L.id, *carry])))
    picks = near.groupBy(L.group).agg(*[
        F.min(F.when(F.col(f"_d_{n}").isNotNull(), F.struct(F.col(f"_d_{n}").alias("d"), F.col(L.id).alias("id"), *[F.col(c) for c in carry])))
        .alias(f"pick_{n}") for n in metrics])
    return bounds.join(picks, L.group).select(
        L.group, F.col("_rows").alias("group_size"), F.col("_x_u").alias("_mux"), F.col("_y_u").alias("_muy"),
        F.col("_x_g").alias("_mlon"), F.col("_y_g").alias("_mlat"), *[f"pick_{n}" for n in metrics])


def _medoid_pick(df: DataFrame, L: Layout, metric: str, **tuning) -> DataFrame:
    x, y = L.coords(metric)
    cols = list(dict.fromkeys([L.group, L.id, L.name, L.utm_x, L.utm_y, L.lon, L.lat]))
    return medoid(df.select(*cols), L.group, L.id, x, y, metric, ties="first", **tuning)


def cross_validate_metrics(df: DataFrame, L: Layout = DEFAULT) -> DataFrame:
    """Per group the utm and haversine nearest-to-centroid picks, their
    distances to the mean (metres) and whether they are the same member."""
    p = _centroid_picks(df, L, ["utm", "haversine"], [])
    return p.select(
        L.group,
        F.col("pick_utm.id").alias("utm_pick"), F.col("pick_utm.d").alias("utm_distance_m"),
        F.col("pick_haversine.id").alias("haversine_pick"), F.col("pick_haversine.d").alias("haversine_distance_m"),
        (F.col("pick_utm.id") == F.col("pick_haversine.id")).alias("same_pick"),
    )


def naive_degree_error(df: DataFrame, L: Layout = DEFAULT) -> DataFrame:
    """The euclidean-on-degrees pick, its degree distance, that distance
    misread as metres (x 111,320), the true haversine metres and the error %."""
    p = _centroid_picks(df, L, ["euclidean"], [L.lon, L.lat])
    deg = F.col("pick_euclidean.d")
    true_m = HAV.column(F.col(f"pick_euclidean.{L.lon}"), F.col(f"pick_euclidean.{L.lat}"),
                        F.col("_mlon"), F.col("_mlat"))
    return p.select(
        L.group, F.col("pick_euclidean.id").alias("euclidean_pick"), deg.alias("degree_distance"),
        naive_degrees_to_metres(deg).alias("naive_metres"), true_m.alias("true_metres"),
    ).withColumn("error_pct", percent_error("naive_metres", "true_metres"))


def metric_agreement(df: DataFrame, L: Layout = DEFAULT) -> DataFrame:
    """The nearest-to-centroid pick under each metric and whether all agree."""
    p = _centroid_picks(df, L, ["utm", "haversine", "euclidean"], [])
    u, h, e = (F.col(f"pick_{m}.id") for m in ("utm", "haversine", "euclidean"))
    return p.select(L.group, u.alias("utm_pick"), h.alias("haversine_pick"), e.alias("euclidean_pick"),
                    ((u == h) & (h == e)).alias("all_agree"))


def centroid_vs_medoid(df: DataFrame, L: Layout = DEFAULT, **tuning) -> DataFrame:
    """Group size, the utm centroid and medoid picks, whether they are the
    same member and how far apart they are (planar metres)."""
    c = _centroid_picks(df, L, ["utm"], [L.utm_x, L.utm_y])
    m = _medoid_pick(df, L, "utm", **tuning)
    j = c.join(m.select(L.group, F.col(L.id).alias("_mid"), F.col(L.utm_x).alias("_mx"), F.col(L.utm_y).alias("_my")),
               L.group)
    cx, cy = F.col(f"pick_utm.{L.utm_x}"), F.col(f"pick_utm.{L.utm_y}")
    return j.select(
        L.group, "group_size", F.col("pick_utm.id").alias("centroid_pick"), F.col("_mid").alias("medoid_pick"),
        (F.col("pick_utm.id") == F.col("_mid")).alias("same_pick"),
        UTM.column(cx, cy, F.col("_mx"), F.col("_my")).alias("apart_m"),
    )


def method_metric_table(df: DataFrame, L: Layout = DEFAULT, **tuning) -> DataFrame:
    """(method, metric, group) -> picked member with name, longitude, latitude."""
    names = ["euclidean", "haversine", "utm"]
    c = _centroid_picks(df, L, names, [L.name, L.lon, L.lat])
    parts = [
        c.select(F.lit("centroid").alias("method"), F.lit(n).alias("metric"), L.group,
                 F.col(f"pick_{n}.id").alias(L.id), F.col(f"pick_{n}.{L.name}").alias(L.name),
                 F.col(f"pick_{n}.{L.lon}").alias(L.lon), F.col(f"pick_{n}.{L.lat}").alias(L.lat))
        for n in names
    ]
    for n in names:
        m = _medoid_pick(df, L, n, **tuning)
        parts.append(m.select(F.lit("medoid").alias("method"), F.lit(n).alias("metric"), L.group, L.id, L.name,
                              L.lon, L.lat))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gap_and_invariance(table: DataFrame, L: Layout = DEFAULT) -> DataFrame:
    """C10 from a C9 table: km between the utm centroid and medoid picks, and
    whether the (centroid, medoid) pair is the same under every metric."""
    per_metric = table.groupBy(L.group, "metric").agg(
        F.max(F.when(F.col("method") == "centroid", F.struct(L.id, L.lon, L.lat))).alias("c"),
        F.max(F.when(F.col("method") == "medoid", F.struct(L.id, L.lon, L.lat))).alias("m"),
    )
    utm_row = F.col("metric") == "utm"
    g = per_metric.withColumn("_pair", F.struct(F.col(f"c.{L.id}"), F.col(f"m.{L.id}"))).groupBy(L.group).agg(
        F.max(F.when(utm_row, F.col("c"))).alias("c"), F.max(F.when(utm_row, F.col("m"))).alias("m"),
        agreement("_pair").alias("same_across_metrics"),
    )
    gap = HAV.column(F.col(f"c.{L.lon}"), F.col(f"c.{L.lat}"), F.col(f"m.{L.lon}"), F.col(f"m.{L.lat}"))
    return g.select(L.group, F.col(f"c.{L.id}").alias("centroid_pick"), F.col(f"m.{L.id}").alias("medoid_pick"),
                    metres_to_km(gap).alias("gap_km"), "same_across_metrics")


def skew_diagnostics(df: DataFrame, L: Layout = DEFAULT, **tuning) -> DataFrame:
    """C11 (planar metres): mean-to-median offset, % of members farther than
    20 km from the median, and the utm centroid / medoid picks' distance to it."""
    med = Small(group_median(df, L.group, [L.utm_x, L.utm_y]))
    mx, my = F.col(f"median_{L.utm_x}"), F.col(f"median_{L.utm_y}")
    c = _centroid_picks(df, L, ["utm"], [L.utm_x, L.utm_y])
    m = _medoid_pick(df, L, "utm", **tuning).select(L.group, F.col(L.utm_x).alias("_mx"), F.col(L.utm_y).alias("_my"))
    far = (med.join(df, L.group)
           .groupBy(L.group)
           .agg(share_beyond(F.when(usable_point(L.utm_x, L.utm_y), UTM.column(L.utm_x, L.utm_y, mx, my)),
                             FAR_FROM_MEDIAN_M).alias("pct_far_from_median")))
    j = med.join(c, L.group).join(m, L.group).join(far, L.group)
    return j.select(
        L.group,
        UTM.column(F.col("_mux"), F.col("_muy"), mx, my).alias("mean_to_median_m"),
        "pct_far_from_median",
        UTM.column(F.col(f"pick_utm.{L.utm_x}"), F.col(f"pick_utm.{L.utm_y}"), mx, my).alias("centroid_pick_to_median_m"),
        UTM.column(F.col("_mx"), F.col("_my"), mx, my).alias("medoid_pick_to_median_m"),
    )


def drop_farthest_shift(df: DataFrame, L: Layout = DEFAULT) -> DataFrame:
    """How far the utm mean moves when the member farthest from it (all rows
    with that id; lowest id on ties) is left out. Null for a one-member group.

    The least farthest id comes from a hash aggregate; the mean moves by the sum
    of that id's offsets from it, over the members that stay. Rows are scanned,
    never shuffled."""
    ok = usable_point(L.utm_x, L.utm_y)
    means = Small(df.groupBy(L.group).agg(
        F.avg(F.when(ok, F.col(L.utm_x))).alias("_mx"), F.avg(F.when(ok, F.col(L.utm_y))).alias("_my"),
        F.count(F.when(ok, F.lit(1))).alias("_n")))
    j = means.join(df, L.group).withColumn("_d", F.when(ok, UTM.column(L.utm_x, L.utm_y, "_mx", "_my")))
    most = Small(j.groupBy(L.group).agg(F.max("_d").alias("_dmax")))
    far = Small(most.join(j, L.group).where(F.col("_d") == F.col("_dmax")).groupBy(L.group).agg(F.min(L.id).alias("_far")))
    gone = far.join(j, L.group).where(ok & F.col(L.id).eqNullSafe(F.col("_far"))).groupBy(L.group).agg(
        F.sum(F.col(L.utm_x) - F.col("_mx")).alias("_ox"), F.sum(F.col(L.utm_y) - F.col("_my")).alias("_oy"),
        F.count(F.lit(1)).alias("_gone"), F.first("_far").alias("farthest_id"))
    out = means.join(gone, L.group)
    rest = F.col("_n") - F.col("_gone")
    nx = F.col("_mx") - F.try_divide(F.col("_ox"), rest)
    ny = F.col("_my") - F.try_divide(F.col("_oy"), rest)
    return out.select(L.group, F.col("_n").alias("group_size"), "farthest_id",
                      UTM.column(F.col("_mx"), F.col("_my"), nx, ny).alias("centroid_shift_m"))
