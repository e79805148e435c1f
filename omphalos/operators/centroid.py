"""Nearest-to-centroid: the real member closest to its group's mean position.

Two scans of the rows. The first sums coordinates by group and by buckets of a hash
of the coordinates, each of which also keeps one member: that gives the means, and
the members kept give a bound on the least distance of each group. Both come in
one small table. The second scan, with that table broadcast, computes each row's
distance and writes the few rows within the bound, all ties among them; the least
distance and the picks are taken from these.

No exchange, sort or Python worker sees the rows, so no task holds a group. With
more groups than can be broadcast the join is dealt by (group, salt). The calls run
these jobs when they are made (they are eager).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import Metric
from ..functions.udfs import distance_column
from ..session import materialize
from .attach import Small, keep_first, keep_least
from .guards import IMPLEMENTATIONS, TIES, check_choice, reject_clashes, require_columns, usable_point

CENTROID_COLS = ("centroid_x", "centroid_y")
#: Members of a group that bound its least distance, for each doubling of its size.
SAMPLES = 6
#: Room for the last bits of distances that are computed twice.
SLACK_REL, SLACK_ABS = 1e-9, 1e-9


def group_centroids(df: DataFrame, group_col: str, x_col: str, y_col: str) -> DataFrame:
    """One row per group: arithmetic mean of x and y over usable points (A1)."""
    ok = usable_point(x_col, y_col)
    return df.groupBy(group_col).agg(
        F.avg(F.when(ok, F.col(x_col))).alias("centroid_x"), F.avg(F.when(ok, F.col(y_col))).alias("centroid_y")
    )


def distance_to_centroid(
    df: DataFrame,
    group_col: str,
    x_col: str,
    y_col: str,
    metric: str | Metric = "utm",
    implementation: str = "native",
) -> DataFrame:
    """Every usable row with its group's centroid and its distance to it.

    Output: group column first, the other input columns, ``centroid_x``,
    ``centroid_y``, ``distance``. Rows with a null group are dropped (inner
    join); a row with a null or NaN coordinate is kept with a null distance
    and does not count towards the mean.
    """
    check_choice("implementation", implementation, IMPLEMENTATIONS)
    require_columns(df, group_col, x_col, y_col)
    reject_clashes(df, CENTROID_COLS + ("distance",))
    joined = Small(group_centroids(df, group_col, x_col, y_col)).join(df, group_col)
    dist = distance_column(metric, implementation, x_col, y_col, "centroid_x", "centroid_y")
    return joined.withColumn("distance", F.when(usable_point(x_col, y_col), dist))


def top_by(df: DataFrame, group_col: str, order_col: str, id_col: str | None, ties: str) -> DataFrame:
    """Rows with the least non-null ``order_col`` per group.

    ``ties="all"`` keeps every row sharing the minimum (rank); ``"first"``
    keeps one, the lowest ``id_col``. The null check sits in the same filter
    as the rank, above the window, so it is never pushed below the shuffle.
    """
    check_choice("ties", ties, TIES)
    order = [F.col(order_col).asc_nulls_last()]
    if ties == "first":
        if id_col is None:
            raise ValueError('ties="first" needs id_col')
        w = Window.partitionBy(group_col).orderBy(*order, F.col(id_col).asc_nulls_last())
        ranked = df.withColumn("_pick", F.row_number().over(w))
    else:
        w = Window.partitionBy(group_col).orderBy(*order)
        ranked = df.withColumn("_pick", F.rank().over(w))
    return ranked.filter((F.col("_pick") == 1) & F.col(order_col).isNotNull()).drop("_pick")


def centre_bounds(df: DataFrame, group_col: str, pairs: dict[str, tuple[str, str]],
                  bounds: dict[str, tuple[str, str | Metric, str]]) -> Small:
    """Per group: ``_rows``, for each pair of columns the means ``_x_<pair>`` and ``_y_<pair>`` over its usable
    points, and for each of ``bounds`` (pair, metric, implementation) a ``_limit_<name>`` that the distance
    from the mean to the member nearest to it doesn't exceed.

    One scan. A row falls into bucket b with a probability that halves every ``SAMPLES``
    buckets, so a group of n rows has about SAMPLES * log2(n) of them, however many
    groups there are; the first member of each is as good as picked at random, and about
    one in SAMPLES * log2(n) rows is nearer to the mean than all of them.
    """
    cols = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    u = (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(1)) / F.lit(float(1 << 52))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for k, (x, y) in pairs.items():
        ok = usable_point(x, y)
        vx, vy = F.when(ok, F.col(x)), F.when(ok, F.col(y))
        aggs += [F.count(vx).alias(f"_n_{k}"), F.sum(vx).alias(f"_sx_{k}"), F.sum(vy).alias(f"_sy_{k}"),
                 F.first(vx, ignorenulls=True).alias(f"_fx_{k}"), F.first(vy, ignorenulls=True).alias(f"_fy_{k}")]
    bucket = F.floor(F.lit(-float(SAMPLES)) * F.log2(u)).cast("int").alias("_bucket")
    parts = df.where(F.col(group_col).isNotNull()).groupBy(group_col, bucket).agg(*aggs)
    whole = Window.partitionBy(group_col)
    means = parts.withColumns({f"_{c}_{k}": F.try_divide(F.sum(f"_s{c}_{k}").over(whole), F.sum(f"_n_{k}").over(whole)) for k in pairs for c in "xy"})
    for name, (k, metric, implementation) in bounds.items():
        dist = distance_column(metric, implementation, f"_fx_{k}", f"_fy_{k}", f"_x_{k}", f"_y_{k}")
        means = means.withColumn(f"_d_{name}", F.when(F.col(f"_fx_{k}").isNotNull(), dist))
    limits = [(F.min(f"_d_{n}") * (1.0 + SLACK_REL) + SLACK_ABS).alias(f"_limit_{n}") for n in bounds]
    return Small(means.groupBy(group_col).agg(
        F.sum("_rows").alias("_rows"), *[F.first(f"_{c}_{k}").alias(f"_{c}_{k}") for k in pairs for c in "xy"], *limits))


def within(rows: DataFrame, distances: dict[str, Column], limits: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` and the distances of the rows where one is at most its limit column, written once.

    The row number keeps the filter above the projection: in the join condition, where
    Catalyst would put it, no subexpression is shared and each distance is evaluated again.
    """
    rows = rows.withColumns({**distances, "_at": F.monotonically_increasing_id()})
    close = reduce(Column.__or__, [F.coalesce(F.col(d) <= F.col(limit), F.lit(False)) for d, limit in limits.items()])
    return materialize(rows.where(close & (F.col("_at") >= 0)).select(*keep, *distances), "near-centre")


def nearest_to_centroid(
    df: DataFrame,
    group_col: str,
    x_col: str,
    y_col: str,
    metric: str | Metric = "utm",
    implementation: str = "native",
    ties: str = "all",
    id_col: str | None = None,
) -> DataFrame:
    """Per group, the real row(s) nearest the group's mean position.

    Output: group column first, the other input columns, ``distance``. Rows with
    a null group or an unusable coordinate take no part.
    """
    check_choice("ties", ties, TIES)
    check_choice("implementation", implementation, IMPLEMENTATIONS)
    if ties == "first" and id_col is None:
        raise ValueError('ties="first" needs id_col')
    require_columns(df, group_col, x_col, y_col)
    added = ["_rows", "_x_c", "_y_c", "_limit_c"]
    reject_clashes(df, (*CENTROID_COLS, "distance", "rank", "_bucket", "_salt", "_salts", "_least", "_first", "_at", *added))
    bounds = centre_bounds(df, group_col, {"c": (x_col, y_col)}, {"c": ("c", metric, implementation)})
    dist = distance_column(metric, implementation, x_col, y_col, "_x_c", "_y_c")
    keep = [group_col, *[c for c in df.columns if c != group_col]]
    near = within(bounds.join(df, group_col), {"distance": F.when(usable_point(x_col, y_col), dist)}, {"distance": "_limit_c"}, keep)
    nearest = keep_least(near, group_col, "distance", bounds.local)
    return nearest if ties == "all" else keep_first(nearest, group_col, id_col)
