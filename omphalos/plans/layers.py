"""Map layer table (C14) and the membership check of picks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attach import Small
from ..operators.centroid import nearest_to_centroid
from ..operators.medoid import medoid
from ..operators.stats import group_sizes
from .reports import DEFAULT, Layout


def map_layers(df: DataFrame, L: Layout = DEFAULT, metric: str = "utm", **tuning) -> DataFrame:
    """Every member (layer ``member``) with its group size, plus the
    nearest-to-centroid and medoid picks (layers ``centroid_pick`` and
    ``medoid_pick``): the table a map is drawn from. No plotting here."""
    x, y = L.coords(metric)
    base = df.select(L.group, L.id, L.lon, L.lat, x, y) if metric == "utm" else df.select(L.group, L.id, L.lon, L.lat)
    sizes = Small(group_sizes(df, L.group))
    members = sizes.join(base, L.group).select(F.lit("member").alias("layer"), L.group, L.id, L.lon, L.lat,
                                               "group_size")
    c = nearest_to_centroid(base, L.group, x, y, metric, ties="first", id_col=L.id)
    m = medoid(base, L.group, L.id, x, y, metric, ties="first", **tuning)
    picks = sizes.join(c.select(F.lit("centroid_pick").alias("layer"), L.group, L.id, L.lon, L.lat)
                       .unionByName(m.select(F.lit("medoid_pick").alias("layer"), L.group, L.id, L.lon, L.lat)), L.group)
    return members.unionByName(picks.select(*members.columns))


def membership_check(picks: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many picks there are, how many match a source row on
    ``keys`` and how many do not (must be 0). The picks go to the source rows,
    which are scanned once and not shuffled; a null key matches nothing."""
    wanted = Small(picks.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    there = wanted.join(source.select(*keys), keys).select(*keys).distinct().withColumn("_there", F.lit(True))
    hit = F.when(F.col("_there"), F.col("_n")).otherwise(F.lit(0))
    return wanted.df.join(there, keys, "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("picks"),
        F.coalesce(F.sum(hit), F.lit(0)).cast("long").alias("matched"),
        F.coalesce(F.sum(F.col("_n") - hit), F.lit(0)).cast("long").alias("missing"),
    )
