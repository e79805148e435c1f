"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omphalos.llm.common import Scratch, hot_lookup


def _star(scratch: Scratch, links: DataFrame, large: bool) -> DataFrame:
    """One star round over ``links(a, b)`` with a > b.

    Large star: each node hangs its larger neighbours below the least node it
    knows. Small star: each node hangs itself and its smaller neighbours below
    the least of them. The least neighbour is a map-side combined minimum that
    is joined back; no neighbour list is ever gathered.
    """
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = scratch.save(near, "near")
    least = scratch.save(near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
    least_or_self = least.withColumn("m", F.least("m", "u"))
    if large:
        out = hot_lookup(near.where("v > u"), least_or_self, "u", "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = hot_lookup(near, least_or_self, "u", "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    done = scratch.save(out.where("a <> b").distinct(), "large" if large else "small")
    scratch.drop(near, least)
    return done


def connected_components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component is its least node.

    Null ends and self-links are ignored, the direction and repetition of a
    link don't matter, and no links give no rows. Rounds alternate until the
    set of links is the same twice (compared by count and sum of hashes);
    then every link points from a node to its component.
    """
    a, b = F.col("a"), F.col("b")
    state = scratch.save(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    mark = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == mark:
            break
        mark = now
        wide = _star(scratch, state, large=True)
        scratch.drop(state)
        state = _star(scratch, wide, large=False)
        scratch.drop(wide)
    return scratch.save(state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
