"""Joins of many rows with one row per group, without a shuffle of the many.

A table of up to ``SMALL_ROWS`` rows (counted, never assumed) is fetched once
and broadcast; a larger one is joined by (group, salt), where a group has a
salt for each ``SHARE`` of its rows, which are counted first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SMALL_ROWS = 100_000
SHARE = 1_000_000  # rows of one group that a task takes
MOST_HOT = 10_000  # groups that can be dealt to several tasks: with more rows, a share is larger


class Small:
    """A per-group table that was computed once, local where it is small.

    Its values are fixed from then on: two joins see the same bits, which
    equality of recomputed floats relies on.
    """

    def __init__(self, df: DataFrame, limit: int = SMALL_ROWS):
        rows = df.limit(limit + 1).collect()
        self.local = len(rows) <= limit
        self.df = df.sparkSession.createDataFrame(rows, df.schema) if self.local else materialize(df, "per-group")

    def join(self, rows: DataFrame, keys: list[str] | str, how: str = "inner") -> DataFrame:
        """``rows`` joined (inner, left or left_semi) with the table on ``keys``."""
        if self.local:
            return rows.join(F.broadcast(self.df), keys, how)
        keys = [keys] if isinstance(keys, str) else keys
        hot = hot_groups(rows, keys)
        salts = F.coalesce("_salts", F.lit(1))
        salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("_salts")
        dealt = self.df.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts.cast("int") - 1))).drop("_salts")
        return salted.join(dealt, [*keys, "_salt"], how).drop("_salt")


def hot_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the number of ``_salts`` (2 or more) of each group with more rows than a share.

    One aggregate over the keys. A share is ``SHARE`` rows, or all rows / ``MOST_HOT``
    if that is more, so there are at most ``MOST_HOT`` such groups.
    """
    counts = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "group-counts")
    share = max(SHARE, (counts.agg(F.sum("_n")).first()[0] or 0) // MOST_HOT)
    return counts.where(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))


def keep_least(rows: DataFrame, group_col: str, value: str, few_groups: bool) -> DataFrame:
    """Rows whose ``value`` is the least non-null one of their (non-null) group.

    ``rows`` is read twice and must not change between (a written table). The
    least values come from a hash aggregate; with ``few_groups`` (at most
    ``SMALL_ROWS``, as counted by the caller) they are broadcast to the rows.
    """
    least = rows.groupBy(group_col).agg(F.min(value).alias("_least")).where(F.col("_least").isNotNull())
    joined = rows.join(F.broadcast(least), group_col) if few_groups else Small(least).join(rows, group_col)
    return joined.where(F.col(value) == F.col("_least")).drop("_least")


def keep_first(rows: DataFrame, group_col: str, id_col: str) -> DataFrame:
    """One row of each group: the lowest id, nulls last. For what ``keep_least`` leaves."""
    with_id = rows.groupBy(group_col).agg(F.min(id_col).alias("_first"))
    mine = Small(with_id).join(rows, group_col).where(F.col(id_col).eqNullSafe(F.col("_first"))).drop("_first")
    return mine.dropDuplicates([group_col])
