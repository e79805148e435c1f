"""Group statistics used by the reports.

All of them are aggregates with partial (map-side) combination. The exact
median avoids holding a whole group in one task: an approximate quantile
sketch brackets the median's rank, only the values inside that bracket
(about 8/accuracy of the group, as distinct values with counts) are
ranked exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .attach import Small

MEDIAN_ACCURACY = 100_000
#: Parts that a round of ``kth_least`` cuts a range into.
CUTS = 32


def group_sizes(df: DataFrame, group_col: str, name: str = "group_size") -> DataFrame:
    """Rows per group (A3)."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias(name))


def distinct_groups(df: DataFrame, group_col: str) -> DataFrame:
    """Distinct non-null groups, sorted."""
    return df.select(group_col).filter(F.col(group_col).isNotNull()).distinct().orderBy(group_col)


def group_median(df: DataFrame, group_col: str, cols: list[str], accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Exact, interpolated median of each column per group (A4).

    Equals ``percentile(col, 0.5)`` / pandas ``median``: for an even count
    the mean of the two middle values. Nulls and NaNs are ignored.

    1. one aggregate: count n and approximate quantiles at 0.5 -+ 4/accuracy
       (rank error of the sketch is at most n/accuracy), bracketing both
       middle ranks;
    2. one aggregate: rows below the bracket, and (value, count) pairs inside
       it; only those few values are ranked with a window.
    A group whose bracket misses the middle ranks (not expected) has its
    values selected by ``kth_least``, so the result stays exact.
    """
    eps = 4.0 / accuracy
    long = df.select(group_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols
    ])).alias("_kv")).select(group_col, "_kv._col", "_kv._v")
    long = long.filter(F.col(group_col).isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    keys = [group_col, "_col"]

    sketch = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias("_q"),
    )
    # middle ranks, 1-based
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.ceil((F.col("_n") + 1) / 2)
    sketch = sketch.select(*keys, "_n", k1.alias("_k1"), k2.alias("_k2"),
                           F.element_at("_q", 1).alias("_lo"), F.element_at("_q", 2).alias("_hi"))

    sketch = Small(sketch)

    def ranked(lo: Column, hi: Column, rows: DataFrame) -> Small:
        """Per key the median if the bracket holds the middle ranks, else null.

        One pass counts each value inside the bracket and, under a null, all
        values below it."""
        j = sketch.join(rows, keys).where(F.col("_v") <= hi).withColumn("_v", F.when(F.col("_v") >= lo, F.col("_v")))
        counts = j.groupBy(*keys, "_k1", "_k2", "_v").agg(F.count(F.lit(1)).alias("_c"))
        w = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = counts.withColumn("_cum", F.sum("_c").over(w))
        # the k-th value is the first whose cumulative count reaches k; null where that is below the bracket
        at = lambda k: F.min(F.when(F.col("_cum") >= F.col(k), F.struct("_cum", "_v")))["_v"]
        return Small(cum.groupBy(*keys).agg(((at("_k1") + at("_k2")) / 2.0).alias("_median")))

    first = ranked(F.col("_lo"), F.col("_hi"), long)
    med = first.df
    missed = sketch.df.join(med.where(F.col("_median").isNotNull()), keys, "left_anti")
    if not missed.isEmpty():
        ranks = missed.select(*keys, F.explode(F.array_distinct(F.array("_k1", "_k2"))).alias("_k"))
        again = kth_least(long, keys, ranks).groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2.0).alias("_median"))
        med = med.where(F.col("_median").isNotNull()).unionByName(again)
    out = med.groupBy(group_col).pivot("_col", cols).agg(F.first("_median"))
    return out.select(group_col, *[F.col(c).alias(f"median_{c}") for c in cols])


def kth_least(rows: DataFrame, keys: list[str], ranks: DataFrame) -> DataFrame:
    """``keys, _k, _v``: for every row ``keys, _k`` of ``ranks`` the ``_k``-th least (from 1) ``_v`` of ``rows`` with these keys.

    Rounds of two aggregates: values between the bounds known so far propose
    cuts (quantiles of a sketch, the least value and the middle of the range),
    then a histogram over the cuts tells which bin has the rank, and that
    bin's least and greatest value are the next bounds. Only the histogram is
    ranked, never values, and what the sketch says changes the number
    of rounds only: each at least leaves out the least value or halves the range.
    ``rows`` without nulls and NaNs. Ranks beyond the number of values give no row.
    """
    state = Small(ranks.select(*keys, "_k", F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"), F.lit(0).cast("long").alias("_below")))
    parts = [i / CUTS for i in range(1, CUTS)]
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    rank = Window.partitionBy(*keys, "_k").orderBy("_bin")  # over CUTS + 2 bins at most
    done = []
    while True:
        cuts = state.join(rows, keys).where(inside).groupBy(*keys, "_k", "_lo", "_hi", "_below").agg(
            F.percentile_approx("_v", parts, 50 * CUTS).alias("_cuts"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        cuts = Small(cuts.withColumn("_cuts", F.concat("_cuts", F.array("_a", F.col("_a") / 2 + F.col("_b") / 2))).drop("_a", "_b"))
        bins = cuts.join(rows, keys).where(inside).withColumn("_bin", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
        bins = bins.groupBy(*keys, "_k", "_below", "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        bins = bins.withColumn("_upto", F.col("_below") + F.sum("_n").over(rank))
        own = bins.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k")))
        state = Small(own.select(*keys, "_k", "_lo", "_hi", (F.col("_upto") - F.col("_n")).alias("_below")))
        done.append(state.df.where("_lo = _hi").select(*keys, "_k", F.col("_lo").alias("_v")))
        left = state.df.where("_lo < _hi")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        state = Small(left)


def share_beyond(distance: Column, threshold: float) -> Column:
    """Percentage of rows with ``distance`` strictly above ``threshold`` (A5), as an aggregate."""
    return F.avg((distance > F.lit(threshold)).cast("double")) * F.lit(100.0)


def agreement(col: str) -> Column:
    """True when every row of the group has the same non-null value (A8), as an aggregate."""
    return F.count_distinct(F.col(col)) == 1
