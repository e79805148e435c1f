"""Plan-time argument checks and row guards shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHODS = ("centroid", "medoid")
IMPLEMENTATIONS = ("native", "udf", "pandas_udf")
TIES = ("all", "first")


def check_choice(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"Unknown {name}: {value!r}. Use one of {list(allowed)}.")


def require_columns(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"missing input columns {missing}; have {df.columns}")


def reject_clashes(df: DataFrame, reserved) -> None:
    """Output columns we add must not silently overwrite user columns."""
    clash = sorted(set(df.columns) & set(reserved))
    if clash:
        raise ValueError(f"input already has columns {clash}, which this operator writes; rename them first")


def is_usable(c: str) -> Column:
    col = F.col(c)
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != float("inf"))


def usable_point(x_col: str, y_col: str) -> Column:
    """Both coordinates present and finite.

    Otherwise a null coordinate would sort first, and a NaN or infinite one
    poison the group's mean.

    Operators fold this flag into their aggregates and rank filters instead
    of filtering rows up front: a row filter is pushed by Catalyst through
    the projection that computed the coordinates and re-evaluates it inline.
    """
    return is_usable(x_col) & is_usable(y_col)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when a key repeats. One aggregation job; only a single offending key
    reaches the driver."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).limit(1).collect()
    if dup:
        row = dup[0].asDict()
        raise ValueError(f"key {keys} is not unique, e.g. {row}")
