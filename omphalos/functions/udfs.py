"""Python-side distance columns, kept to compare against the native columns.

Both wrap the same formula as ``Metric.column``: the row UDF evaluates it
per row with ``math``; the pandas UDF evaluates it on whole Arrow batches
with numpy (no per-row Python loop).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .metrics import Metric, get_metric


def row_udf_distance(metric: str | Metric):
    m = get_metric(metric)

    def distance(x1, y1, x2, y2):
        if x1 is None or y1 is None or x2 is None or y2 is None:
            return None
        return m.scalar(x1, y1, x2, y2)

    return F.udf(distance, DoubleType(), useArrow=True)


def pandas_udf_distance(metric: str | Metric):
    m = get_metric(metric)

    @F.pandas_udf(DoubleType())
    def distance(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
        out = m.numpy(x1.to_numpy(float), y1.to_numpy(float), x2.to_numpy(float), y2.to_numpy(float))
        return pd.Series(out, index=x1.index)

    return distance


def distance_column(metric: str | Metric, implementation: str, x1, y1, x2, y2) -> Column:
    """The distance between two points under one of the three implementations."""
    if implementation == "native":
        return get_metric(metric).column(x1, y1, x2, y2)
    cols = [F.col(c) if isinstance(c, str) else c for c in (x1, y1, x2, y2)]
    if implementation == "udf":
        return row_udf_distance(metric)(*cols)
    if implementation == "pandas_udf":
        return pandas_udf_distance(metric)(*cols)
    raise ValueError(f"Unknown implementation: {implementation!r}. Use 'native', 'udf' or 'pandas_udf'.")
