"""One entry point over both definitions of "most central" (C4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.metrics import COORDINATE_COLUMNS, Metric, get_metric
from .centroid import nearest_to_centroid
from .guards import METHODS, check_choice
from .medoid import medoid


def most_central(
    df: DataFrame,
    group_col: str,
    id_col: str,
    x_col: str | None = None,
    y_col: str | None = None,
    metric: str | Metric = "utm",
    method: str = "centroid",
    ties: str = "all",
    implementation: str = "native",
    **tuning,
) -> DataFrame:
    """Per group, the member nearest its mean (``method="centroid"``) or the
    medoid (``"medoid"``). Coordinates default to the metric's columns of a
    centers table (utm_x/utm_y or longitude/latitude).

    The centroid result carries ``distance``, the medoid result
    ``total_distance``. ``implementation`` applies to the centroid only.
    """
    check_choice("method", method, METHODS)
    m = get_metric(metric)
    if x_col is None or y_col is None:
        if m.name not in COORDINATE_COLUMNS:
            raise ValueError("x_col and y_col are required for a custom metric")
        x_col, y_col = COORDINATE_COLUMNS[m.name]
    if method == "centroid":
        return nearest_to_centroid(df, group_col, x_col, y_col, m, implementation, ties, id_col)
    return medoid(df, group_col, id_col, x_col, y_col, m, ties=ties, **tuning)
