"""Raw open-data records -> clean point table (C13: P1-P5 with D5).

Keeps active records (status ``ALTA``) that have both UTM coordinates and a
non-blank name; trims text fields the way Python's ``str.strip()`` does
(all Unicode whitespace, not just spaces: ``F.trim`` would leave tabs,
newlines and no-break spaces); parses the coordinates and adds
longitude/latitude with the inverse UTM zone 30N series. All of it is
column expressions over the raw rows; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.projection import with_lonlat

# Fixed values of the source format.
ACTIVE_STATUS = "ALTA"
STATUS_FIELD = "SITUACIÓN"
RENAMES = {  # raw field -> clean column, in output order after center_id
    "CENTRO": "center_name",
    "TIPO_EXT": "center_type",
    "TITULARIDAD": "ownership",
    "MUNICIPIO": "municipality",
    "DAT": "education_area",
}

# Characters Python's str.isspace() accepts: ASCII controls \t \n \v \f \r,
# the separators \x1c-\x1f, NEL (U+0085) and every Unicode separator (Z*).
WHITESPACE_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
_EDGES = rf"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


#: What becomes of a row.
OUTCOMES = ("kept", "inactive", "missing coordinate", "blank name", "bad coordinate")


def strip_text(c) -> Column:
    """``(value or "").strip()`` as a column expression."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_replace(col, _EDGES, ""), F.lit(""))


def parse_number(col: Column) -> Column:
    """A finite decimal number, or null. The cast alone also takes Java's literals (``1.5d``,
    ``0x1p3``) and the words for infinity and not-a-number, all of which have a letter besides e.

    Digits grouped by ``_`` and digits or blanks beyond ASCII aren't taken."""
    value = F.when(~col.rlike("[A-DF-Za-df-z]"), col.try_cast("double"))
    return F.when(F.abs(value) != float("inf"), value)


def classify(raw: DataFrame, on_bad: str = "reject") -> DataFrame:
    """Raw rows plus ``reject_reason`` (null for a usable row) and the parsed
    coordinates ``_utm_x`` / ``_utm_y``.

    ``on_bad="fail"`` raises on a coordinate that is present but not a number
    (the reference stops there); ``"reject"`` routes it to ``bad coordinate``.
    """
    if on_bad not in ("reject", "fail"):
        raise ValueError(f"on_bad must be 'reject' or 'fail', got {on_bad!r}")
    ux, uy = F.col("UTM_X"), F.col("UTM_Y")
    raw = raw.withColumns({"_utm_x": parse_number(ux), "_utm_y": parse_number(uy)})
    px, py = F.col("_utm_x"), F.col("_utm_y")
    missing = ux.isNull() | (ux == "") | uy.isNull() | (uy == "")
    bad = px.isNull() | py.isNull()
    reason = (
        F.when(F.col(STATUS_FIELD).isNull() | (F.col(STATUS_FIELD) != ACTIVE_STATUS), F.lit("inactive"))
        .when(missing, F.lit("missing coordinate"))
        .when(strip_text("CENTRO") == "", F.lit("blank name"))
        .when(bad, F.lit("bad coordinate"))
    )
    # parsed values get their own names: column names resolve case-insensitively,
    # so "utm_x" would replace the raw "UTM_X"
    out = raw.withColumn("reject_reason", reason)
    if on_bad == "fail":
        out = out.withColumn(
            "reject_reason",
            F.when(F.col("reject_reason") == "bad coordinate",
                   F.raise_error(F.concat(F.lit("not a number in UTM_X/UTM_Y: "), F.coalesce(ux, F.lit("")),
                                          F.lit(" / "), F.coalesce(uy, F.lit("")))))
            .otherwise(F.col("reject_reason")),
        )
    return out


def clean_records(raw: DataFrame, on_bad: str = "reject") -> DataFrame:
    """Usable records in the centers layout with longitude/latitude."""
    return _usable(classify(raw, on_bad))


def _usable(classified: DataFrame) -> DataFrame:
    rows = classified.filter(F.col("reject_reason").isNull())
    rows = rows.select(
        F.coalesce(F.col("CODIGO"), F.lit("")).alias("center_id"),  # the id is not trimmed
        *[strip_text(k).alias(v) for k, v in RENAMES.items()],
        F.col("_utm_x").alias("utm_x"), F.col("_utm_y").alias("utm_y"),
    )
    return with_lonlat(rows, "utm_x", "utm_y")


def clean_observed(raw: DataFrame, on_bad: str = "reject") -> tuple[DataFrame, Observation]:
    """``clean_records`` and, from the same scan, its counts of rows kept and dropped (P5).

    The observation's ``get`` has the rows of each outcome once the first action
    on the frame has ended; before, it waits. Counts are of what that action
    read (all rows, unless it stops early, as ``limit`` does); where a lost
    executor makes Spark run a shuffle's tasks again, theirs may count twice.
    An empty input has zeros.
    """
    counts = Observation()
    outcome = F.coalesce(F.col("reject_reason"), F.lit("kept"))
    rows = classify(raw, on_bad).observe(counts, *[F.count_if(outcome == x).alias(x) for x in OUTCOMES])
    return _usable(rows), counts


def reject_counts(raw: DataFrame, on_bad: str = "reject") -> DataFrame:
    """Rows kept and dropped, by reason (P5)."""
    return (classify(raw, on_bad)
            .select(F.coalesce(F.col("reject_reason"), F.lit("kept")).alias("outcome"))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("rows")))
