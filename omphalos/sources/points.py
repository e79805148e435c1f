"""Point tables in the centers layout, derived from the driver's parquet tables.

The reference works on one table of located members (id, name, group,
UTM metres and longitude/latitude). These views build that layout from the
TPC-H-like tables so every query scales with them: UTM coordinates are an
affine map of table columns around Madrid (zone 30N) and longitude/latitude
come from the inverse projection, exactly as the reference derives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projection import with_lonlat

# Fixed values of the derivation (also used verbatim in the SQL oracle).
EASTING0 = 440_000.0
NORTHING0 = 4_474_000.0
SPREAD_MULT = 7919
SPREAD_MOD = 2003
SPREAD_MID = 1001
SPREAD_STEP_M = 50.0

CENTER_COLS = ["center_id", "center_name", "ownership", "utm_x", "utm_y", "longitude", "latitude"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_easting(key: str) -> Column:
    """A key scattered over +-50 km of easting: (key * 7919 % 2003 - 1001) * 50 m."""
    k = (F.col(key) * F.lit(SPREAD_MULT)) % F.lit(SPREAD_MOD) - F.lit(SPREAD_MID)
    return F.lit(EASTING0) + k.cast("double") * F.lit(SPREAD_STEP_M)


def as_centers(df: DataFrame, center_id: Column, center_name: Column, group: Column, x: Column, y: Column,
               lonlat: bool = True) -> DataFrame:
    base = df.select(
        center_id.alias("center_id"),
        center_name.alias("center_name"),
        group.alias("ownership"),
        x.cast("double").alias("utm_x"),
        y.cast("double").alias("utm_y"),
    )
    if not lonlat:
        return base
    return with_lonlat(base, "utm_x", "utm_y")


def customer_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers grouped by market segment; northing from the account balance."""
    c = table(spark, sf_dir, "customer")
    return as_centers(c, F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"),
                      spread_easting("c_custkey"), F.lit(NORTHING0) + F.col("c_acctbal"))


def orders_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders grouped by priority; easting from the customer, northing from the price."""
    o = table(spark, sf_dir, "orders")
    return as_centers(o, F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"),
                      spread_easting("o_custkey"), F.lit(NORTHING0) + F.col("o_totalprice") / F.lit(10.0))


def events_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events grouped by type; easting from the user, northing from the value."""
    e = table(spark, sf_dir, "events")
    return as_centers(e, F.col("event_id"), F.col("event_type"), F.col("event_type"),
                      spread_easting("user_id"), F.lit(NORTHING0) + F.col("value") * F.lit(100.0))


def part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts grouped by brand on the plane (size, retail price): many small groups."""
    p = table(spark, sf_dir, "part")
    return as_centers(p, F.col("p_partkey"), F.col("p_name"), F.col("p_brand"),
                      F.col("p_size"), F.col("p_retailprice"), lonlat=False)


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items grouped by return flag on the plane (quantity, extended price).

    The id ``l_orderkey * 10 + l_linenumber`` is not unique: the duplicate-id case.
    """
    li = table(spark, sf_dir, "lineitem")
    return as_centers(li, F.col("l_orderkey") * F.lit(10) + F.col("l_linenumber"), F.col("l_linestatus"),
                      F.col("l_returnflag"), F.col("l_quantity"), F.col("l_extendedprice"), lonlat=False)


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings grouped by label on the plane of their first two components."""
    e = table(spark, sf_dir, "embeddings")
    return as_centers(e, F.col("vec_id"), F.col("vec_id").cast("string"), F.col("label").cast("string"),
                      F.element_at("embedding", 1), F.element_at("embedding", 2), lonlat=False)


def mirrored_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part points mirrored at both axes: four locations tie wherever one is best."""
    p = part_points(spark, sf_dir).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return p.select(
        (F.col("center_id") * 4 + F.col("_k")).alias("center_id"), "center_name", "ownership",
        (F.col("utm_x") * F.when(F.col("_k") % 2 == 0, 1.0).otherwise(-1.0)).alias("utm_x"),
        (F.col("utm_y") * F.when(F.col("_k") < 2, 1.0).otherwise(-1.0)).alias("utm_y"),
    )


def customer_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw open-data style records (all strings) derived from ``customer``.

    Exercises the cleaning job on the driver's data: status BAJA for a
    negative balance, padded names (space, tab, no-break space, newline), a
    blank name for nation 3, an empty UTM_X for nation 5 and a non-numeric
    one for nation 7.
    """
    c = table(spark, sf_dir, "customer")
    x = spread_easting("c_custkey")
    y = F.lit(NORTHING0) + F.col("c_acctbal")
    nation = F.col("c_nationkey")
    return c.select(
        F.col("c_custkey").cast("string").alias("CODIGO"),
        F.when(F.col("c_acctbal") < 0, F.lit("BAJA")).otherwise(F.lit("ALTA")).alias("SITUACIÓN"),
        F.when(nation == 3, F.lit("\t\u00a0 ")).otherwise(F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\u00a0\n")))
        .alias("CENTRO"),
        F.concat(F.lower("c_mktsegment"), F.lit("\u2003")).alias("TIPO_EXT"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("TITULARIDAD"),
        F.concat(F.lit("N"), nation.cast("string"), F.lit(" ")).alias("MUNICIPIO"),
        F.lit(None).cast("string").alias("DAT"),
        F.when(nation == 5, F.lit("")).when(nation == 7, F.lit("n/a")).otherwise(x.cast("string")).alias("UTM_X"),
        y.cast("string").alias("UTM_Y"),
    )
