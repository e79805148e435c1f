"""Helpers shared by the corpus operators: tables, scratch files, hot-key joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omphalos.session import scratch_dir

#: Words everywhere are runs of characters other than these (space, tab .. CR).
BLANK = r"[\x20\x09-\x0D]+"

#: Spark's setting by which a query's shuffle files are removed at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    A one-element array is mapped and opened again, so that expressions built
    on ``value`` refer to a lambda variable and never repeat its work.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Scratch:
    """Intermediate tables of one operator call, under ``spark.checkpoint.dir``.

    Each is written once as Parquet and read back with its known schema, so a
    lost executor rereads files instead of recomputing; ``drop`` removes those
    that no later step reads. With ``tidy`` the shuffle files of a table go once
    it is written.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.base = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true" if self.tidy else before)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            where = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            where.getFileSystem(conf).delete(where, True)


def hot_lookup(big: DataFrame, small: DataFrame, key: str, weight: str, most_hot: int = 1000) -> DataFrame:
    """``big`` inner-joined with ``small`` (one row for each ``key``) where some keys are hot.

    ``small[weight]`` counts the rows of ``big`` with that key. Keys that hold
    more than 1/``most_hot`` of all rows number at most ``most_hot``, so their
    rows of ``small`` are broadcast, and no task gathers a hot key; all other
    keys meet in a merge join, at every size, as ``small`` grows with the data.
    ``weight`` is not in the result.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    limit = max(5_000, -(-total // most_hot))
    hot = small.where(F.col(weight) > limit).drop(weight)
    if hot.isEmpty():
        return big.join(small.drop(weight).hint("merge"), key)
    cold = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(small.where(F.col(weight) <= limit).drop(weight).hint("merge"), key)
    return cold.unionByName(big.join(F.broadcast(hot), key))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
