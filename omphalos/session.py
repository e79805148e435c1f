"""Session-level helpers: a local session for tests and benches, and a
shared folder for intermediate tables that must outlive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "omphalos") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on.

    The checkpoint folder is set only when the caller has not named one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without either gets a fresh temporary folder;
    on a cluster a machine-local folder would not survive executor loss,
    so the setting is required there.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get(CHECKPOINT_CONF, None)
        if not path:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    f"set {CHECKPOINT_CONF} to a shared folder (HDFS/S3/...) before running staged plans"
                )
            path = tempfile.mkdtemp(prefix="omphalos-ckpt-")
            spark.conf.set(CHECKPOINT_CONF, path)
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    One pass, columnar and splittable; the lineage is cut, so a lost executor
    re-reads the file instead of recomputing the upstream stages.
    """
    spark = df.sparkSession
    base = scratch_dir(spark).rstrip("/")
    path = f"{base}/omphalos-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: no footer inference
    out._written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for frames that nothing reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(df._written_to)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


__all__ = ["local_session", "scratch_dir", "materialize", "discard", "CHECKPOINT_CONF"]
