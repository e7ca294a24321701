"""Tables written between steps, in the folder that the driver and the executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files go when it ends; on while a table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where it is unset and everything runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='strataloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/strataloom-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and read back: its lineage ends here, and lost executors take nothing with them."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete what written() wrote, once nothing reads it any more.

    The driver collects its garbage then: Spark lets go of broadcasts and shuffle files only when their
    names are collected, and the driver's heap, grown while steps were planned, shrinks again.
    """
    if hasattr(df, "_written_at"):
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        df.sparkSession._jvm.System.gc()
