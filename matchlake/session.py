"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: nothing here needs a restarted session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC and adaptive execution; dates and minute floors are meant in UTC."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    # local-cluster has executors of its own, and so is a cluster here.
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="matchlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``."""
    return f"{_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def pinned(df: DataFrame) -> DataFrame:
    """Compute a small or key-only frame once, in storage that outlives executors and goes
    with the application."""
    from matchlake.sources import files

    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "pinned")
    files.make_parents(spark, path)
    files.delete_on_exit(spark, path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
