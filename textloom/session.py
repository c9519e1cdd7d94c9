"""Session defaults, the shared work folder and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textloom", master: str | None = None) -> SparkSession:
    """Session with the settings the operators are tuned for; a cluster's own master is kept."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # collect_list over fixed-size groups stays a hash aggregate instead of falling back to a sort
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "8192")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a fresh folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), "textloom", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing Parquet to the shared folder and reading it back."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Delete everything this library stored below the shared folder; no frame made before may be used after it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_dir(spark), "textloom"))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition row-local text work where the session asks for it.

    ``spark.textloom.inputPartitions`` is for inputs of few splits, such as one file with one row group; without the
    setting the input's own splits are the tasks. Nothing depends on the size of the input.
    """
    partitions = df.sparkSession.conf.get("spark.textloom.inputPartitions", None)
    return df.repartition(int(partitions), *keys) if partitions else df
