"""Order-independent fingerprints and datasets stored under them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import shared_dir


def fingerprint(df: DataFrame, entry: Column) -> DataFrame:
    """One row with ``fingerprint``: md5 over the multiset of ``entry`` values.

    The md5 of each entry is cut into four 32-bit lanes, the lanes are summed, and the sums are digested with
    the row count. Sums combine in any order, so this is a partial aggregate with one row per task and needs
    no sorted list of all entries.
    """
    hashed = df.select(F.md5(entry).alias("_md5"))
    lanes = [
        F.sum(F.conv(F.substring("_md5", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("string") for i in range(4)
    ]
    return hashed.agg(F.md5(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *lanes)).alias("fingerprint"))


def file_entry(path: Column, modified: Column) -> Column:
    return F.concat(path, F.lit(":"), modified.cast("string"), F.lit(";"))


def config_fingerprint(name: Column, max_length: Column) -> Column:
    return F.md5(F.concat_ws("_", name, max_length.cast("string")))


def dataset_key(spark: SparkSession, inputs: DataFrame, entry: Column, **parameters) -> str:
    """Cache key of a stage: the inputs' fingerprint and every parameter that shapes the result."""
    settings = [F.lit(f"{k}={v}") for k, v in sorted(parameters.items())]
    row = fingerprint(inputs, entry).select(F.md5(F.concat_ws("|", "fingerprint", *settings)).alias("key")).first()
    return row["key"]


def cached_dataset(spark: SparkSession, stage: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stored result of ``build`` for this key; built and written when no finished copy exists."""
    path = os.path.join(shared_dir(spark), "textloom", "cache", f"{stage}_{key}")
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
