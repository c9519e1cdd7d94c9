"""Snapshots of sources and what changed between two of them, found by comparing hashes of buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF_DIGITS = 4  # 65,536 leaves below 256 branches
BRANCH_DIGITS = 2


def _bucket(keys: Sequence[str]) -> Column:
    return F.substring(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), 1, LEAF_DIGITS)


def _branch() -> Column:
    return F.concat(F.lit("b"), F.substring("leaf", 1, BRANCH_DIGITS))  # never read as a number


def bucket_hashes(rows: DataFrame, by: Column, name: str) -> DataFrame:
    """``(name, entries, hash)``: what the rows ``(entries, hash)`` of each bucket sum up to, whatever their order."""
    return rows.groupBy(by.alias(name)).agg(
        F.sum("entries").alias("entries"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("hash")
    )


def write_snapshot(sources: DataFrame, keys: Sequence[str], digest: str, path: str) -> None:
    """Store ``(*keys, digest)`` by branch and the hashes of leaves and branches; ``keys`` name a source and are not null.

    A leaf's hash is the sum of the hashes of its entries, a branch's that of its leaves, so one pass with a combine before
    the shuffle makes the tree. The tree has at most 65,536 leaves, whatever the number of sources.
    """
    spark = sources.sparkSession
    rows = sources.select(*keys, F.coalesce(F.col(digest), F.lit("")).alias("digest")).withColumn("leaf", _bucket(keys))
    rows = rows.withColumn("branch", _branch())
    rows.limit(0).write.parquet(f"{path}/schema")  # partitions of no rows would keep none
    rows.repartition("branch").write.partitionBy("branch").parquet(f"{path}/rows")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    entry = stored.select("leaf", F.lit(1).cast("bigint").alias("entries"), F.xxhash64(*keys, "digest").alias("hash"))
    leaves = bucket_hashes(entry, F.col("leaf"), "leaf")
    leaves.write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")
    bucket_hashes(leaves.withColumn("hash", F.xxhash64("leaf", "entries", "hash")), _branch(), "branch").write.parquet(f"{path}/branches")


def _differing(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """Buckets that are not the same on both sides."""
    same = old.join(new, [name, "entries", "hash"])
    return old.select(name).union(new.select(name)).distinct().join(same.select(name), name, "left_anti")


def changed_buckets(spark: SparkSession, old: str, new: str) -> tuple[list[str], DataFrame]:
    """Branches that differ, and the leaves that differ in them."""
    read = lambda path, level: spark.read.parquet(f"{path}/{level}")
    branches = sorted(r.branch for r in _differing(read(old, "branches"), read(new, "branches"), "branch").collect())  # 256 at most
    old_leaves, new_leaves = (read(path, "leaves").filter(_branch().isin(branches)) for path in (old, new))
    return branches, _differing(old_leaves, new_leaves, "leaf")


def snapshot_diff(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """``(*keys, change)``: sources that are new, changed or removed.

    Hashes are compared from the top: branches, then leaves of differing branches; rows are read from the partitions of
    differing branches only, and joined for differing leaves only. Two equal snapshots read no rows.
    """
    branches, leaves = changed_buckets(spark, old, new)
    leaves = F.broadcast(leaves)  # at most 65,536 short rows

    def rows(path: str, name: str) -> DataFrame:
        kept = spark.read.parquet(f"{path}/schema").schema
        stored = spark.read.schema(kept).parquet(f"{path}/rows").filter(F.col("branch").isin(branches))
        return stored.join(leaves, "leaf", "left_semi").select(*keys, F.col("digest").alias(name))

    both = rows(old, "_old").join(rows(new, "_new"), list(keys), "full_outer")
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return both.select(*keys, change.alias("change")).filter("change is not null")
