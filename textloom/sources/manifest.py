"""Split manifests: one JSON object per file name, and back to ``(file_name, split)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.ranking import global_rank
from textloom.session import work_path

MANIFEST_SCHEMA = "file_name string, split string, rank bigint, train_size bigint, test_size bigint, created_at string"


def manifest_rows(
    files: DataFrame,
    key: str = "doc_id",
    name_col: str = "file_name",
    ratio: float = 0.9,
    seed: int = 42,
    created_at: Column | None = None,
) -> DataFrame:
    """``(file_name, split, rank, train_size, test_size[, created_at])``, a row per file, in one form for every corpus size.

    Files are ranked once; rank and number of files give both the side and the sizes.
    """
    ranked = global_rank(files.select(key, name_col), [key], seed)
    total = files.agg(F.count(F.lit(1))).scalar()
    train = F.floor(F.col("_total") * F.lit(ratio))
    fields = [
        F.col(name_col).alias("file_name"),
        F.when(F.col("rank") <= train, "train").otherwise("test").alias("split"),
        "rank",
        train.alias("train_size"),
        (F.col("_total") - train).alias("test_size"),
    ]
    if created_at is not None:
        fields.append(created_at.alias("created_at"))
    return ranked.withColumn("_total", total).select(*fields)


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, split)`` rows of a stored manifest."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path).select("file_name", "split")


def load_or_split(spark: SparkSession, files: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Members of the stored manifest; when there is none, split, store and read it back."""
    path = path or work_path(spark, "manifest")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        write_manifest(manifest_rows(files, **options), path)
    return read_manifest(spark, path)
