"""Exact deterministic train/test split and what hangs on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.ranking import before_cutoff, hash_cutoff


def train_test_split(
    df: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    ratio: float = 0.9,
    seed: int = 42,
    distinct_keys: bool = False,
) -> DataFrame:
    """Add ``split``: the first ``floor(n * ratio)`` rows in shuffle order are ``train``.

    The documents are not shuffled: the key of the last train row is found from the keys alone and every
    row is compared with it. With ``distinct_keys`` the unit is the distinct key, for example a text digest,
    so that copies stay on one side.
    """
    keys = list(keys)
    units = df.select(*keys).distinct() if distinct_keys else df
    cutoff = hash_cutoff(units, keys, lambda total: F.floor(total * F.lit(ratio)), seed)
    return df.withColumn("split", F.when(before_cutoff(keys, cutoff, seed), "train").otherwise("test"))


def apply_split(df: DataFrame, members: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with the split a stored manifest gives them; the join strategy is left to AQE."""
    return df.join(members.select(key, "split"), key)


def having_result(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    return df.join(results.select(key), key, "left_semi")


def split_overlap(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` on both sides, with their rows; empty when the split is disjoint.

    One partial aggregate instead of an intersection, so a large group of copies collapses before the shuffle.
    """
    sides = df.groupBy(key).agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    return sides.filter((F.col("train_rows") > 0) & (F.col("test_rows") > 0))


def corpus_counts(documents: DataFrame, min_chars: int = 500) -> DataFrame:
    """Found, processed, train and test counts in one aggregate over ``(n_chars, split)``."""
    kept = F.col("n_chars") >= min_chars
    return documents.agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(kept).alias("processed"),
        F.count_if(kept & (F.col("split") == "train")).alias("train_size"),
        F.count_if(kept & (F.col("split") == "test")).alias("test_size"),
    )
