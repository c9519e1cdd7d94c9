"""Exact global order without a single-partition pass over the data.

A keyed hash is uniform whatever the data looks like, so its first four hex digits give 65,536
even buckets. Every table that is put into one task or broadcast here has one row per bucket,
which bounds it whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialise

BUCKET_DIGITS = 4
BLOCK_ROWS = 65_536


def shuffle_hash(seed: int | str | Column, *keys: str) -> Column:
    """md5 of ``seed:key[:key...]``: a shuffle order that survives reordering and repartitioning."""
    head = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", head, *[F.col(k).cast("string") for k in keys]))


def _with_bucket(df: DataFrame, keys: Sequence[str], seed) -> DataFrame:
    return df.withColumn("_hash", shuffle_hash(seed, *keys)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )


def hash_cutoff(df: DataFrame, keys: Sequence[str], take: Callable[[Column], Column], seed=42) -> Column:
    """Scalar subquery: ``struct(hash, *keys)`` of row number ``take(total)`` in shuffle order.

    Comparing rows with it selects exactly the first ``take(total)`` rows. Only the keys are read:
    one partial aggregate for the bucket sizes, then a sort of the single bucket with the cut.
    """
    hashed = _with_bucket(df.select(*keys), keys, seed)
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    placed = sizes.select(
        "_bucket",
        "_n",
        F.sum("_n").over(Window.orderBy("_bucket")).alias("_upto"),
        take(F.sum("_n").over(Window.partitionBy())).alias("_take"),
    )
    cut = placed.filter((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take"))).select(
        "_bucket", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_place")
    )
    order = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    return (
        hashed.join(F.broadcast(cut), "_bucket")  # one row
        .withColumn("_pos", F.row_number().over(order))
        .filter(F.col("_pos") == F.col("_place"))
        .select(F.struct("_hash", *keys))
        .scalar()
    )


def before_cutoff(keys: Sequence[str], cutoff: Column, seed=42) -> Column:
    return F.struct(shuffle_hash(seed, *keys).alias("_hash"), *[F.col(k) for k in keys]) <= cutoff


def global_rank(
    df: DataFrame,
    keys: Sequence[str],
    seed=42,
    rank_col: str = "rank",
    within: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based exact rank in shuffle order; ``keys`` identify a row.

    ``within`` restarts the rank per group.
    Rows are sorted only inside their bucket; the rank is the bucket's offset plus the place inside it. Rank
    narrow key columns and join wide ones afterwards.
    """
    within = list(within)
    hashed = _with_bucket(df, keys, seed)
    sizes = hashed.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*within).orderBy("_bucket")
    offsets = sizes.select(*within, "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    if not within:  # at most 65,536 short rows; with groups the join is on the partitioning of the rank itself
        offsets = F.broadcast(offsets)
    place = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy("_hash", *keys))
    return (
        hashed.withColumn("_pos", place)
        .join(offsets, [*within, "_bucket"])
        .withColumn(rank_col, F.col("_before") + F.col("_pos"))
        .drop("_hash", "_bucket", "_pos", "_before")
    )


def sorted_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Add the 0-based exact rank in a given total order.

    The range-partitioned sort is written once to the shared folder together with partition number and
    position, so the partition offsets (one row per partition) and the rows come from the same sort.
    """
    placed = materialise(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()),
        "sorted",
    )
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    offsets = parts.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(rank_col, F.col("_pos") + F.col("_shift"))
        .drop("_part", "_pos", "_shift")
    )


def running_extremes(
    df: DataFrame,
    group: str,
    order: str,
    extremes: Mapping[str, tuple[str, Column]],
    inclusive: bool,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running max/min per group over an integer ``order`` that is unique inside the group.

    ``extremes`` maps an output column to ``("max" | "min", expression)``. A group may hold most of the
    table, so it is cut into blocks of consecutive order values: each block is a window of bounded size,
    and the extremes of earlier blocks are carried in by an equi-join on the same partitioning.
    """
    pick = {"max": F.max, "min": F.min}
    merge = {"max": F.greatest, "min": F.least}
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block_rows)))
    for name, (_, expression) in extremes.items():
        blocked = blocked.withColumn(f"_in_{name}", expression)
    last = 0 if inclusive else -1
    inside = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy(group, "_block").agg(
        *[pick[kind](f"_in_{name}").alias(f"_in_{name}") for name, (kind, _) in extremes.items()]
    )
    carried = blocks.select(
        group,
        "_block",
        *[pick[kind](f"_in_{name}").over(earlier).alias(f"_carried_{name}") for name, (kind, _) in extremes.items()],
    )
    local = blocked.select(
        *df.columns,
        "_block",
        *[pick[kind](f"_in_{name}").over(inside).alias(f"_local_{name}") for name, (kind, _) in extremes.items()],
    )
    return local.join(carried, [group, "_block"]).select(
        *df.columns,
        *[merge[kind](f"_local_{name}", f"_carried_{name}").alias(name) for name, (kind, _) in extremes.items()],
    )


def sample_n(df: DataFrame, keys: Sequence[str], n: int = 256, seed=42) -> DataFrame:
    """Uniform sample of exactly ``n`` rows without replacement (all rows when there are fewer)."""
    cutoff = hash_cutoff(df, keys, lambda total: F.least(total, F.lit(n)), seed)
    return df.filter(before_cutoff(keys, cutoff, seed))


def first_n(df: DataFrame, order: Sequence[str], n: int = 256) -> DataFrame:
    """First ``n`` rows in order; fewer rows are no error. Every task hands up to ``n`` rows to one merge."""
    return df.orderBy(*order).limit(n)
