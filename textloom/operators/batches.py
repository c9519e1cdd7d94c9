"""Batch planning: epochs, batch sizes, batched scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.ranking import global_rank, sorted_rank
from textloom.operators.tokens import IGNORED_LABEL

EVAL_BATCH = 4  # fixed value: rows per batch in evaluation


def epoch_batches(
    samples: DataFrame, keys: Sequence[str], epochs: int, batch_size: int, accumulation: int = 1, seed: int = 42
) -> DataFrame:
    """``(epoch, batch_id, pos_in_batch, step, *keys)``: every epoch is shuffled anew and cut into batches."""
    rows = samples.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    seeded = F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"))
    ranked = global_rank(rows, keys, seeded, within=["epoch"])
    place = F.col("rank") - 1
    batch = F.floor(place / batch_size)
    return ranked.select(
        "epoch",
        batch.alias("batch_id"),
        F.pmod(place, F.lit(batch_size)).cast("int").alias("pos_in_batch"),
        F.floor(batch / accumulation).alias("step"),
        *keys,
    )


def batch_size_frontier(
    samples: DataFrame, order: Sequence[str], cost: str, low: int, high: int, budget: int
) -> DataFrame:
    """For every batch size the worst batch of all samples in order, and whether it fits the budget.

    Places come from a range-partitioned sort. Each range sums its own part of every batch before the shuffle, so
    about one row per batch and size moves. Fitting is not monotone when cost depends on the data, so
    :func:`largest_batch` reports both the largest size that fits and the largest below which all fit.
    """
    placed = sorted_rank(samples.select(*order, F.col(cost).alias("_cost")), [F.col(c) for c in order], "_place")
    sized = placed.select("_cost", "_place", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("batch_size"))
    batch = F.floor(F.col("_place") / F.col("batch_size"))
    worst = sized.groupBy("batch_size", batch.alias("_batch")).agg(F.sum("_cost").alias("_total"))
    return worst.groupBy("batch_size").agg(
        F.max("_total").alias("worst_cost"), (F.max("_total") <= budget).alias("fits")
    )


def largest_batch(frontier: DataFrame, low: int, high: int) -> DataFrame:
    """``largest_fit`` and ``largest_safe``; null when no size fits."""
    first_misfit = F.min(F.when(~F.col("fits"), F.col("batch_size")))
    safe = F.coalesce(first_misfit - 1, F.lit(high))
    return frontier.agg(
        F.max(F.when(F.col("fits"), F.col("batch_size"))).alias("largest_fit"),
        F.when(safe >= low, safe).alias("largest_safe"),
    )


def score_rows(
    samples: DataFrame,
    scorer: Callable[[], Callable[[list[np.ndarray], list[np.ndarray]], Sequence[float]]],
    keys: Sequence[str] = ("doc_id", "chunk_no"),
    ids: str = "input_ids",
    labels: str = "labels",
) -> DataFrame:
    """``(*keys, loss_sum, labelled, positions)`` of each row: narrow rows whatever the scorer reads.

    ``scorer()`` runs once per task (load a model there). Its result maps a list of id arrays and a list of label arrays
    to the summed loss over the labelled positions of each row. Labels of ``IGNORED_LABEL`` are not counted.
    """
    keys = list(keys)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss_of = scorer()
        for batch in batches:
            rows, gold = (_arrays(batch.column(name)) for name in (ids, labels))
            loss = [float(x) for x in loss_of(rows, gold)] if rows else []
            labelled = [int(np.count_nonzero(row != IGNORED_LABEL)) for row in gold]
            figures = [pa.array(loss, pa.float64()), pa.array(labelled, pa.int64()), pa.array([len(row) for row in rows], pa.int64())]
            names = [*keys, "loss_sum", "labelled", "positions"]
            yield pa.RecordBatch.from_arrays([*[batch.column(key) for key in keys], *figures], names=names)

    types = dict(samples.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["loss_sum double", "labelled bigint", "positions bigint"])
    return samples.select(*keys, ids, labels).mapInArrow(score, schema)


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """Each row of a list column as a view of its flat values; a null is an empty row."""
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


def score_batches(scores: DataFrame, plan: DataFrame, keys: Sequence[str] = ("doc_id", "chunk_no")) -> DataFrame:
    """``(batch_id, loss, positions)``: mean loss over the labelled positions of each planned batch.

    ``scores`` comes from :func:`score_rows`, ``plan`` has ``(*keys, batch_id)``. Which task scored a row has no part in the
    result. A batch without labelled positions has a null loss.
    """
    joined = scores.join(plan.select(*keys, "batch_id"), list(keys))
    total = F.sum("labelled")
    return joined.groupBy("batch_id").agg(
        F.when(total > 0, F.sum("loss_sum") / total).alias("loss"), F.sum("positions").alias("positions")
    )


def evaluation_plan(rows: DataFrame, keys: Sequence[str] = ("doc_id", "chunk_no"), batch_size: int = EVAL_BATCH) -> DataFrame:
    """``(*keys, batch_id)``: rows in the order of their keys, cut into batches."""
    placed = sorted_rank(rows.select(*keys), [F.col(k) for k in keys], "_place")
    return placed.select(*keys, F.floor(F.col("_place") / batch_size).alias("batch_id"))
