"""Training every row of a grid at once, on data that no single task holds.

Each step is one pass over the stored rows: a task adds up what every configuration's trainer says of its rows, the
sums meet in two levels, and the driver moves the parameters, which are as many as the models have. A trainer is a
class with the four methods of :class:`LinearTrainer`; any model whose step needs sums over rows fits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialise

SHARDS = 32


class LinearTrainer:
    """Least squares with an intercept and a penalty, by gradient steps; parameters are the weights, intercept first."""

    def __init__(self, rate: float = 0.1, penalty: float = 0.0) -> None:
        self.rate, self.penalty = rate, penalty

    def start(self, width: int) -> np.ndarray:
        return np.zeros(width + 1)

    def sums(self, parameters: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """What a step needs of some rows: the gradient's sum."""
        wrong = x @ parameters[1:] + parameters[0] - y
        return np.concatenate([[wrong.sum()], wrong @ x])

    def move(self, parameters: np.ndarray, sums: np.ndarray, rows: int) -> np.ndarray:
        return parameters - self.rate * (sums / rows + self.penalty * parameters)

    def loss(self, parameters: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
        """Loss summed over some rows."""
        wrong = x @ parameters[1:] + parameters[0] - y
        return float(wrong @ wrong) / 2


def _summed(rows: DataFrame, models: Sequence[tuple[Any, np.ndarray]], of: Callable) -> tuple[np.ndarray, int]:
    """``of(trainer, parameters, x, y)`` summed over all rows for each model, and the number of rows.

    The models travel with the function, by value, so that a trainer may be a class of the caller's own script.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [None] * len(models), 0
        for batch in batches:
            y = batch.column(1).to_numpy()
            x = batch.column(0).flatten().to_numpy().reshape(len(y), -1) if len(y) else None
            for i, (trainer, parameters) in enumerate(models if len(y) else ()):
                part = np.atleast_1d(of(trainer, parameters, x, y))
                total[i] = part if total[i] is None else total[i] + part
            n += len(y)
        if n:
            shard = TaskContext.get().partitionId() % SHARDS
            values = [np.append(t, n) for t in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array([shard] * len(values), pa.int32()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))],
                names=["model", "shard", "sums"],
            )

    parts = rows.select("x", "y").mapInArrow(run, "model int, shard int, sums array<double>")
    parts = parts.select("model", "shard", F.posexplode("sums").alias("place", "value"))
    near = parts.groupBy("model", "shard", "place").agg(F.sum("value").alias("value"))
    found = near.groupBy("model", "place").agg(F.sum("value").alias("value")).toArrow()  # a row per parameter
    if not len(found):
        return np.zeros((len(models), 0)), 0
    table = np.zeros((len(models), found["place"].to_numpy().max() + 1))
    table[found["model"].to_numpy(), found["place"].to_numpy()] = found["value"].to_numpy()
    return table[:, :-1], int(table[0, -1])


def train_grid(
    rows: DataFrame,
    grid: Mapping[str, Mapping[str, float]],
    features: Sequence[str],
    target: str,
    test: str,
    steps: int = 20,
    trainer: Callable[..., Any] = LinearTrainer,
) -> DataFrame:
    """``(position, run, parameters, train_rows, test_rows, test_loss)``, the lowest mean loss on the test rows first.

    ``grid`` names runs and the arguments of their trainers, ``test`` is a boolean column. Rows with a null feature or
    target are left out. Without train or test rows losses are null. Ties go by name.
    """
    spark = rows.sparkSession
    usable = rows.filter(" and ".join(f"`{c}` is not null" for c in (*features, target)))
    x = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    usable = materialise(usable.select(x, F.col(target).cast("double").alias("y"), F.coalesce(F.col(test), F.lit(False)).alias("test")), "examples")
    learned, judged = usable.filter("not test"), usable.filter("test")
    models = [(trainer(**arguments), None) for arguments in grid.values()]
    models = [(t, t.start(len(features))) for t, _ in models]
    n = 0
    for _ in range(steps):
        sums, n = _summed(learned, models, lambda t, p, x, y: t.sums(p, x, y))
        if not n:
            break
        models = [(t, t.move(p, s, n)) for (t, p), s in zip(models, sums)]
    losses, m = _summed(judged, models, lambda t, p, x, y: t.loss(p, x, y))
    out = [
        (run, [float(v) for v in p], n, m, float(losses[i, 0]) / m if n and m else None)
        for i, (run, (_, p)) in enumerate(zip(grid, models))
    ]
    table = spark.createDataFrame(out, "run string, parameters array<double>, train_rows long, test_rows long, test_loss double")
    place = F.row_number().over(Window.orderBy(F.col("test_loss").asc_nulls_last(), "run"))  # a row per run
    return table.select(place.alias("position"), "*")
