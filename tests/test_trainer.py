import numpy as np
import pytest

from textloom.operators import trainer

GRID = {"slow": {"rate": 0.01}, "fast": {"rate": 0.3}, "held": {"rate": 0.3, "penalty": 0.5}}


def rows(spark, n=400, parts=5):
    r = np.random.default_rng(n)
    x = r.normal(size=(n, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + r.normal(0, 0.1, n)
    data = [(*map(float, a), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))]
    data += [(None, 1.0, 1.0, 1.0, False), (1.0, 1.0, 1.0, None, True)]
    return spark.createDataFrame(data, "a double, b double, c double, y double, test boolean").repartition(parts), x, y


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_the_fit_on_one_machine(spark, parts):
    frame, x, y = rows(spark, parts=parts)
    got = {r.run: r for r in trainer.train_grid(frame, GRID, ["a", "b", "c"], "y", "test", steps=30).collect()}
    test = np.arange(len(y)) % 4 == 0
    wide = np.column_stack([np.ones(len(y)), x])
    losses = {}
    for run, arguments in GRID.items():
        w = np.zeros(4)
        for _ in range(30):
            w -= arguments["rate"] * (wide[~test].T @ (wide[~test] @ w - y[~test]) / (~test).sum() + arguments.get("penalty", 0) * w)
        losses[run] = ((wide[test] @ w - y[test]) ** 2).mean() / 2
        assert np.allclose(got[run].parameters, w) and np.isclose(got[run].test_loss, losses[run])
        assert (got[run].train_rows, got[run].test_rows) == (300, 100)
    assert [r for r, _ in sorted(got.items(), key=lambda e: e[1].position)] == sorted(losses, key=losses.get)


def test_trainers_of_the_user_and_ranks(spark):
    class MeanTrainer:
        """A trainer of the user's own."""

        def __init__(self, shrink):
            self.shrink = shrink

        def start(self, width):
            return np.zeros(1)

        def sums(self, parameters, x, y):
            return np.array([y.sum()])

        def move(self, parameters, sums, n):
            return self.shrink * sums / n

        def loss(self, parameters, x, y):
            return float(((y - parameters[0]) ** 2).sum())

    frame, _, y = rows(spark)
    got = trainer.train_grid(frame, {"a": {"shrink": 1.0}, "b": {"shrink": 0.1}}, ["a"], "y", "test", 1, MeanTrainer).collect()
    test = np.arange(len(y)) % 4 == 0
    assert [r.run for r in got] == ["a", "b"] and np.isclose(got[0].parameters[0], y[~test].mean())


def test_no_rows(spark):
    frame, _, _ = rows(spark)
    for part in (frame.limit(0), frame.filter("test"), frame.filter("not test")):
        got = trainer.train_grid(part, GRID, ["a", "b", "c"], "y", "test", 2).collect()
        assert [r.run for r in got] == sorted(GRID) and all(r.test_loss is None for r in got)
