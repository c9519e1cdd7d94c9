"""Column functions on numbers, and runs of bounded size for work on batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def grad_accum(batch_size: Column, base: int = 32) -> Column:
    """Accumulation steps that keep the effective batch near ``base``; at least 1."""
    return F.greatest(F.lit(1), F.floor(F.lit(base) / batch_size)).cast("int")


def effective_batch(batch_size: Column, base: int = 32) -> Column:
    return (batch_size * grad_accum(batch_size, base)).cast("int")


def percent(used: Column, total: Column) -> Column:
    return F.round(used / total * 100, 1)


def percent_floor(used: Column, total: Column) -> Column:
    """Integer percent, rounded down, of integer amounts."""
    return F.call_function("div", used.cast("decimal(20,0)") * 100, total.cast("decimal(20,0)"))


def gigabytes(size: Column) -> Column:
    return size / F.lit(1e9)


def perplexity_of(loss: Column) -> Column:
    return F.exp(loss)


def bounded_runs(sizes: Sequence[int] | np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Start and end of consecutive items whose sizes sum to at most ``most`` and one item."""
    last = np.cumsum(sizes, dtype=np.int64) // most
    cuts = (np.flatnonzero(np.diff(last)) + 1).tolist()
    yield from zip([0, *cuts], [*cuts, len(last)]) if len(last) else ()
