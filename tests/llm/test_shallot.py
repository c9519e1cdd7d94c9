import hashlib
import math

import numpy as np
import pytest

from textloom.llm import shallot

VECTORS = "vec_id long, embedding array<float>, label int, distance double, x string, ids int"


def slow(rows, k=8, rounds=10, width=64):
    """All centroids against all vectors in Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(c is not None and math.isfinite(c) and abs(c) <= 1 << 17 for c in v):
            kept.append((i, [math.floor(1024 * float(np.float32(c))) for c in v]))
    if not kept:
        return []
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    at = [list(v) for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for r in range(rounds + 1):
        near = [min((far(v, c), j) for j, c in enumerate(at)) for _, v in kept]
        for j in range(len(at)) if r < rounds else ():
            own = [v for (_, v), (_, n) in zip(kept, near) if n == j]
            at[j] = [sum(c) // len(own) for c in zip(*own)] if own else at[j]
    sums = [sum(d for d, n in near if n == j) for j in range(len(at))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, n, d, sums[n], sum(sums), digest[n]) for (i, _), (d, n) in zip(kept, near)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 0, 0.5, "x", 1) for i, v in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in shallot.cluster(df).collect()), key=repr)


def rows_of(n, seed, groups=10, width=64):
    r = np.random.default_rng(seed)
    centre = r.normal(0, 1, (groups, width))
    return [(i, [float(np.float32(c)) for c in centre[i % groups] + r.normal(0, 0.4, width)]) for i in range(n)]


def test_equals_all_comparisons_with_odd_rows(spark):
    rows = rows_of(150, 1)
    rows += rows[:10] + [(500 + i, rows[3][1]) for i in range(40)] + [(None, rows[4][1]), (None, None)]
    rows += [(700, None), (701, []), (702, [0.5] * 63), (703, [0.5] * 65), (704, [None] + [0.5] * 63)]
    rows += [(705, [math.nan] + [0.5] * 63), (706, [math.inf] + [0.5] * 63), (707, [1e30] * 64), (708, [0.0] * 64), (709, [-131072.0, 131072.0] * 32)]
    assert run(spark, rows) == slow(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], rows_of(1, 2), rows_of(5, 3), [(i, [1.0] * 64) for i in range(20)]], ids=len)
def test_few_and_equal_vectors(spark, rows):
    assert run(spark, rows) == slow(rows)


@pytest.mark.parametrize("k", [1, 2, 3, 40])
def test_search_equals_full_comparison_and_compares_less(k):
    r = np.random.default_rng(k)
    x = (r.integers(0, 12, (2_000, 1)) * 40 + r.integers(-3, 4, (2_000, 6))).astype(np.int64)  # many equal distances
    at = x[r.choice(len(x), k, replace=False)]
    state, before, compared = None, None, 0
    for step in range(12):
        centres = shallot.Centres(at, before)
        state = centres.first(x) if state is None else centres.search(x, *state)
        squares = ((x[:, None] - at[None]) ** 2).sum(2)
        assert (state[0] == squares.argmin(1)).all()
        distance = np.sqrt(squares)
        rows = np.arange(len(x))
        assert (state[2] >= distance[rows, state[0]] * (1 - 1e-9)).all()
        if k > 1:
            assert (state[3] <= np.where(np.arange(k) == state[0][:, None], np.inf, distance).min(1) * (1 + 1e-9)).all()
        compared += centres.compared if step else 0
        before = at
        at = np.array([x[state[0] == j].sum(0) // max((state[0] == j).sum(), 1) if (state[0] == j).any() else at[j] for j in range(k)])
        at = at + (r.integers(-40, 41, at.shape) if step % 4 == 3 else 0)
    if k == 40:
        assert compared < 11 * k * len(x) / 3
