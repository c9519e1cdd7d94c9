import helpers
import numpy as np

from textloom.llm import plans, tiles

SCHEMA = "vec_id long, embedding array<float>, label int, block long, rep long, n string, least int"


def slow(rows, threshold=0.9):
    """Links of each row position and component by all pairs."""
    good = []
    for i, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            good.append(i)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(good)):
        for b in range(a):
            x, y = (np.array(rows[i][1], np.float64) for i in (good[a], good[b]))
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[good[a]] += 1
                links[good[b]] += 1
                p, q = find(good[a]), find(good[b])
                root[max(p, q)] = min(p, q)
    groups = {}
    for i in good:
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((v for v in ids if v is not None), default=None) for g, ids in groups.items()}
    return sorted(
        ((v, links[i], least[find(i)] if i in set(good) else v) for i, (v, _) in enumerate(rows)), key=repr
    )


def planted(seed=1):
    r = np.random.default_rng(seed)
    rows = [r.normal(size=8) for _ in range(60)]
    for k in range(80):
        rows.append(rows[k % 30] + r.normal(size=8) * r.choice([0.05, 0.15, 0.25]))
    rows += [rows[0]] * 5 + [rows[1] * 7.0]
    return [(i * 3 % 997, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "n", 3) for i, v in rows], SCHEMA)


def test_links_are_those_of_all_pairs(spark):
    rows = planted()
    for block in (7, 50, 8192):
        got = tiles.near_vectors(frame(spark, rows), block=block)
        assert helpers.rows_of(got, "vec_id", "n_links", "component_id") == slow(rows)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (None, [3.0, 0.1]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]),
        (11, [1e-30, 0.0]), (12, [3e38, 0.0]),
    ]
    got = tiles.near_vectors(frame(spark, rows))
    assert helpers.rows_of(got, "vec_id", "n_links", "component_id") == slow(rows)
    assert {r.vec_id for r in got.collect() if r.kept} == {1, 2, 3, 4, 5, 6, 7, 9, 10}
    assert tiles.near_vectors(frame(spark, [])).collect() == []


def test_bounds_hold_at_the_threshold():
    """Pairs made to lie just at and below the threshold are told apart in double precision."""
    r = np.random.default_rng(3)
    a = r.normal(size=(400, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = r.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    target = 0.9 + r.choice([-1e-6, 1e-6], 400)
    b = target[:, None] * a + np.sqrt(1 - target**2)[:, None] * side
    found = set()
    for i, j in tiles.tile_links(a, b, 0.9):
        found |= set(zip(i.tolist(), j.tolist()))
    assert {k for k in range(400) if (k, k) in found} == set(np.flatnonzero(target > 0.9).tolist())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in plans.table(spark, sf, "embeddings").collect()]
    got = plans.QUERIES["op5_vector_tiles"](spark, sf)
    assert helpers.rows_of(got, "vec_id", "n_links", "component_id") == slow(rows)
