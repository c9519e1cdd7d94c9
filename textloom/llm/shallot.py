"""Exact k-means over integer vectors by Shallot search.

Vectors stand in rows of up to ``BLOCK`` with what each remembers: its centroid, the second nearest one, an upper bound
of the distance to the first and a lower bound of the distance to every other. A round moves the bounds by how far the
centroids moved. Where they no longer tell the centroid, the two remembered distances are computed, and the search
starts from the closer one: its neighbours are scanned in order of their distance from it, until they lie outside the
ball whose radius is the distance to the start plus the distance to the second nearest so far, which shrinks as closer
ones are found. Bounds carry a margin for rounding; whatever they leave open is compared in integers, and equal
distances go to the smaller number, so the result is that of comparing all centroids.

Every round is one narrow pass over the stored blocks, which sums each cluster inside the block; a few hundred sums
are all that is gathered. Nothing is grouped by cluster, so a cluster of any size is no task of its own. Each round's
blocks are a table in the shared folder; the one before is deleted.

Results for odd input: vectors of another length, or with null or non-finite components, are left out, and so are those
with a component beyond 2^17, whose squared distances would not fit 64 bits. Copies and repeated ids are vectors each.
A null id is kept; it starts no centroid while others can. With fewer vectors than centroids every vector starts one.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, discard, store

CENTROIDS = 8
ROUNDS = 10
DIMENSION = 64
SCALE = 1_024
SEED = 3
LARGEST = 1 << 17
BLOCK = 4_096
SLACK = 1e-12


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float)) * (1 + SLACK)


def _below(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float)) * (1 - SLACK)


class Centres:
    """Centroids of a round: how they lie to each other, and how far they moved since the round before."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None) -> None:
        self.at, k = now, len(now)
        squares = np.array([_squares(now, c) for c in now]).reshape(k, k)
        far = _below(squares)
        np.fill_diagonal(far, np.inf)
        self.half = far.min(1) / 2
        self.gap = np.sort(far, axis=1)[:, : k - 1]
        self.neighbours = np.argsort(far, axis=1, kind="stable")[:, : k - 1]
        self.moved = np.zeros(k) if before is None else _above(_squares(now, before))
        others = np.where(np.eye(k, dtype=bool), 0, self.moved[None])
        self.others = others.max(1)
        self.compared = 0

    def distances(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        self.compared += len(x)
        return _squares(x, self.at[number])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """State of vectors without one: every centroid is compared."""
        n, k = len(x), len(self.at)
        squares = np.array([self.distances(x, np.full(n, j)) for j in range(k)]).T
        order = np.argsort(squares, axis=1, kind="stable")
        nearest, second = order[:, 0], order[:, min(1, k - 1)]
        rows = np.arange(n)
        lower = _below(squares[rows, second]) if k > 1 else np.full(n, np.inf)
        return nearest, second, _above(squares[rows, nearest]), lower

    def search(self, x: np.ndarray, nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """State after the centroids moved."""
        nearest, second = nearest.copy(), second.copy()
        upper = (upper + self.moved[nearest]) * (1 + SLACK)
        lower = (lower - self.others[nearest]) * np.where(lower > self.others[nearest], 1 - SLACK, 1 + SLACK)
        left = np.flatnonzero(~(upper < np.maximum(lower, self.half[nearest])))
        own = self.distances(x[left], nearest[left])
        upper[left] = _above(own)
        still = ~(upper[left] < np.maximum(lower[left], self.half[nearest[left]]))
        left, own = left[still], own[still]
        if not len(left):
            return nearest, second, upper, lower
        a, b = nearest[left], second[left]
        other = self.distances(x[left], b)
        closer = (other < own) | ((other == own) & (b < a))
        best, best_at = np.where(closer, other, own), np.where(closer, b, a)
        next_, next_at = np.where(closer, own, other), np.where(closer, a, b)
        centre, radius, alive = best_at.copy(), _above(best), np.ones(len(left), bool)
        for place in range(self.gap.shape[1]):
            alive &= self.gap[centre, place] <= radius + _above(next_)
            if not alive.any():
                break
            number = self.neighbours[centre, place]
            row = np.flatnonzero(alive & (number != a) & (number != b))
            found, j = self.distances(x[left[row]], number[row]), number[row]
            wins = (found < best[row]) | ((found == best[row]) & (j < best_at[row]))
            ahead = wins | (found < next_[row])
            row, found, j, wins = row[ahead], found[ahead], j[ahead], wins[ahead]
            next_[row], next_at[row] = np.where(wins, best[row], found), np.where(wins, best_at[row], j)
            best[row[wins]], best_at[row[wins]] = found[wins], j[wins]
        nearest[left], second[left], upper[left], lower[left] = best_at, next_at, _above(best), _below(next_)
        return nearest, second, upper, lower


# --- rounds over stored blocks ---------------------------------------------------------------------------------------

STATE = "nearest array<int>, second array<int>, upper array<double>, lower array<double>, distance array<bigint>, sums array<bigint>"


def _integers(df: DataFrame, vector: str, vec_id: str, dimension: int) -> DataFrame:
    """``(id, x)``: kept vectors as integer arrays."""
    values = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    usable = lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)  # noqa: E731  NaN is larger than any number
    kept = values.filter((F.size("v") == dimension) & F.forall("v", usable))
    return kept.select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("int")).alias("x"))


def _packed(vectors: DataFrame, kind: str) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                ids = part.column(0)
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                body = part.column(1).flatten().to_numpy().astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays([ids, pa.array([body], pa.binary())], names=["ids", "x"])

    return vectors.mapInArrow(pack, f"ids array<{kind}>, x binary")


def _assigned(blocks: DataFrame, now: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """Blocks with the state of this round; ``sums`` has components, members and squared distances of each cluster."""
    shared = blocks.sparkSession.sparkContext.broadcast((now, before))
    fresh = before is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(*shared.value)
        k, width = centres.at.shape
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                x = np.frombuffer(row.column(1)[0].as_py(), "<i4").reshape(-1, width).astype(np.int64)
                if fresh:
                    state = centres.first(x)
                else:
                    state = centres.search(x, *(row.column(c).flatten().to_numpy() for c in ("nearest", "second", "upper", "lower")))
                nearest, distance = state[0], _squares(x, centres.at[state[0]])
                sums = np.zeros((k, width + 2), np.int64)
                order = np.argsort(nearest, kind="stable")
                here, first = np.unique(nearest[order], return_index=True)
                sums[here] = np.add.reduceat(np.column_stack([x, np.ones(len(x), np.int64), distance])[order], first)
                lists = [*zip(state, (pa.int32(), pa.int32(), pa.float64(), pa.float64())), (distance, pa.int64()), (sums.ravel(), pa.int64())]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in lists]
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(1), *lists],
                    names=["ids", "x", "nearest", "second", "upper", "lower", "distance", "sums"],
                )

    kept = blocks.schema["ids"].dataType.simpleString()
    return blocks.mapInArrow(run, f"ids {kept}, x binary, {STATE}")


def _totals(blocks: DataFrame, shape: tuple[int, int]) -> list[list[int]]:
    """Sums of all blocks as Python's integers, a row for each centroid."""
    parts = blocks.select(F.posexplode("sums").alias("place", "part"))
    sums = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    found = {r.place: int(r.total) for r in sums.collect()}  # a few hundred
    return [[found.get(i * shape[1] + j, 0) for j in range(shape[1])] for i in range(shape[0])]


def cluster(
    df: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    seed: int = SEED,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that is kept."""
    spark, kind = df.sparkSession, df.schema[vec_id].dataType.simpleString()
    integers = _integers(bounded_batches(df), vector, vec_id, dimension)
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = integers.orderBy(by.asc_nulls_last(), "x").select("x").limit(centroids).collect()
    schema = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not start:
        return spark.createDataFrame([], schema)
    now = np.array([r.x for r in start], np.int64)
    before, (blocks, path) = None, store(_packed(integers, kind), "vectors")
    for step in range(rounds + 1):
        after, after_path = store(_assigned(blocks, now, before), "vectors")
        discard(spark, path)
        blocks, path = after, after_path
        totals = _totals(blocks, (len(now), dimension + 2))
        if step < rounds:
            moved = [[c // t[dimension] for c in t[:dimension]] if t[dimension] else c.tolist() for t, c in zip(totals, now)]
            before, now = now, np.array(moved, np.int64)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(i).flatten() for i in range(3)], names=["vec_id", "cluster", "distance"])

    rows = blocks.select("ids", "nearest", "distance").mapInArrow(unpack, f"vec_id {kind}, cluster int, distance bigint")
    inertia = [t[dimension + 1] for t in totals]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in now]
    facts = [(i, inertia[i], sum(inertia), digest) for i, digest in enumerate(digests)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in schema.split(", ")])


def _oracle() -> str:
    """The same by comparing every centroid with every vector, coordinate by coordinate."""
    steps = [
        f"""WITH kept AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding::DOUBLE[], lambda x: isfinite(x) AND abs(x) <= {LARGEST})) = {DIMENSION}
), coords AS MATERIALIZED (
  SELECT vec_id, generate_subscripts(v, 1) AS pos, floor({SCALE} * unnest(v))::BIGINT AS x FROM kept
), start AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS num FROM kept
  QUALIFY num < {CENTROIDS}
), c0 AS MATERIALIZED (SELECT num, pos, x AS c FROM start JOIN coords USING (vec_id))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, num, d FROM (
    SELECT vec_id, num, sum((x - c) * (x - c))::BIGINT AS d FROM coords JOIN c{r} USING (pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, num) = 1
)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""s{r} AS (SELECT num, pos, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} JOIN coords USING (vec_id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT num, pos, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c FROM c{r} LEFT JOIN s{r} USING (num, pos)
)"""
            )
    last = ROUNDS
    return (
        ",\n".join(steps)
        + f"""
SELECT vec_id, num::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY num))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM a{last} JOIN (SELECT num, sha256(string_agg(c::VARCHAR, ',' ORDER BY pos)) AS digest FROM c{last} GROUP BY num) USING (num)
"""
    )


ORACLE = _oracle()
