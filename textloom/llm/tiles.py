"""Near copies of embeddings by products of int8 tiles with rigorous error bounds.

Every vector is scaled to length one and quantised to whole numbers of -127 to 127 times a step of its own; the
length of what rounding takes away is its error bound. For vectors a and b with errors e_a and e_b the true cosine
differs from the product of the quantised vectors by at most ``e_a + (1 + e_a) * e_b``. Vectors are dealt into
blocks by hash, every pair of blocks is one tile, and a task multiplies the whole numbers of a tile: products
and sums stay below 2^24, so single-precision BLAS gives them exactly. Only pairs that may reach the threshold
within their bounds are computed again in double precision, in bounded pieces.

A tile hands back one row per vector with a link: how many vectors it links to there, and the smallest linked
vector it is connected with inside the tile. Counts add up, and these rows connect what the links connect; pairs
are never emitted. Equal vectors are one row with a count before any tile is made, so copies cost nothing.

Cost: all pairs of distinct vectors are compared, which is the method; work grows with the square of their number,
moved bytes with that square over the block size, and every task holds two blocks.

Results for odd input: vectors that are null, zero, or hold null or non-finite components link with nothing, and
so do vectors of different length. Repeated rows, with equal ids too, count as vectors of their own. A null id links,
counts, and never names a component. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import discard, store
from textloom.llm.components import components

THRESHOLD = 0.9
BLOCK = 8_192
STRIP = 512  # rows of a tile multiplied at once
PAIRS = 32_768  # pairs recomputed at once
SLACK = 1e-5  # above the rounding of the single-precision scaling
EXACT_DIMENSIONS = (1 << 24) // (127 * 127)


def usable(embedding: Column) -> Column:
    """Whether a vector can link: no null, no non-finite component, not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their whole numbers, steps, and upper bounds of the quantisation error."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / step[:, None]).astype(np.int8)
    rest = unit - whole * step[:, None]
    return unit, whole, step, np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9) + 1e-12


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: sums of up to 1,040 products fit single precision."""
    total = None
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        part = a[:, at : at + EXACT_DIMENSIONS].astype(np.float32) @ b[:, at : at + EXACT_DIMENSIONS].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def tile_links(a: np.ndarray, b: np.ndarray | None, threshold: float):
    """Linked pairs ``(rows of a, rows of b)`` in pieces; without ``b`` the pairs i < j of ``a``."""
    ua, qa, sa, ea = quantise(a)
    ub, qb, sb, eb = (ua, qa, sa, ea) if b is None else quantise(b)
    low = (threshold - SLACK - ea - (1 + ea) * eb.max()) / sa / sb.max()  # no pair below it can link
    if b is None or (low <= 0).any():
        low = np.where(low > 0, low, -np.inf)
    for at in range(0, len(qa), STRIP):
        strip = product(qa[at : at + STRIP], qb)
        i, j = np.nonzero(strip >= low[at : at + STRIP, None])
        value = strip[i, j]
        i += at
        possible = value * sa[i] * sb[j] >= threshold - SLACK - ea[i] - (1 + ea[i]) * eb[j]
        if b is None:
            possible &= i < j
        i, j = i[possible], j[possible]
        for first in range(0, len(i), PAIRS):
            p, q = i[first : first + PAIRS], j[first : first + PAIRS]
            linked = np.einsum("ij,ij->i", ua[p], ub[q]) >= threshold
            yield p[linked], q[linked]


class Forest:
    """Smallest connected row of each row, from links that come in pieces."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _tile(threshold: float) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        rows = rows.sort_by("rep")
        rep, n = rows["rep"].to_numpy(), rows["n"].to_numpy()
        flat = rows["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.astype(np.float64).reshape(len(rep), -1)
        left = np.flatnonzero(rows["block"].to_numpy() == i)
        right = np.flatnonzero(rows["block"].to_numpy() == j)
        linked, forest = np.zeros(len(rep), np.int64), Forest(len(rep))
        if len(left) and len(right):
            for p, q in tile_links(x[left], None if i == j else x[right], threshold):
                p, q = left[p], right[q]
                np.add.at(linked, p, n[q])
                np.add.at(linked, q, n[p])
                forest.join(p, q)
        some = np.flatnonzero(linked)
        return pa.table({"rep": rep[some], "links": linked[some], "root": rep[forest.root[some]]})

    return run


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of the table."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    good = rows.filter(usable(F.col("embedding")))
    # -0.0 and 0.0 group together; classes get a number of their own, the hash breaks ties of null ids
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes, path = store(
        classes.withColumn("dim", F.size("embedding")).withColumn("rep", F.monotonically_increasing_id()), "vectors"
    )
    blocks = math.ceil(classes.count() / block) or 1
    placed = classes.select("rep", "n", "dim", "embedding", F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    tiles = placed.select("*", other).select(
        "rep", "n", "embedding", "dim", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    found, found_path = store(
        tiles.groupBy("dim", "i", "j").applyInArrow(_tile(threshold), "rep long, links long, root long"), "vector-links"
    )
    groups = components(found, "rep", "root").withColumnRenamed("node", "rep")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        classes.select("rep", "least", "n", "embedding")
        .join(counts, "rep", "left")
        .join(groups, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named, _ = store(
        known.join(least, "component").select(
            "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
        ),
        "vector-groups",
    )
    discard(spark, path)
    discard(spark, found_path)
    linked = good.join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
