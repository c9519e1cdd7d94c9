"""Near copies by SimHash, found with Golay-code fuzzy hashing.

A fingerprint is the 64 majority bits of the XXH64 values (seed 42) of a text's four-word shingles. Two
fingerprints link when at most four bits differ.

Candidates: the 64 bits are cut into three segments of 22, 21 and 21 bits, each read as a word of 23 bits and
decoded with the binary Golay code. The code is perfect with radius 3, so every word has one codeword within
3 bits; a word at distance 3 has exactly five more at distance 4. The indices (12 bits) of these one or six
codewords are the keys of the segment. Two words that differ in at most two bits always share a key: relative
to the codeword of the first word, the second one has weight 4 or less, or it has weight 5 around a word of
weight 3, and then a codeword of weight 7 through the three bits and one of the two others is within 4 of both.
Of four errors in three segments at most one segment can hold three or more, so two segments hold at most two
each: the pair of their keys (24 bits) is shared. Each fingerprint therefore emits its key pairs for the three
pairs of segments, an equi-join brings all linked fingerprints together, and the exact distance verifies them.

Scale: equal fingerprints are one row before any key is made. Before the full join every fingerprint is
compared with the smallest one of each of its buckets, and the components of these links are found; the join
then lets through only links between different components. A group of very many near copies thus yields about
one link per member and key, not all pairs. The joins are plain equi-joins whose hot keys adaptive execution splits;
keys and groups are merged, never broadcast: the size Spark expects of them says little of their number.

Results for odd input: null, empty and blank texts have fingerprint zero and link with each other. A null id
takes part with its text but never names a component; its component is null when its group has no id at all.
Repeated rows give repeated result rows. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import bounded_batches, discard, free_name, store, utf8, worker_store
from textloom.llm.components import components

MAX_BITS = 4
SHINGLE = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LANES = np.uint64(0x0101010101010101)


# --- fingerprints ----------------------------------------------------------------------------------------------


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the values; byte lanes are summed eight bits at a time."""
    counts = np.zeros((8, 8), np.int64)  # bit in byte, byte
    for first in range(0, len(hashes), 255):  # a lane holds up to 255
        part = hashes[first : first + 255]
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & LANES).sum(dtype=np.uint64)
            counts[bit] += np.frombuffer(np.uint64(lanes).tobytes(), np.uint8)
    bits = counts * 2 > len(hashes)
    return sum(1 << (8 * byte + bit) for bit in range(8) for byte in range(8) if bits[bit, byte])


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text; ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and the six blanks."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    values = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())]
    return majority(np.array(values, np.uint64))


@F.arrow_udf(T.LongType())
def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Fingerprint of each text as a signed long."""
    worker_store("simhash")
    for texts in batches:
        body, offsets = utf8(texts)
        values = [fingerprint(body[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp, digest)``, one row per row of the table; the digest stands for the text."""
    return bounded_batches(docs).select(
        F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"), _digest(text).alias("digest")
    )


def _digest(text: str) -> Column:
    return F.coalesce(F.md5(F.col(text)), F.lit(""))


# --- keys ------------------------------------------------------------------------------------------------------


def syndrome(word: int) -> int:
    """Remainder of a 23-bit word modulo the generator."""
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def decoding_table() -> np.ndarray:
    """For each syndrome the error patterns of weight up to 4, one of up to 3 first; -1 where there is none."""
    single = [syndrome(1 << bit) for bit in range(23)]
    table = np.full((2048, 6), -1, np.int32)
    used = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s, pattern = 0, 0
            for bit in bits:
                s, pattern = s ^ single[bit], pattern | 1 << bit
            table[s, used[s]] = pattern
            used[s] += 1
    return table


def syndromes(words: np.ndarray) -> np.ndarray:
    """Syndromes of many words: the code is linear, so the bits add up."""
    out = np.zeros(len(words), np.int32)
    for bit in range(23):
        out ^= np.where(words >> np.uint64(bit) & np.uint64(1), np.int32(syndrome(1 << bit)), np.int32(0))
    return out


def segment_keys(fp: np.ndarray, table: np.ndarray) -> list[np.ndarray]:
    """Per segment the codeword indices of each fingerprint, six columns, -1 where there is none."""
    out = []
    for shift, width in SEGMENTS:
        word = fp >> np.uint64(shift) & np.uint64((1 << width) - 1)
        error = table[syndromes(word)]
        codeword = word.astype(np.int32)[:, None] ^ error
        out.append(np.where(error < 0, -1, codeword >> 11))
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(fp, c)`` to ``(fp, c, key)``, a row per key pair."""
    table = decoding_table()
    for batch in batches:
        fps, groups = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for first in range(0, len(fps), 2_000):
            fp, c = fps[first : first + 2_000], groups[first : first + 2_000]
            parts = segment_keys(fp.view(np.uint64), table)
            for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
                a, b = parts[i][:, :, None], parts[j][:, None, :]
                key = (pair << 24 | a.astype(np.int64) << 12 | b).reshape(len(fp), 36)
                row, col = np.nonzero(((a >= 0) & (b >= 0)).reshape(len(fp), 36))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[row]), pa.array(c[row]), pa.array(key[row, col])], names=["fp", "c", "key"]
                )


def _near() -> Column:
    return F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= MAX_BITS


def _keyed(nodes: DataFrame) -> DataFrame:
    """``(fp, c, key)``; fingerprints are dealt to a set number of tasks, for their keys are seventy times their bytes.

    Spark takes the keys for as many rows as there are fingerprints, so joins are told to merge, never to broadcast.
    """
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(tasks, "fp").mapInArrow(_keys, "fp long, c long, key long").hint("merge")


def links(nodes: DataFrame) -> tuple[DataFrame, list[str]]:
    """Links ``(a, b)`` between distinct fingerprints that connect all that is connected.

    ``nodes`` has one column ``fp`` without repeats. Also returned: stored tables to discard after use.
    """
    keyed = _keyed(nodes.select("fp", F.col("fp").alias("c")))
    first = keyed.groupBy("key").agg(F.min("fp").alias("fp"))
    stars = keyed.alias("x").join(first.alias("y"), "key").filter((F.col("x.fp") != F.col("y.fp")) & _near())
    stars, stars_path = store(stars.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct(), "stars")
    groups, groups_path = store(components(stars, "a", "b"), "star-groups")
    placed = nodes.join(groups.hint("merge"), nodes["fp"] == groups["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("c")
    )
    keyed = _keyed(placed)
    apart = keyed.alias("x").join(keyed.alias("y"), "key").filter((F.col("x.c") < F.col("y.c")) & _near())
    apart = apart.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return stars.unionByName(apart), [stars_path, groups_path]


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of the table."""
    return _grouped(docs, text, doc_id).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``(doc_id, fp, digest, c, component_id)``; groups that share their smallest id differ in ``c``."""
    spark = docs.sparkSession
    rows, _ = store(fingerprints(docs, text, doc_id), "simhash")
    nodes, nodes_path = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    found, paths = links(nodes.select("fp"))
    of = components(found, "a", "b").withColumnRenamed("node", "fp")
    for path in paths:
        discard(spark, path)
    placed = nodes.join(of, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    least = placed.groupBy("c").agg(F.min("least").alias("component_id"))
    named, _ = store(placed.join(least, "c").select("fp", "c", "component_id"), "simhash-groups")
    discard(spark, nodes_path)
    return rows.join(named, "fp").select("doc_id", "fp", "digest", "c", "component_id")


def first_of_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that name their group: one of each group of near copies, with all columns.

    Where rows of a group share the id that names it, the one with the least fingerprint and digest of its text
    stays. Rows without an id cannot be named and stay.
    """
    named = _grouped(docs, text, doc_id).filter(F.col("doc_id") == F.col("component_id"))
    named = named.groupBy("c", "doc_id").agg(F.min(F.struct("fp", "digest")).alias("first"))
    key, own, kept_own, turn = (free_name(docs, n) for n in ("key", "digest", "kept_digest", "turn"))
    kept = named.select(F.col("doc_id").alias(key), F.col("first.digest").alias(kept_own))
    marked = docs.withColumn(own, _digest(text))
    chosen = marked.join(kept, (marked[doc_id] == kept[key]) & (marked[own] == kept[kept_own]), "inner")
    # the join has sorted by id and digest already; only repeats of a row's id and text meet in the window
    one = chosen.withColumn(turn, F.row_number().over(Window.partitionBy(key, kept_own).orderBy(F.col(text)))).filter(
        F.col(turn) == 1
    )
    return one.select(*docs.columns).unionByName(docs.filter(F.col(doc_id).isNull()))
