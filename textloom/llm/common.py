"""Helpers shared by the operators of this subpackage: batches of text as byte arrays, and hashed words.

Texts are read from Arrow buffers without making a Python string per row, and are worked on in pieces of
about a megabyte, so that memory stays bounded whatever a batch holds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import work_path

PIECE_BYTES = 1 << 20
ARROW_BYTES = 4 << 20
#: A word for size and shingle counts: a run without space or the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(29)


def word_count(text: Column) -> Column:
    """Number of words of a text, counted by the JVM; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bounded_batches(df: DataFrame) -> DataFrame:
    """Have the session hand Python workers batches of about ``ARROW_BYTES``; a batch of rows has no such bound.

    Long texts stand in every table of texts, so this is set for the session where an operator runs, and stays set.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def free_name(df: DataFrame, label: str) -> str:
    """A column name that no column of the table has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{label}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder; returns it as read back, and its path for ``discard``."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str | None) -> None:
    """Delete a stored table that no later step reads."""
    if path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# --- text as bytes ---------------------------------------------------------------------------------------------


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes; a longer text stands alone."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> SHIFT)) * MIX
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """Polynomial hashes modulo 2^64 of spans of a byte array, all at once from running sums.

    Holds the powers of the base and of its inverse; make one per task.
    """

    def __init__(self, most: int = PIECE_BYTES) -> None:
        self.up, self.down = self._powers(most + 1)

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        tables = []
        for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        return tables[0], tables[1]

    def __call__(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        up, down = (self.up, self.down) if len(body) < len(self.up) else self._powers(len(body) + 1)
        running = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[: len(body)], dtype=np.uint64, out=running[1:])
        return scramble((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: 0 separator, 1 letter or digit (every byte of a character beyond ASCII counts as a letter), 2 other.
CLASSES = np.full(256, 2, np.uint8)
CLASSES[: 0x21] = 0
CLASSES[0x7F] = 0
CLASSES[0x80:] = 1
for _c in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
    CLASSES[_c] = 1
#: A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def stretches(body: np.ndarray, begin: int, end: int, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """A range of bytes in stretches of about ``most`` bytes that end outside words."""
    while end - begin > 2 * most:
        at = begin + most
        while at < end:
            gap = np.flatnonzero(CLASSES[body[at : at + most]] != 1)
            if len(gap):
                break
            at += most
        cut = min(at + int(gap[0]), end) if at < end else end
        yield begin, cut
        begin = cut
    yield begin, end


def word_spans(body: np.ndarray, offsets: np.ndarray, punctuation: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts, and the number of words of each text.

    A word is a run of letters and digits; with ``punctuation`` a run of other visible characters is one too.
    """
    kind = CLASSES[body]
    if not punctuation:
        kind = np.where(kind == 1, 1, 0).astype(np.uint8)
    edge = np.ones(len(body) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = (kind[starts] != 0) if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def grams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows inside each text, and the number of windows of each text."""
    per = np.maximum(counts - n + 1, 0)
    if len(words) < n:
        return np.zeros(0, np.uint64), per
    joined = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        joined = joined * BASE + words[k : len(words) - n + 1 + k]
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the end of the text
    return scramble(joined[left[: len(joined)] >= n]), per


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, for tables that its tasks can share; only one name's is kept.

    Operators that need none ask too, so that no worker carries the tables of an earlier operator along.
    """
    stores = sys.modules["__main__"].__dict__.setdefault("_textloom_worker", {})
    for other in stores.keys() - {name}:
        stores.pop(other).clear()
    return stores.setdefault(name, {})
