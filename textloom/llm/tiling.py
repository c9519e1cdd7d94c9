"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits. Seeds are hashed windows of ``MIN_TILE`` words (of a shorter item:
all its words), so every tile holds a seed. The seeds of the benchmark fill a Bloom filter of a fixed number of bits,
which every task has. A document whose words under seeds of the filter could cover the shortest item goes on, with
those seeds, to an equi-join with the benchmark's seeds; a pair is a candidate when the words of the item under shared
seeds reach the coverage asked for. All tiles lie under shared seeds, so neither bound loses a leak.
Each candidate pair of text and item is then tiled: Karp-Rabin windows find where runs of words of the item occur
in the text, and the longest match is marked again and again, words marked once each, until none of ``MIN_TILE``
words is left. The share of the item's words under tiles is the coverage; from ``COVERAGE`` on, the item has
leaked, whatever the order its parts stand in.

The filter has a fixed size, so nothing that is sent to all tasks grows; when it fills, more documents pass it and
the join decides, with equal results. Texts are shuffled only for candidate pairs, once for all copies of a text.

Results for odd input: null, empty and wordless texts and items match nothing. Repeated items and repeated texts give
the same coverage; the result has one row per document id and item id, with the highest coverage. A null document
id is reported as null. Long texts are read whole. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SpanHasher, bounded_batches, free_name, grams, pieces, store, utf8, word_spans

MIN_TILE = 3
COVERAGE = 0.8
FILTER_BITS = 24  # 2^24 bits, 2 MB
PROBES = 3
WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


# --- tiling of one pair ----------------------------------------------------------------------------------------


def words_of(text: bytes) -> list[bytes]:
    return WORDS.findall(text)


def matches(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``least`` words as (length, place in item, place in text).

    A rolling hash of each window of the text is looked up among the item's windows; words decide.
    """
    if len(item) < least or len(text) < least:
        return []
    base = np.uint64(0x9E3779B97F4A7C15)

    def rolling(x: np.ndarray) -> np.ndarray:
        h = np.zeros(len(x) - least + 1, np.uint64)
        for k in range(least):
            h = h * base + x[k : len(x) - least + 1 + k].astype(np.uint64)
        return h

    windows: dict[int, list[int]] = {}
    for i, h in enumerate(rolling(item).tolist()):
        windows.setdefault(h, []).append(i)
    known = np.flatnonzero(text >= 0)
    if not len(known):
        return []
    hashes = rolling(text)
    places = np.flatnonzero(np.isin(hashes, np.fromiter(windows, np.uint64, len(windows))))
    found, reached = [], {}
    for j in places.tolist():
        for i in windows[int(hashes[j])]:
            if reached.get(j - i, -1) > j:
                continue  # inside a run of this diagonal that is known
            n = 0
            while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]:
                n += 1
            if n >= least:
                reached[j - i] = j + n
                found.append((n, i, j))
    return found


def coverage(item: list[bytes], text: list[bytes], least: int = MIN_TILE) -> float:
    """Share of the item's words that greedy tiles cover in the text."""
    if not item:
        return 0.0
    least = min(least, len(item))
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    a = np.array([number[w] for w in item])
    b = np.array([number.get(w, -1) for w in text])
    heap = [(-n, i, j) for n, i, j in matches(a, b, least)]
    heapq.heapify(heap)
    in_item, in_text, covered = np.zeros(len(a), bool), np.zeros(len(b), bool), 0
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        taken = in_item[i : i + n] | in_text[j : j + n]
        if not taken.any():
            in_item[i : i + n] = in_text[j : j + n] = True
            covered += n
            continue
        free = np.flatnonzero(np.diff(np.concatenate([[0], ~taken, [0]]).astype(np.int8)))
        for start, end in zip(free[::2].tolist(), free[1::2].tolist()):
            if end - start >= least:
                heapq.heappush(heap, (start - end, i + start, j + start))
    return covered / len(a)


# --- candidates ------------------------------------------------------------------------------------------------


def text_seeds(
    texts: pa.Array, lengths: list[int], hasher: SpanHasher
) -> Iterator[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For each piece of a batch and each length: seeds, the text of each seed, and its place among the text's words."""
    body, offsets = utf8(pc.utf8_lower(texts))
    for first, last in pieces(offsets):
        at = offsets[first : last + 1]
        part, at = body[at[0] : at[-1]], at - at[0]
        starts, ends, counts = word_spans(part, at, punctuation=False)
        words = hasher(part, starts, ends)
        found = []
        for n in lengths:
            h, per = grams(words, counts, n)
            places = np.arange(len(h)) - np.repeat(np.cumsum(per) - per, per)
            found.append((h ^ np.uint64(n), np.repeat(np.arange(first, last), per), places))
        yield found


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        lower = pc.utf8_lower(batch.column(1))
        sizes = np.array([len(words_of(t.encode())) if t else 0 for t in lower.to_pylist()])
        for n in range(1, MIN_TILE + 1):
            own = np.flatnonzero(sizes == n if n < MIN_TILE else sizes >= n)
            if len(own):
                for [(seeds, rows, places)] in text_seeds(lower.take(pa.array(own)), [n], hasher):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(own[rows])),
                            pa.array(seeds.view(np.int64)),
                            pa.array(places.astype(np.int32)),
                            pa.array(np.full(len(seeds), n, np.int32)),
                            pa.array(sizes[own[rows]].astype(np.int32)),
                        ],
                        names=["item_key", "seed", "place", "n", "words"],
                    )


def probes(seeds: np.ndarray) -> np.ndarray:
    """Places of seeds in the filter, one row per probe."""
    shifts = np.array([0, 19, 40], np.uint64)[:PROBES, None]
    return (seeds[None] >> shifts) & np.uint64((1 << FILTER_BITS) - 1)


def seed_filter(seeds: DataFrame) -> bytes:
    """Bloom filter of the benchmark's seeds: at most 2^18 words of 64 bits reach the driver."""
    mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
    places = F.array(*[F.shiftrightunsigned("seed", s).bitwiseAND(mask) for s in (0, 19, 40)[:PROBES]])
    words = (
        seeds.select(F.explode(places).alias("p"))
        .select(F.floor(F.col("p") / 64).alias("w"), F.expr("shiftleft(1L, int(p % 64))").alias("bit"))
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[words["w"].to_numpy()] = words["bits"].to_numpy()
    return table.tobytes()


def least_words(words: int, least: float) -> int:
    """Words of an item of ``words`` words that tiles must cover for a coverage of ``least``."""
    return next((c for c in range(1, words + 1) if c / words >= least), words + 1)


def _suspects(bits: bytes, needed: dict[int, int]):
    """Texts with those seeds of the filter under which at least ``needed[length of the seed]`` of their words lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint64)
        hasher = SpanHasher()
        for batch in batches:
            for found in text_seeds(batch.column(1), list(needed), hasher):
                kept_seeds, kept_rows = [], []
                for (n, need), (seeds, rows, at) in zip(needed.items(), found):
                    hit = np.ones(len(seeds), bool)
                    for place in probes(seeds):
                        left = np.flatnonzero(hit)
                        word = table[(place[left] >> np.uint64(6)).astype(np.int64)]
                        hit[left] = (word >> (place[left] & np.uint64(63)) & np.uint64(1)).astype(bool)
                    seeds, rows, at = seeds[hit], rows[hit], at[hit]
                    if len(rows):
                        fresh = np.full(len(rows), n)  # words that the seed before does not hold
                        fresh[1:] = np.where(rows[1:] == rows[:-1], np.minimum(n, np.diff(at)), n)
                        enough = np.bincount(rows, fresh)[rows] >= need
                        kept_seeds.append(seeds[enough])
                        kept_rows.append(rows[enough])
                seeds = np.concatenate(kept_seeds) if kept_seeds else np.zeros(0, np.uint64)
                rows = np.concatenate(kept_rows) if kept_rows else np.zeros(0, np.int64)
                if len(rows):
                    own = np.unique(rows)  # rows of one text need not be together
                    order = np.argsort(rows, kind="stable")
                    counts = np.bincount(rows)[own]
                    lists = pa.ListArray.from_arrays(
                        np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(seeds[order].view(np.int64))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), lists],
                        names=["doc_id", "text", "seeds"],
                    )

    return run


def candidates(suspects: DataFrame, seeds: DataFrame, least: float) -> DataFrame:
    """``(key, item_key)`` where the item's words under shared seeds reach ``least`` of its words.

    Not more than an item's own places are collected for a pair.
    """
    shared = (
        suspects.select("key", F.explode("seeds").alias("seed"))
        .distinct()
        .join(seeds, "seed")
        .groupBy("key", "item_key", "n", "words")
        .agg(F.array_sort(F.collect_set("place")).alias("places"))
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda done, at: F.struct(
            (done["words"] + at + F.col("n") - F.greatest(done["end"], at)).alias("words"),
            (at + F.col("n")).alias("end"),
        ),
        lambda done: done["words"],
    )
    return shared.filter(covered / F.col("words") >= least).select("key", "item_key")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.utf8_lower(batch.column(2)).to_pylist()
        items = pc.utf8_lower(batch.column(3)).to_pylist()
        share = [coverage(words_of(i.encode()), words_of(t.encode())) for i, t in zip(items, texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(share, pa.float64())], names=["key", "item_id", "coverage"]
        )


def leaked_texts(
    docs: DataFrame, benchmark: DataFrame, text: str, doc_id: str, item_text: str, item_id: str, least: float
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, key)`` of suspect documents, and ``(key, item_id, coverage)`` of leaks; the key stands for a text."""
    items = bounded_batches(benchmark).select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item"))
    items = items.filter(F.col("item").isNotNull()).withColumn("item_key", F.md5("item")).distinct()
    seeds, _ = store(
        items.select("item_key", "item")
        .distinct()
        .mapInArrow(_item_seeds, "item_key string, seed long, place int, n int, words int"),
        "seeds",
    )
    shortest = seeds.groupBy("n").agg(F.min("words").alias("words")).collect()  # at most MIN_TILE rows
    needed = {r.n: least_words(r.words, least) for r in shortest}
    bits = seed_filter(seeds)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = texts.withColumn("seeds", F.array(F.lit(0).cast("long"))).schema
    suspects, _ = store(
        texts.mapInArrow(_suspects(bits, needed), schema).withColumn("key", F.md5("text")), "suspects"
    )
    pairs, _ = store(candidates(suspects, seeds, least), "candidates")
    texts = suspects.join(pairs.select("key").distinct(), "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))
    scored = (
        pairs.join(items, "item_key")
        .join(texts, "key")
        .select("key", "item_id", "text", "item")
        .mapInArrow(_score, items.select(F.lit("").alias("key"), "item_id", F.lit(0.0).alias("coverage")).schema)
    )
    return suspects.select("doc_id", "key"), scored.filter(F.col("coverage") >= least)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    least: float = COVERAGE,
) -> DataFrame:
    """``(doc_id, item_id, coverage)`` of every document that holds a benchmark item."""
    named, found = leaked_texts(docs, benchmark, text, doc_id, item_text, item_id, least)
    return named.join(found, "key").groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"))


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = COVERAGE
) -> DataFrame:
    """The documents whose text holds no benchmark item, with all their columns."""
    _, found = leaked_texts(docs, benchmark, text, doc_id, "text", "item_id", least)
    key = free_name(docs, "key")
    bad, _ = store(found.select(F.col("key").alias(key)).distinct(), "leaked")
    marked = docs.withColumn(key, F.md5(F.col(text)))
    return marked.join(bad, key, "left_anti").select(*docs.columns)
