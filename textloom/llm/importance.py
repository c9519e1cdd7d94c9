"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Two generative models share the buckets of hashed one and two word windows (punctuation runs are words): one is
counted on the target, labelled rows that count as good text, the other on all documents. A document's log weight is
the mean over its windows of the log ratio of the two smoothed models, times a standard length of ``LENGTH`` windows, so
that long documents compete on the same terms; log ratios within ``IGNORED`` of zero count as zero, for a sample's
mix of languages and subjects differs that much by chance, and such differences would add up over a text. Adding standard Gumbel noise to each log
weight and keeping the k largest sums draws k documents without replacement in proportion to their weights.

The raw model is counted over every document: a task sums its windows into one row per bucket before anything is
shuffled, and the driver gets one number per bucket. The target model is fitted on at most ``TARGET_ROWS`` labelled rows in
hash order. The noise comes from a hash of the id and the seed, so reruns agree. The k-th largest sum is found by
counting: bounded histograms of the sums narrow it down, no rows are collected.

k defaults to the number of documents times the share of good rows among all labelled rows.

Results for odd input: null, empty and wordless texts have log weight 0. Repeated rows with one id get equal sums and
stay or go together, so ties at the cut are all kept. A null id gets noise of its own constant. Without labels the share
is one and every document stays. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SpanHasher, bounded_batches, grams, pieces, store, utf8, word_spans

BUCKET_BITS = 18
TARGET_ROWS = 20_000
SMOOTHING = 4.0  # windows added to the target's count of a bucket and to the count the raw model expects there
LENGTH = 200.0  # windows of a document of standard length
IGNORED = 0.35
SEED = 11
BINS = 4_096


def text_buckets(texts: pa.Array, hasher: SpanHasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For pieces of a batch: first and last text, the buckets of all windows, and the windows of each text.

    Windows stand by size, and inside a size by text.
    """
    body, offsets = utf8(pc.ascii_lower(texts))
    for first, last in pieces(offsets):
        at = offsets[first : last + 1]
        part, at = body[at[0] : at[-1]], at - at[0]
        starts, ends, counts = word_spans(part, at, punctuation=True)
        words = hasher(part, starts, ends)
        pairs, per = grams(words, counts, 2)
        bucket = np.concatenate([words, pairs]) >> np.uint64(64 - BUCKET_BITS)
        yield first, last, bucket.astype(np.int64), np.concatenate([counts, per])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, total = SpanHasher(), np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        for _, _, bucket, _ in text_buckets(batch.column(0), hasher):
            total += np.bincount(bucket, minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Windows per bucket over a table with one column of texts; one row per bucket reaches the driver."""
    rows = texts.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << BUCKET_BITS)
    total[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket.

    The raw model says how many of the target's windows to expect in a bucket. Both counts get the same addition, so
    a bucket with little evidence has a ratio near one, whatever the size of the corpus.
    """
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    ratio = np.log((target + SMOOTHING) / (expected + SMOOTHING))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - IGNORED, 0.0)


def weigher(ratio: np.ndarray):
    """Column function ``text -> log weight``, evaluated in Arrow batches."""

    @F.arrow_udf("double")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = SpanHasher()
        for texts in batches:
            out = np.zeros(len(texts))
            for first, last, bucket, per in text_buckets(texts, hasher):
                running = np.append(0, np.cumsum(ratio[bucket]))
                ends = np.cumsum(per)
                sums = running[ends] - running[ends - per]
                n = last - first
                windows = np.maximum(per[:n] + per[n:], 1)
                out[first:last] = (sums[:n] + sums[n:]) / windows * LENGTH
            yield pa.array(out)

    return weigh


def gumbel(doc_id: str, seed: int) -> Column:
    """Standard Gumbel noise that depends on the id and the seed alone."""
    h = F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string"), F.lit(seed)), 11)
    u = (h.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value of a column by narrowing histograms of ``BINS`` bins; k is at least 1."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / BINS
        inside = values.filter(F.col(column).between(low, high))
        bin_of = F.least(F.floor((F.col(column) - low) / width) if width > 0 else F.lit(0), F.lit(BINS - 1))
        bins = (
            inside.groupBy(bin_of.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("b"))
            .collect()  # at most BINS rows
        )
        for row in bins:
            if above + row.n >= k:
                break
            above += row.n
        if (row.low, row.high) == (low, high) and len(bins) == 1:
            break  # nothing lies between the two: one of them is the value
        low, high = row.low, row.high
    if low < high:
        at_top = values.filter(F.col(column) == high).count()
        return high if above + at_top >= k else low
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    label_id: str = "doc_id",
    k: int | None = None,
    target_rows: int = TARGET_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, log_weight, gumbel_key, kept)`` of all documents; ``good`` is a condition on ``labels``."""
    marked = labels.select(F.col(label_id).alias("id"), F.coalesce(good, F.lit(False)).alias("good"))
    n_labels, n_good = marked.agg(F.count(F.lit(1)), F.count_if("good")).first()
    chosen = marked.filter("good").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(target_rows)
    target = docs.join(F.broadcast(chosen), docs[doc_id] == chosen["id"], "left_semi")  # at most target_rows ids
    texts = bounded_batches(docs).select(F.col(text).alias("text"))
    raw_counts = bucket_counts(texts)
    target_counts = bucket_counts(target.select(F.col(text).alias("text"))) if n_good else raw_counts
    weigh = weigher(log_ratio(target_counts, raw_counts))
    scored = docs.select(F.col(doc_id).alias("doc_id"), weigh(F.col(text)).alias("log_weight"))
    scored = scored.withColumn("gumbel_key", F.col("log_weight") + gumbel("doc_id", seed))
    scored, _ = store(scored, "importance")
    if k is None:
        k = round(scored.count() * (n_good / n_labels if n_good else 1.0))
    kept = F.lit(False)
    if k > 0 and not scored.isEmpty():
        kept = F.col("gumbel_key") >= kth_largest(scored, "gumbel_key", k)
    return scored.withColumn("kept", kept)
