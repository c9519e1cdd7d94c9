"""Greedy paragraph packing.

Packing test: ``length(current) + length(paragraph) > limit`` starts a new chunk, so separators do not count
and a long paragraph stays whole. While the current chunk is empty, an empty paragraph vanishes. Empty
chunks are not emitted and chunks never cross documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.ranking import first_n
from textloom.functions.text import paragraphs

CHUNK_LIMIT = 2048
RUN_STARTS = 512


def chunk_starts(parts: Column, separator: str, limit: int) -> Column:
    """1-based index of the paragraph each chunk starts with; a fold over lengths only.

    Starts are gathered in runs of ``RUN_STARTS``, so appending one copies a run and not all starts of a
    long document.
    """
    state = F.struct(
        F.array().cast("array<array<int>>").alias("runs"),
        F.array().cast("array<int>").alias("open"),
        F.lit(0).alias("index"),
        F.lit(0).alias("filled"),
    )

    def step(acc, size):
        index = acc["index"] + 1
        fresh = (acc["filled"] == 0) | (acc["filled"] + size > limit)
        full = fresh & (F.size(acc["open"]) >= RUN_STARTS)
        return F.struct(
            F.when(full, F.array_append(acc["runs"], acc["open"])).otherwise(acc["runs"]).alias("runs"),
            F.when(full, F.array(index))
            .when(fresh, F.array_append(acc["open"], index))
            .otherwise(acc["open"])
            .alias("open"),
            index.alias("index"),
            F.when(fresh, size).otherwise(acc["filled"] + len(separator) + size).alias("filled"),
        )

    sizes = F.transform(parts, lambda p: F.length(p))
    return F.aggregate(sizes, state, step, lambda acc: F.flatten(F.array_append(acc["runs"], acc["open"])))


def _pieces(df: DataFrame, keep: list[str], separator: str, limit: int, text_col: str) -> DataFrame:
    """``keep`` columns and ``_pieces``, the chunks of each row."""
    cut = df.select(*keep, paragraphs(F.col(text_col), separator).alias("_parts")).withColumn(
        "_starts", chunk_starts(F.col("_parts"), separator, limit)
    )
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts") - 1, F.lit(0))), F.array(F.size("_parts") + 1))
    pieces = F.transform(
        F.arrays_zip(F.col("_starts").alias("from"), ends.alias("upto")),
        lambda r: F.array_join(F.slice(F.col("_parts"), r["from"], r["upto"] - r["from"]), separator),
    )
    return cut.select(*keep, F.filter(pieces, lambda c: c != "").alias("_pieces"))


def chunk_paragraphs(
    df: DataFrame, separator: str = "\n\n", limit: int = CHUNK_LIMIT, text_col: str = "text"
) -> DataFrame:
    """One row per chunk: the other columns of ``df``, ``chunk_no`` from 0 and ``text``. Narrow, no shuffle.

    The outer generator keeps the optimizer from testing the pieces before they are a column, which would cut the
    whole text again for every chunk.
    """
    keep = [c for c in df.columns if c != text_col]
    pieces = _pieces(df, keep, separator, limit, text_col)
    return pieces.select(*keep, F.posexplode_outer("_pieces").alias("chunk_no", text_col)).filter("chunk_no is not null")


def chunk_stats(
    documents: DataFrame, *by: str, separator: str = "\n\n", limit: int = CHUNK_LIMIT, text_col: str = "text"
) -> DataFrame:
    """Chunks, characters and chunks per document for each group of documents that yield any.

    Chunks are counted inside the row of their document; only the sums per group are shuffled.
    """
    sizes = _pieces(documents, list(by), separator, limit, text_col).select(
        *by, F.explode(F.array(F.transform("_pieces", lambda c: F.length(c)))).alias("_sizes")  # packed once per row
    )
    per_document = sizes.filter(F.size("_sizes") > 0).select(
        *by,
        F.size("_sizes").cast("bigint").alias("_chunks"),
        F.aggregate("_sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("_chars"),
        F.array_max("_sizes").alias("_longest"),
    )
    return per_document.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("_chunks").alias("chunks"),
        F.sum("_chars").alias("chars"),
        F.max("_longest").cast("bigint").alias("longest_chunk"),
        F.max("_chunks").alias("max_chunks_per_doc"),
        F.round(F.avg("_chunks"), 4).alias("avg_chunks_per_doc"),
    )


def first_chunks(
    documents: DataFrame, n: int = 256, separator: str = "\n\n", limit: int = CHUNK_LIMIT, key: str = "doc_id"
) -> DataFrame:
    """First ``n`` chunks in (document, chunk) order.

    A document with any non-empty paragraph yields at least one chunk, so the first ``n`` such documents hold
    the answer and only those are cut. They are found by key alone, so no text goes through the top-n merge.
    """
    yielding = documents.filter(F.replace(F.col("text"), F.lit(separator), F.lit("")) != "")
    last = first_n(yielding.select(key), [key], n).agg(F.max(key)).scalar()
    return first_n(chunk_paragraphs(yielding.filter(F.col(key) <= last), separator, limit), [key, "chunk_no"], n)
