"""Pages to documents: limits, assembly, length filter, incremental ingest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PAGE_LIMIT = 30
MIN_CHARS = 500

PAGES_PER_BATCH = 1000  # pages handed back at a time

PAGE_SCHEMA = "doc_id {key_type}, page_no int, text string, error string"


def extract_pages(
    df: DataFrame,
    extractor: Callable[[bytes], Iterator[str]],
    page_limit: int = PAGE_LIMIT,
    key: str = "doc_id",
    content: str = "content",
) -> DataFrame:
    """Bytes to page rows with a user-supplied page reader.

    ``extractor(content)`` yields callables or strings, one per page, and is read only up to ``page_limit``.
    A page that raises becomes a row with ``error``; a document that raises becomes one row without page number.
    """
    key_type = df.schema[key].dataType.simpleString()

    def pages_of(doc_id, data):
        try:
            for page_no, page in enumerate(islice(extractor(bytes(data)), page_limit)):
                try:
                    yield doc_id, page_no, page() if callable(page) else page, None
                except Exception as problem:
                    yield doc_id, page_no, None, str(problem)
        except Exception as problem:
            yield doc_id, None, None, str(problem)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = chain.from_iterable(map(pages_of, batch[key], batch[content]))
            while some := list(islice(rows, PAGES_PER_BATCH)):
                out = pd.DataFrame(some, columns=["doc_id", "page_no", "text", "error"])
                out["page_no"] = out["page_no"].astype("Int32")
                yield out

    return df.select(key, content).mapInPandas(read, PAGE_SCHEMA.format(key_type=key_type))


def markup_pages(data: bytes) -> Iterator[str]:
    """Small default reader: UTF-8 markup, one page per paragraph tag."""
    yield from data.decode("utf-8").split("<p>")


def page_limit(pages: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """First ``limit`` pages by number; empty and failing pages count."""
    return pages.filter(F.col("page_no") < limit)


def nonempty_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("text").isNotNull() & (F.col("text") != ""))


def assemble_documents(
    pages: DataFrame, key: str = "doc_id", limit: int | None = PAGE_LIMIT, whole_only: bool = False
) -> DataFrame:
    """Page texts in page order, each followed by a blank line; ``(key, page_no)`` identifies a page.

    The limit bounds what is collected per document; None takes every page. Documents without any text stay, with
    an empty text. With ``whole_only`` a document of which a page failed (``error``) is left out.
    """
    taken = pages if limit is None else page_limit(pages, limit)
    page = F.when(F.col("text") != "", F.struct("page_no", F.concat("text", F.lit("\n\n")).alias("text")))
    ordered = F.sort_array(F.collect_list(page))["text"]
    texts = F.array_join(ordered, "").alias("text")
    if whole_only:
        failed = F.bool_or(F.col("error").isNotNull()).alias("_failed")
        documents = taken.groupBy(key).agg(texts, failed).filter(~F.col("_failed")).drop("_failed")
    else:
        documents = taken.groupBy(key).agg(texts)
    return documents.withColumn("n_chars", F.length("text").cast("bigint"))


def long_enough(minimum: int = MIN_CHARS, length: Column | None = None) -> Column:
    """Document keeps when its code points reach ``minimum``; a stored length lets the scan filter."""
    return (F.length("text") if length is None else length) >= minimum


def min_chars(documents: DataFrame, minimum: int = MIN_CHARS, length_col: str | None = None) -> DataFrame:
    return documents.filter(long_enough(minimum, F.col(length_col) if length_col else None))


def observe_kept(documents: DataFrame, observation: Observation, minimum: int = MIN_CHARS) -> DataFrame:
    """Count found and kept documents while they pass; read ``observation.get`` after an action."""
    kept = long_enough(minimum)
    return documents.observe(observation, F.count(F.lit(1)).alias("found"), F.count_if(kept).alias("kept"))


def rejects(documents: DataFrame, minimum: int = MIN_CHARS) -> DataFrame:
    """Documents that are not kept, with the reason."""
    reason = F.when(F.col("error").isNotNull(), "error").when(
        F.col("text").isNull() | (F.length("text") < minimum), "too short"
    )
    return documents.withColumn("reason", reason).filter("reason is not null")


def skip_done(sources: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sources without an output yet."""
    return sources.join(done.select(key), key, "left_anti")


def processed_union(done: DataFrame, written: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct keys of earlier and new outputs."""
    return done.select(key).unionByName(written.select(key)).distinct()


def incremental_ingest(
    sources: DataFrame, done: DataFrame, minimum: int = MIN_CHARS, key: str = "doc_id", length_col: str | None = None
) -> DataFrame:
    """Earlier outputs plus the newly kept documents, tagged in ``origin``; both tables have the documents' columns.

    The length filter applies to new documents only; whatever was written before counts as processed.
    """
    fresh = min_chars(skip_done(sources, done, key), minimum, length_col)
    return done.withColumn("origin", F.lit("done")).unionByName(fresh.withColumn("origin", F.lit("new")))


def append_new(sources: DataFrame, path: str, minimum: int = MIN_CHARS, key: str = "doc_id") -> DataFrame:
    """Append the kept documents that a Parquet folder does not hold yet, and return the folder's documents.

    Running it again after a success appends nothing. Only keys of the stored documents are read for the join.
    """
    spark = sources.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    fresh = skip_done(sources, spark.read.parquet(path), key) if exists else sources
    min_chars(fresh, minimum).write.mode("append").parquet(path)
    return spark.read.schema(sources.schema).parquet(path)
