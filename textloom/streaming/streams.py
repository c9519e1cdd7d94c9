"""Structured Streaming forms: ingest of new files, hardware use per window, current run status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.operators.documents import MIN_CHARS, min_chars


def state_session(spark: SparkSession) -> SparkSession:
    """Session for stateful streams with one state partition per core; the caller's settings stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def timer_session(spark: SparkSession) -> SparkSession:
    """A state session for streams with timers: their state store, and times that mean the same to Python and Spark."""
    session = state_session(spark)
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    session.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path names a folder; a file stream lists folders, and takes one file by its folder and name only."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(named).isDirectory()


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files of a folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is there now to Parquet, each input file once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )


def stream_ingest(stream: DataFrame, output: str, checkpoint: str, minimum: int = MIN_CHARS) -> StreamingQuery:
    """Keep long enough documents of files that were not read before."""
    return run_available(min_chars(stream, minimum), output, checkpoint)


def ingest_once(
    stream: DataFrame, output: str, checkpoint: str, minimum: int = MIN_CHARS, arrived: str = "arrived", delay: str = "7 days", text: str = "text"
) -> StreamingQuery:
    """Keep long enough documents whose text has not come before, in any file and across restarts.

    Of equal texts one row is kept, with ``digest``. ``arrived`` is the time of a row; a text is remembered until the watermark,
    the newest time less ``delay``, has passed its first row by ``delay``, so the state holds digests of that span only. Rows not
    after the watermark, which begins at 1970, are late and left out. Times of files can be late; ``current_timestamp()`` is only
    if the clock goes back by ``delay``.
    """
    kept = min_chars(stream, minimum).withColumn("digest", F.md5(text)).withWatermark(arrived, delay)
    return run_available(kept.dropDuplicatesWithinWatermark(["digest"]), output, checkpoint)


def windowed_usage(samples: DataFrame, window: str, delay: str, *by: str) -> DataFrame:
    """Peak and mean of ``used`` per tumbling window of ``ts``; rows behind the watermark are dropped."""
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", window), *by)
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.max("used").alias("peak_used"),
            F.avg("used").alias("mean_used"),
            F.max("ts").alias("newest"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "samples",
                "peak_used", "mean_used", "newest")
    )


def stream_usage(
    samples: DataFrame, output: str, checkpoint: str, window: str = "1 hour", delay: str = "10 minutes", by: str = "device"
) -> StreamingQuery:
    """Windows as they change, open ones included; :func:`current_usage` reads the newest state of each."""
    return keep_current(windowed_usage(samples, window, delay, by), ["window_start", "window_end", by], output, checkpoint)


def current_usage(spark: SparkSession, output: str, delay: str = "10 minutes", by: str = "device") -> DataFrame:
    """Each window as its newest trigger left it, and whether the watermark has closed it."""
    stored = current_table(spark, output)
    mark = stored.agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).scalar()
    closed = F.col("window_end") <= F.date_trunc("MILLISECOND", mark)
    return stored.select("window_start", "window_end", by, "samples", "peak_used", "mean_used", closed.alias("closed"))


def latest_per_run(events: DataFrame, order: Column, *fields: str) -> DataFrame:
    """Newest row of each run and the number of rows so far."""
    newest = F.max(F.struct(order.alias("_order"), *fields))
    return events.groupBy("run").agg(F.count(F.lit(1)).alias("events"), newest.alias("_newest")).select(
        "run", "events", *[F.col("_newest")[f].alias(f) for f in fields]
    )


def _versions(spark: SparkSession, output: str) -> list[int]:
    """Numbers of the complete versions of a table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(output)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [(f.getPath(), f.getPath().getName()) for f in system.listStatus(folder)]
    done = [n for p, n in names if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done if n.startswith("version="))


def keep_current(changed: DataFrame, keys: list[str], output: str, checkpoint: str) -> StreamingQuery:
    """Keep a table current: each trigger writes it anew with the rows that changed.

    The table has one row per key, whatever the number of triggers. The version before stays until the next one is
    complete, so a repeated batch starts from it again; older ones are deleted.
    """

    def store(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = [v for v in _versions(spark, output) if v < batch_id]
        table = rows
        if before:
            kept = spark.read.schema(rows.schema).parquet(f"{output}/version={before[-1]}")
            table = rows.unionByName(kept.join(rows.select(*keys), keys, "left_anti"))
        table.write.mode("overwrite").parquet(f"{output}/version={batch_id}")
        for old in before[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{output}/version={old}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return (
        changed.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_table(spark: SparkSession, output: str) -> DataFrame:
    """The newest complete version of a table that is kept current."""
    return spark.read.parquet(f"{output}/version={_versions(spark, output)[-1]}")


def stream_status(latest: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest row of each run."""
    return keep_current(latest, ["run"], output, checkpoint)


def current_status(spark: SparkSession, output: str) -> DataFrame:
    """The status table."""
    return current_table(spark, output)


def finish(query: StreamingQuery, then: Callable[[], DataFrame]) -> DataFrame:
    """Wait for the available input and return what was stored."""
    query.awaitTermination()
    return then()
