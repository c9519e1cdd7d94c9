"""Loading of the driver tables and the views the registered queries derive from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.numbers import grad_accum
from textloom.functions.records import classify_error
from textloom.functions.times import duration_text, log_stamp
from textloom.session import spread
from textloom.sources.runs import stats_text


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as pages of a document: ``(doc_id, page_no, text)``."""
    turns = load(spark, sf_dir, "conversations")
    return turns.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("page_no"), "text")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source file per document: ``(doc_id, path, length)``; the language is the extension."""
    docs = load(spark, sf_dir, "documents")
    path = F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/doc_"), F.col("doc_id"), F.lit("."), F.col("lang"))
    return docs.select("doc_id", path.alias("path"), F.col("n_chars").alias("length"))


def user_run() -> Column:
    return F.concat(F.lit("run_"), F.col("user_id").cast("string"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as log lines ``(run, line_no, line)``, one run per user; every event kind of the grammar occurs.

    An event is one line or two. Device lines and arguments stand on a second line without a time; a safe
    size that works is reported twice, as some logs do.
    """
    number, value = F.col("event_id").cast("string"), F.col("value")
    size, text = (F.col("event_id") % 64 + 1).cast("string"), value.cast("string")
    path = F.concat(F.lit("/in/my doc "), number, F.lit(".src"))

    def said(*pieces) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    head = said(log_stamp(F.col("ts")), " - INFO - ")
    device = said("GPU Memory Usage: GPU ", (F.col("user_id") % 8).cast("string"), ": ", text, "MB/512.0MB (0.0%)")
    misfit = F.when(value < 120, said("OOM error at batch size ", size)).otherwise(
        said("Error at batch size ", size, ": ", F.col("props"))
    )
    others = [
        F.array(said(head, "Train dataset size: ", number, " samples")),
        F.array(said(head, "Eval dataset size: ", number, " samples")),
        F.array(said(head, "Training on ", number, " files, testing on ", size, " files")),
        F.array(said(head, "Initial search range: ", size, " to ", number)),
        F.array(said(head, "Testing a safe batch size of ", size, " first")),
        F.array(said(head, "Safe batch size ", size, " works! Going on..."), said(head, "Batch size ", size, " works!")),
        F.array(said(head, "Loading tokenized datasets from cache")),
        F.array(said(head, "Cache not found, making it")),
        F.array(said(head, "Final evaluation metrics: {'eval_loss': ", text, ", 'epoch': 1.0}")),
        F.array(said(head, "Training complete in ", duration_text(value), "!")),
        F.array(said(head, "Error on page ", size, " of ", path, ": bad")),
        F.array(said(head, "Arguments:"), said("  seed: ", number)),
        F.array(said(head, "Found ", number, " source files")),
        F.array(said(head, "Successfully processed ", path)),
        F.array(said(head, "Extracted text too short for ", path)),
        F.array(said(head, "Error processing ", path, ": worse")),
        F.array(said(head, "Even safe batch size ", size, " fails")),
        F.array(said(head, "Maximum batch size: ", size)),
        F.array(said(head, "Gradient accumulation steps: ", size)),
        F.array(said(head, "Final perplexity: ", text)),
    ]
    other = others[-1]
    for i, lines in enumerate(others[:-1]):
        other = F.when(F.col("event_id") % len(others) == i, lines).otherwise(other)
    progress = (
        F.when(value < 40, F.array(said(head, "Batch size ", size, " works!")))
        .when(value < 80, F.array(said(head, "Maximum batch size found: ", size)))
        .when(value < 120, F.array(said(head, "Epoch ", (F.col("event_id") % 3 + 1).cast("string"), "/3")))
        .when(value < 160, F.array(said(head, "Step ", (F.col("event_id") % 6 + 1).cast("string"), ": next stage ", size)))
        .otherwise(other)
    )
    kind = F.col("event_type")
    lines = (
        F.when(kind == "view", F.array(head, device))
        .when(kind == "click", F.array(said(head, "RAM Usage: ", text, "GB/1082.0GB (0.0%)")))
        .when(kind == "purchase", F.array(said(head, "Trying batch size: ", size, " with gradient accumulation steps: 1")))
        .when(kind == "error", F.array(said(head, misfit)))
        .otherwise(progress)
    )
    return (
        spread(load(spark, sf_dir, "events"), "event_id")
        .select(user_run().alias("run"), "event_id", F.posexplode(lines).alias("_part", "line"))
        .select("run", (F.col("event_id") * 2 + F.col("_part")).alias("line_no"), "line")
    )


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics texts ``(run, body)``, one run per user."""
    facts = (
        load(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.round(1 + F.avg("value"), 2).alias("perplexity"),
            (F.count(F.lit(1)) * 60).alias("seconds"),
            F.max("ts").alias("completed_at"),
        )
    )
    batch = (F.col("user_id") % 32 + 1).cast("int")
    args = F.create_map(
        F.lit("seed"), F.lit("42"), F.lit("user"), F.col("user_id").cast("string"), F.lit("tags"), F.lit("a: b,c")
    )
    body = stats_text(
        F.col("completed_at"), batch, grad_accum(batch), F.col("perplexity"), F.col("seconds"), args
    )
    return facts.select(user_run().alias("run"), body.alias("body"))


def run_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, has_pid, has_stats, last_ts)`` per user, from its first and last value."""
    return (
        load(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            (F.min_by("value", "event_id") > 10).alias("has_pid"),
            (F.max_by("value", "event_id") > 30).alias("has_stats"),
            F.max("ts").alias("last_ts"),
        )
        .select(user_run().alias("run"), "has_pid", "has_stats", "last_ts")
    )


def batch_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run, seq, ts, batch_size, message, result)``: every event as a batch-size trial of its user."""
    message = F.when(F.col("value") >= 120, "device lost").when(
        F.col("value") >= 40, "CUDA out of memory. Tried to allocate"
    )
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("seq"),
        "ts",
        (F.col("event_id") % 64 + 1).cast("int").alias("batch_size"),
        message.alias("message"),
        classify_error(message).alias("result"),
    )
