"""Run logs and run statistics files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.records import kv_arguments, kv_field
from textloom.functions.times import duration_text, stamp
from textloom.sources.files import plain_path

# Names of a run's statistics and process files, and the keys of its statistics.
STATS_FILE = "training_stats.txt"
PID_FILE = "process_pid.txt"
COMPLETED, BATCH, ACCUM, EFFECTIVE, PERPLEXITY, TIME = (
    "Training completed at",
    "Maximum batch size",
    "Gradient accumulation steps",
    "Effective batch size",
    "Final perplexity",
    "Total training time",
)


def read_logs(spark: SparkSession, folder: str, pattern: str = "*.log") -> DataFrame:
    """Log lines ``(path, file_name, line_no, line)`` of the matching files, lines numbered from 1 per file.

    A log of any size is read in blocks. Lines are numbered inside their block and shifted by the line
    counts of the earlier blocks, so no file is pulled into one row.
    """
    raw = (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder)
        .select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            plain_path(F.col("_metadata.file_name")).alias("file_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
            F.col("value").alias("line"),
        )
    )
    blocks = raw.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select("path", "_block", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("path", "_block").orderBy("_seq"))
    return (
        raw.withColumn("_place", place)
        .join(shifts, ["path", "_block"])
        .select("path", "file_name", (F.col("_shift") + F.col("_place")).alias("line_no"), "line")
    )


def run_of_log(file_name: Column) -> Column:
    """Run name of a ``<run>_gpu<k>.log`` file."""
    return F.regexp_extract(file_name, "^(.*)_gpu[^/]*\\.log$", 1)


def match_logs(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """First log (by path) of each run; ``logs`` has ``(path, file_name)``.

    A name may contain the marker more than once, so every prefix before a marker is a candidate run name
    and the match stays an equi-join.
    """
    parts = F.split(F.regexp_extract("file_name", "^(.*)\\.log$", 1), "_gpu", -1)
    pieces = logs.select("path", parts.alias("_parts")).filter(F.size("_parts") > 1)
    candidates = pieces.select(
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("_parts") - 1), lambda i: F.array_join(F.slice("_parts", 1, i), "_gpu")
            )
        ).alias("run"),
    )
    first = candidates.groupBy("run").agg(F.min("path").alias("log_path"))
    return runs.join(first, "run", "left")


def read_run_stats(spark: SparkSession, root: str, file_name: str = STATS_FILE) -> DataFrame:
    """Statistics of every run directory of ``root`` that has them, parsed; the directory names the run.

    Runs without a file give no row, and a root without any gives an empty table.
    """
    reader = spark.read.option("pathGlobFilter", file_name).option("recursiveFileLookup", "true")
    parts = F.split(plain_path(F.col("_metadata.file_path")), "/")
    bodies = reader.text(root, wholetext=True).select(
        F.element_at(parts, -2).alias("run"), F.element_at(parts, -3).alias("_root"), F.col("value").alias("body")
    )
    return parse_run_stats(bodies.filter(F.col("_root") == root.rstrip("/").rsplit("/", 1)[-1]))


def owned_markers(spark: SparkSession, root: str, pid_file: str = PID_FILE, stats_file: str = STATS_FILE) -> DataFrame:
    """``(run, has_pid, has_stats)`` of the run directories with a process or a statistics file; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    parts = F.split("path", "/")
    files = reader.load(root).select(F.element_at(parts, -2).alias("run"), F.element_at(parts, -1).alias("_file"))
    marks = files.groupBy("run").agg(
        F.bool_or(F.col("_file") == pid_file).alias("has_pid"), F.bool_or(F.col("_file") == stats_file).alias("has_stats")
    )
    return marks.filter("has_pid or has_stats")


def parse_run_stats(bodies: DataFrame) -> DataFrame:
    """``(run, body)`` to typed columns and the argument map; missing or malformed fields are null."""

    def field(key: str, kind: str) -> Column:
        return kv_field(F.col("body"), key).try_cast(kind)

    return bodies.select(
        "run",
        field(COMPLETED, "timestamp_ntz").alias("completed_at"),
        field(BATCH, "int").alias("batch_size"),
        field(ACCUM, "int").alias("grad_accum"),
        field(EFFECTIVE, "int").alias("effective_batch"),
        field(PERPLEXITY, "double").alias("perplexity"),
        kv_field(F.col("body"), TIME).alias("training_time"),
        kv_arguments(F.col("body")).alias("args"),
    )


def argument_lines(args: Column) -> Column:
    entries = F.sort_array(F.map_entries(args))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), e["value"])), "\n"
    )


def stats_text(
    completed_at: Column, batch: Column, accum: Column, perplexity: Column, seconds: Column, args: Column
) -> Column:
    """Statistics of a run as the ``key: value`` text that :func:`parse_run_stats` reads."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit(COMPLETED + ": "), stamp(completed_at)),
        F.concat(F.lit(BATCH + ": "), batch.cast("string")),
        F.concat(F.lit(ACCUM + ": "), accum.cast("string")),
        F.concat(F.lit(EFFECTIVE + ": "), (batch * accum).cast("string")),
        F.concat(F.lit(PERPLEXITY + ": "), F.format_string("%.2f", perplexity)),
        F.concat(F.lit(TIME + ": "), duration_text(seconds)),
        F.lit(""),
        F.lit("Arguments:"),
        argument_lines(args),
    )


def write_run_stats(stats: DataFrame, path: str, mode: str = "append") -> None:
    """Parsed statistics as Parquet rows: typed facts and the map of arguments of each run."""
    stats.write.mode(mode).parquet(path)


def summary_text() -> Column:
    """Report section of a parsed run: one ``name = value`` line per known fact, then its arguments."""
    facts = ["completed_at", "batch_size", "grad_accum", "effective_batch", "perplexity", "training_time"]
    lines = [F.concat(F.lit(f"{name} = "), F.col(name).cast("string")) for name in facts]  # null facts are skipped
    return F.concat_ws("\n", F.concat(F.lit("run = "), F.col("run")), *lines, F.lit("arguments"), argument_lines(F.col("args")))


def write_summary(stats: DataFrame, path: str) -> None:
    """One text file or more per task; a run's section is one record, ended by a blank line."""
    stats.select(summary_text().alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Report sections as written."""
    return spark.read.option("lineSep", "\n\n").text(path).withColumnRenamed("value", "summary")
