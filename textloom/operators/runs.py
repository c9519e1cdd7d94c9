"""Run analytics: log grammar, hardware use, trials, status, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.numbers import percent_floor
from textloom.functions.records import single_quoted_metrics
from textloom.functions.times import LOG_SEPARATOR, LOG_STAMP_CHARS, parse_duration, parse_log_stamp
from textloom.operators.ranking import running_extremes, sorted_rank

# How the messages of each event begin.
EVENT_PREFIXES = [
    ("gpu", "GPU Memory Usage: "),
    ("ram", "RAM Usage: "),
    ("split", "Training on "),
    ("stage", "Step "),
    ("size", "Train dataset size: "),
    ("size", "Eval dataset size: "),
    ("range", "Initial search range: "),
    ("safe_probe", "Testing a safe batch size of "),
    ("safe_result", "Safe batch size "),
    ("safe_result", "Even safe batch size "),
    ("probe", "Trying batch size: "),
    ("probe_result", "Batch size "),
    ("probe_result", "OOM error at batch size "),
    ("probe_result", "Error at batch size "),
    ("found", "Maximum batch size found: "),
    ("cache", "Loading raw text dataset from cache"),
    ("cache", "Loading tokenized datasets from cache"),
    ("cache", "Cache not found"),
    ("eval", "Final evaluation metrics: "),
    ("final", "Training complete in "),
    ("final", "Maximum batch size: "),
    ("final", "Gradient accumulation steps: "),
    ("final", "Effective batch size: "),
    ("final", "Final perplexity: "),
    ("extract", "Found "),
    ("extract", "Successfully processed "),
    ("extract", "Extracted text too short for "),
    ("extract", "Error on page "),
    ("extract", "Error processing "),
    ("argument", "  "),
]
# What an extraction line is about, by how it begins.
EXTRACT_KINDS = {
    "Found ": "found",
    "Successfully processed ": "processed",
    "Extracted text too short for ": "too_short",
    "Error on page ": "page_error",
    "Error processing ": "file_error",
}
NUMBER = "[0-9]+(?:\\.[0-9]+)?"
GPU_SAMPLE = "GPU [0-9]+: [^,]*"
EPOCH = "Epoch ([0-9]+)/([0-9]+)"
INT_MAX = 2**31 - 1


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds as a double, independent of the session time zone."""
    span = end - start
    parts = [(1, "SECOND"), (60, "MINUTE"), (3600, "HOUR"), (86400, "DAY")]
    total = F.lit(0.0)
    for factor, unit in parts:
        total = total + F.date_part(F.lit(unit), span).cast("double") * factor
    return total


def parse_log(lines: DataFrame, inherit: bool = True) -> DataFrame:
    """``(run, line_no, line)`` to time, level, message, event and typed fields.

    A line without a time belongs to the record above it: with ``inherit`` it takes that record's time and
    level. ``line_no`` is unique in a run.
    """
    stamped = lines.withColumn("_ts", parse_log_stamp(F.col("line")))
    rest = F.substring("line", LOG_STAMP_CHARS + len(LOG_SEPARATOR) + 1, INT_MAX)
    level = F.when(F.col("_ts").isNotNull(), F.substring_index(rest, LOG_SEPARATOR, 1))
    message = F.when(
        F.col("_ts").isNotNull(), F.substr(rest, F.length("level") + len(LOG_SEPARATOR) + 1)
    ).otherwise(F.col("line"))
    split = stamped.withColumn("level", level).select(
        "run", "line_no", F.col("_ts").alias("ts"), "level", message.alias("message")
    )
    if inherit:
        record = F.when(F.col("ts").isNotNull(), F.struct("line_no", "ts", "level"))
        above = running_extremes(split, "run", "line_no", {"_above": ("max", record)}, inclusive=True)
        split = above.select(
            "run", "line_no", F.col("_above.ts").alias("ts"), F.col("_above.level").alias("level"), "message"
        )
    return typed_messages(split)


def event_of(message: Column) -> Column:
    event = F.when(F.lit(False), "")
    for name, prefix in EVENT_PREFIXES:
        event = event.when(message.startswith(prefix), name)
    return event.when(message.rlike(EPOCH), "epoch")


def typed_messages(split: DataFrame) -> DataFrame:
    """Event and fields of ``message``; the numbers of a message in order fill its typed fields."""
    message, event = F.col("message"), F.col("event")
    found = split.withColumn("event", event_of(message)).withColumn(
        "_numbers",
        F.when(
            event.isNotNull() & ~event.isin("argument", "cache", "eval"),
            F.regexp_extract_all(message, F.lit(NUMBER), F.lit(0)),
        ),
    )

    def number(index: int, *events: str) -> Column:
        return F.when(event.isin(*events), F.get("_numbers", F.lit(index)).try_cast("double"))

    probes = ["safe_probe", "safe_result", "probe", "probe_result", "found"]
    batch = F.coalesce(number(0, *probes), F.when(message.startswith("Maximum batch size: "), number(0, "final")))
    accum = F.coalesce(
        number(1, "probe"), F.when(message.startswith("Gradient accumulation steps: "), number(0, "final"))
    )
    dataset = F.when(event == "size", F.when(message.startswith("Train "), "train").otherwise("eval"))
    kind = F.lit(None).cast("string")
    for prefix, name in EXTRACT_KINDS.items():
        kind = F.when(message.startswith(prefix), name).otherwise(kind)
    kind = F.when(event == "extract", kind)
    named = F.regexp_extract(message, "(?:^Successfully processed | for | of |^Error processing )(/[^:]*)", 1)
    outcome = F.when(message.contains("works!"), "success").when(message.startswith("OOM error"), "oom").otherwise("fail")
    result = F.when(event.isin("probe_result", "safe_result"), outcome)
    device_shift = {"gpu": 1, "ram": 0}

    def usage(index: int) -> Column:
        return F.coalesce(*[number(index + shift, kind) for kind, shift in device_shift.items()])

    return found.select(
        "run",
        "line_no",
        "ts",
        "level",
        "message",
        "event",
        number(0, "gpu").cast("int").alias("device"),
        usage(0).alias("used"),
        usage(1).alias("total"),
        usage(2).alias("pct"),
        batch.cast("int").alias("batch_size"),
        accum.cast("int").alias("grad_accum"),
        result.alias("result"),
        number(0, "stage").cast("int").alias("stage"),
        F.when(event == "stage", F.regexp_extract(message, "^Step [0-9]+: (.*)$", 1)).alias("title"),
        dataset.alias("dataset"),
        kind.alias("kind"),
        F.when(F.col("kind") == "page_error", number(0, "extract")).cast("int").alias("page"),
        F.when(event.eqNullSafe("extract") & (named != ""), F.trim(named)).alias("path"),
        F.when(F.col("kind") == "found", number(0, "extract")).cast("bigint").alias("files"),
        number(0, "split", "size", "range").cast("bigint").alias("first_count"),
        number(1, "split", "range").cast("bigint").alias("second_count"),
        F.when(event == "cache", ~message.startswith("Cache not found")).alias("cache_hit"),
        F.when(event == "argument", F.trim(F.substring_index(message, ":", 1))).alias("name"),
        F.when(event == "argument", F.trim(F.regexp_replace(message, "^[^:]*:", ""))).alias("value"),
        F.when(event == "eval", single_quoted_metrics(message)).alias("metrics"),
        F.when(message.startswith("Training complete in "), parse_duration(message)).alias("seconds"),
        F.when(message.startswith("Final perplexity: "), number(0, "final")).alias("perplexity"),
        F.when(event == "epoch", F.regexp_extract(message, EPOCH, 0)).alias("epoch"),
    )


def hardware_samples(parsed: DataFrame) -> DataFrame:
    """``(run, ts, kind, device, used, total, pct)``; a line with several devices gives several rows."""
    gpu = parsed.filter(F.col("event") == "gpu").select(
        "run", "ts", F.explode(F.regexp_extract_all("message", F.lit(GPU_SAMPLE), F.lit(0))).alias("_sample")
    )
    numbers = F.transform(F.regexp_extract_all("_sample", F.lit(NUMBER), F.lit(0)), lambda n: n.try_cast("double"))
    devices = gpu.select("run", "ts", numbers.alias("_n")).select(
        "run",
        "ts",
        F.lit("gpu").alias("kind"),
        F.get("_n", F.lit(0)).cast("int").alias("device"),
        F.get("_n", F.lit(1)).alias("used"),
        F.get("_n", F.lit(2)).alias("total"),
        F.get("_n", F.lit(3)).alias("pct"),
    )
    memory = parsed.filter(F.col("event") == "ram").select(
        "run", "ts", F.lit("ram").alias("kind"), "device", "used", "total", "pct"
    )
    return devices.unionByName(memory)


def hardware_usage(samples: DataFrame, *by: str) -> DataFrame:
    """Peak, mean and time of the peak per group; the integer percent is rounded down."""
    return samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.max("used").alias("peak_used"),
        F.round(F.avg("used"), 6).alias("mean_used"),
        F.max_by("ts", F.struct("used", "ts")).alias("peak_ts"),
        F.max(percent_floor(F.floor("used"), F.floor("total"))).alias("peak_percent"),
    )


def device_filter(samples: DataFrame, device: int) -> DataFrame:
    return samples.filter(F.col("device") == device)


def every_nth_step(records: DataFrame, n: int = 10, step: str = "step") -> DataFrame:
    return records.filter(F.col(step) % n == 0)


def last_values(parsed: DataFrame) -> DataFrame:
    """Latest found batch size and epoch progress of each run."""
    found = F.when(F.col("event") == "found", F.struct("line_no", "batch_size"))
    epoch = F.when(F.col("event") == "epoch", F.struct("line_no", "epoch"))
    return parsed.groupBy("run").agg(
        F.max(found)["batch_size"].alias("found_batch"), F.max(epoch)["epoch"].alias("epoch"), F.max("ts").alias("last_ts")
    )


def tail_per_run(lines: DataFrame, n: int = 5, group: str = "run", order: str = "line_no") -> DataFrame:
    """Last ``n`` rows of each group; every task keeps at most ``n`` per group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(order)))
    return lines.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def elapsed(parsed: DataFrame) -> DataFrame:
    """Wall time of each run, and of each stage up to the next one: ``(run, stage, started, seconds)``.

    The row with a null stage is the whole run. Stages are aggregated before they are put in order.
    """
    spans = parsed.groupBy("run").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))
    stages = (
        parsed.filter(F.col("event") == "stage").groupBy("run", "stage").agg(F.min("ts").alias("started"))
    )
    following = F.lead("started").over(Window.partitionBy("run").orderBy("started", "stage"))
    ended = stages.withColumn("_next", following).join(spans.select("run", "ended"), "run")
    per_stage = ended.select("run", "stage", "started", F.coalesce("_next", "ended").alias("ended"))
    whole = spans.select("run", F.lit(None).cast("int").alias("stage"), "started", "ended")
    return whole.unionByName(per_stage).select(
        "run", "stage", "started", F.round(seconds_between(F.col("started"), F.col("ended")), 3).alias("seconds")
    )


def trials(parsed: DataFrame) -> DataFrame:
    """Batch-size trials ``(run, seq, ts, batch_size, result)``, a row per trial.

    A tried safe size is reported in a line of its own and, in some logs, also like any other size: an ordinary line
    is left out where the outcome just before it in the run is the safe line of the same size and result.
    """
    outcome = parsed.filter(F.col("event").isin("probe_result", "safe_result"))
    record = F.struct("line_no", "event", "batch_size", "result")
    seen = running_extremes(outcome, "run", "line_no", {"_before": ("max", record)}, inclusive=False)
    twin = (
        (F.col("event") == "probe_result")
        & (F.col("_before.event") == "safe_result")
        & (F.col("_before.batch_size") == F.col("batch_size"))
        & (F.col("_before.result") == F.col("result"))
    )
    return seen.filter(~F.coalesce(twin, F.lit(False))).select(
        "run", F.col("line_no").alias("seq"), "ts", "batch_size", "result"
    )


def trial_frontier(attempts: DataFrame) -> DataFrame:
    """Largest size shown to fit, smallest shown not to, counts and time per run; null when there is none."""
    ok = F.col("result") == "success"
    return attempts.groupBy("run").agg(
        F.max(F.when(ok, F.col("batch_size"))).alias("largest_success"),
        F.min(F.when(~ok, F.col("batch_size"))).alias("smallest_failure"),
        F.count_if(F.col("result") == "oom").alias("ooms"),
        F.count(F.lit(1)).alias("trials"),
        F.round(seconds_between(F.min("ts"), F.max("ts")), 3).alias("seconds"),
    )


def search_bounds(attempts: DataFrame, low: int, high: int) -> DataFrame:
    """Range of sizes still open before each trial, by ``seq`` in a run.

    It starts as ``low`` to ``high``; a success moves the lower end above its size, a failure the upper end below.
    """
    ok = F.col("result") == "success"
    ends = {
        "lower": ("max", F.when(ok, F.col("batch_size") + 1)),
        "upper": ("min", F.when(~ok, F.col("batch_size") - 1)),
    }
    found = running_extremes(attempts, "run", "seq", ends, inclusive=False)
    return found.withColumns(
        {"lower": F.greatest(F.coalesce("lower", F.lit(low)), F.lit(low)), "upper": F.least(F.coalesce("upper", F.lit(high)), F.lit(high))}
    )


def retain_last(checkpoints: DataFrame, k: int = 1, group: str = "run", order: str = "step") -> DataFrame:
    """Newest ``k`` checkpoints of each run."""
    return tail_per_run(checkpoints, k, group, order)


def run_facts(runs: DataFrame, markers: DataFrame, stats: DataFrame, logs: DataFrame) -> DataFrame:
    """Runs with what is known of them: started marker, statistics, newest log values; each may be missing."""
    started = markers.select("run", F.lit(True).alias("has_pid"))
    results = stats.select("run", F.lit(True).alias("has_stats"), "batch_size", "perplexity")
    return (
        runs.select("run")
        .join(started, "run", "left")
        .join(results, "run", "left")
        .join(logs, "run", "left")
        .withColumns({name: F.coalesce(name, F.lit(False)) for name in ("has_pid", "has_stats")})
    )


def run_status(facts: DataFrame, as_of: Column, quiet: str = "INTERVAL 10 MINUTES") -> DataFrame:
    """Running / Completed / Failed / Unknown with details.

    A run is alive when its newest log line is at most ``quiet`` older than ``as_of``.
    """
    alive = F.coalesce(F.col("last_ts") >= as_of - F.expr(quiet), F.lit(False))
    status = (
        F.when(~F.col("has_pid"), "Unknown")
        .when(alive, "Running")
        .when(F.col("has_stats"), "Completed")
        .otherwise("Failed")
    )
    running = F.concat(
        F.coalesce(F.concat(F.lit(" - Batch size: "), F.col("found_batch").cast("string")), F.lit("")),
        F.coalesce(F.concat(F.lit(" - "), F.col("epoch")), F.lit("")),
    )
    completed = F.coalesce(
        F.concat(
            F.lit(" - Batch size: "),
            F.col("batch_size").cast("string"),
            F.lit(", Perplexity: "),
            F.col("perplexity").cast("string"),
        ),
        F.lit(""),
    )
    detail = F.when(F.col("status") == "Running", running).when(F.col("status") == "Completed", completed).otherwise("")
    return facts.withColumn("status", status).select("run", "status", F.concat("status", detail).alias("detail"))


def rank_runs(stats: DataFrame) -> DataFrame:
    """Runs with their ``position`` by effective batch, highest first; equal ones by name, last first."""
    placed = sorted_rank(stats, [F.desc("effective_batch"), F.desc("run")], "position")
    return placed.withColumn("position", F.col("position") + 1)


def best_run(stats: DataFrame) -> DataFrame:
    """Highest effective batch and lowest perplexity; ties as in :func:`rank_runs`, and by first name."""
    by_batch = F.struct("effective_batch", "run")
    by_perplexity = F.when(F.col("perplexity").isNotNull(), F.struct("perplexity", "run"))
    return stats.agg(
        F.max(by_batch)["run"].alias("best_batch_run"),
        F.max(by_batch)["effective_batch"].alias("best_effective_batch"),
        F.min(by_perplexity)["run"].alias("best_perplexity_run"),
        F.min(by_perplexity)["perplexity"].alias("best_perplexity"),
    )


def compare_runs(stats: DataFrame) -> DataFrame:
    """Ranked table of runs with the two winners marked."""
    best = best_run(stats).select(F.struct("best_batch_run", "best_perplexity_run")).scalar()
    marked = stats.withColumn("_best", best).select(
        "run",
        "batch_size",
        "effective_batch",
        "perplexity",
        "training_time",
        "args",
        (F.col("run") == F.col("_best.best_batch_run")).alias("best_batch"),
        (F.col("run") == F.col("_best.best_perplexity_run")).alias("best_perplexity"),
    )
    return rank_runs(marked)


def perplexity(losses: DataFrame, *by: str, loss: str = "loss", weight: str = "weight") -> DataFrame:
    """``exp`` of the weighted mean loss. Weights are padded positions, or tokens for a token mean."""
    mean = F.sum(F.col(loss) * F.col(weight)) / F.sum(weight)
    return losses.groupBy(*by).agg(F.round(F.exp(mean), 6).alias("perplexity"), F.sum(weight).alias("weight"))


def row_perplexity(logs: DataFrame) -> DataFrame:
    """Perplexity beside every loss that is present."""
    return logs.withColumns({"pplx": F.exp("loss"), "eval_pplx": F.exp("eval_loss")})


def metrics_long(wide: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Wide metric columns to ``(ids, metric, value)``; absent metrics give no row."""
    return wide.unpivot(ids, metrics, "metric", "value").filter("value is not null")
