"""Registered queries on runs: scalar functions on events, logs, statistics, trials, status."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import numbers, records, times
from textloom.functions.text import csv_fields, digits
from textloom.operators import runs as ops
from textloom.operators.sweep import RUNS, sweep_grid
from textloom.session import work_path
from textloom.sources import runs as sources
from textloom.tables import batch_trials, load, log_lines, run_markers, run_stats, user_run

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def events(spark, sf_dir):
    return load(spark, sf_dir, "events")


# --- oracle building blocks: the same facts straight from the events -----------------------------

LOG_SQL = """
e AS (SELECT *, 'run_' || user_id AS run, date_trunc('millisecond', ts) AS t, CAST(event_id % 64 + 1 AS INTEGER) AS b,
             CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'error') AND value >= 160 THEN event_id % 20 END AS k FROM events),
kinds(k, event) AS (VALUES (0, 'size'), (1, 'size'), (2, 'split'), (3, 'range'), (4, 'safe_probe'), (5, 'safe_result'), (6, 'cache'),
  (7, 'cache'), (8, 'eval'), (9, 'final'), (10, 'extract'), (11, NULL), (12, 'extract'), (13, 'extract'), (14, 'extract'),
  (15, 'extract'), (16, 'safe_result'), (17, 'final'), (18, 'final'), (19, 'final')),
log AS (
  SELECT run, event_id * 2 AS line_no, t AS ts, e.value, event_id, b, props, e.k,
         CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'ram' WHEN 'purchase' THEN 'probe' WHEN 'error' THEN 'probe_result'
           ELSE CASE WHEN value < 40 THEN 'probe_result' WHEN value < 80 THEN 'found' WHEN value < 120 THEN 'epoch'
                     WHEN value < 160 THEN 'stage' ELSE kinds.event END END AS event,
         CASE WHEN event_type = 'error' THEN CASE WHEN value < 120 THEN 'oom' ELSE 'fail' END WHEN e.k = 16 THEN 'fail'
              WHEN event_type = 'signup' AND (value < 40 OR e.k = 5) THEN 'success' END AS result,
         CAST(NULL AS INTEGER) AS device, FALSE AS twin FROM e LEFT JOIN kinds USING (k)
  UNION ALL
  SELECT run, event_id * 2 + 1, t, value, event_id, b, props, NULL, 'gpu', NULL, CAST(user_id % 8 AS INTEGER), FALSE FROM e WHERE event_type = 'view'
  UNION ALL
  SELECT run, event_id * 2 + 1, t, value, event_id, b, props, NULL, 'probe_result', 'success', NULL, TRUE FROM e WHERE k = 5
  UNION ALL
  SELECT run, event_id * 2 + 1, t, value, event_id, b, props, NULL, 'argument', NULL, NULL, FALSE FROM e WHERE k = 11
)
"""

STATS_SQL = """
stats AS (
  SELECT 'run_' || user_id AS run, CAST(user_id % 32 + 1 AS INTEGER) AS batch_size,
         CAST(greatest(1, 32 // (user_id % 32 + 1)) AS INTEGER) AS grad_accum,
         CAST((user_id % 32 + 1) * greatest(1, 32 // (user_id % 32 + 1)) AS INTEGER) AS effective_batch,
         round(1 + avg(value), 2) AS perplexity,
         (count(*) * 60) // 3600 || 'h ' || ((count(*) * 60) % 3600) // 60 || 'm ' || (count(*) * 60) % 60 || 's' AS training_time,
         date_trunc('second', max(ts)) AS completed_at, user_id
  FROM events GROUP BY user_id
)
"""

MARKERS_SQL = """
markers AS (SELECT 'run_' || user_id AS run, arg_min(value, event_id) > 10 AS has_pid, arg_max(value, event_id) > 30 AS has_stats,
                   max(ts) AS last_ts FROM events GROUP BY user_id)
"""

LAST_SQL = """
last AS (SELECT run, arg_max(b, line_no) FILTER (event = 'found') AS found_batch,
                'Epoch ' || (arg_max(event_id, line_no) FILTER (event = 'epoch')) % 3 + 1 || '/3' AS epoch,
                max(ts) AS last_ts FROM log GROUP BY run)
"""

TRIALS_SQL = """
trials AS (SELECT user_id AS run, event_id AS seq, ts, CAST(event_id % 64 + 1 AS INTEGER) AS batch_size,
  CASE WHEN value < 40 THEN 'success' WHEN value < 120 THEN 'oom' ELSE 'fail' END AS result FROM events)
"""


# --- scalar functions on events -----------------------------------------------------------------


@query("every_nth_step", "SELECT event_id AS step, value FROM events WHERE event_id % 10 = 0")
def every_nth_step(spark, sf_dir):
    return ops.every_nth_step(events(spark, sf_dir).select(F.col("event_id").alias("step"), "value"), 10)


@query(
    "device_filter",
    "SELECT event_id, CAST(user_id % 8 AS INTEGER) AS device, value FROM events WHERE user_id % 8 = 3",
)
def device_filter(spark, sf_dir):
    device = (F.col("user_id") % 8).cast("int").alias("device")
    return ops.device_filter(events(spark, sf_dir).select("event_id", device, "value"), 3)


@query(
    "prefix_metrics",
    """SELECT event_id, 'eval/value' AS metric, value FROM events
UNION ALL SELECT event_id, 'eval/user', CAST(user_id AS DOUBLE) FROM events""",
)
def prefix_metrics(spark, sf_dir):
    metrics = F.create_map(F.lit("value"), F.col("value"), F.lit("user"), F.col("user_id").cast("double"))
    return events(spark, sf_dir).select(
        "event_id", F.explode(records.prefix_metrics(metrics, "eval")).alias("metric", "value")
    )


@query("classify_error", f"WITH {TRIALS_SQL} SELECT seq, result FROM trials")
def classify_error(spark, sf_dir):
    return batch_trials(spark, sf_dir).select("seq", records.classify_error(F.col("message")).alias("result"))


@query(
    "grad_accum",
    """SELECT event_id, CAST(greatest(1, 32 // b) AS INTEGER) AS grad_accum, CAST(b * greatest(1, 32 // b) AS INTEGER) AS effective
FROM (SELECT event_id, event_id % 64 + 1 AS b FROM events)""",
)
def grad_accum(spark, sf_dir):
    size = (F.col("event_id") % 64 + 1).cast("int")
    return events(spark, sf_dir).select(
        "event_id", numbers.grad_accum(size).alias("grad_accum"), numbers.effective_batch(size).alias("effective")
    )


@query(
    "duration_text",
    """SELECT event_id, s // 3600 || 'h ' || (s % 3600) // 60 || 'm ' || s % 60 || 's' AS duration, s AS seconds
FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS s FROM events)""",
)
def duration_text(spark, sf_dir):
    text = times.duration_text(F.col("value") * 100)
    return events(spark, sf_dir).select(
        "event_id", text.alias("duration"), times.parse_duration(text).alias("seconds")
    )


@query(
    "percent",
    """SELECT event_id, round(value / 512.0::DOUBLE * 100, 1) AS pct, CAST(floor(value) AS BIGINT) * 100 // 512 AS whole_pct FROM events""",
)
def percent(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        numbers.percent(F.col("value"), F.lit(512.0)).alias("pct"),
        numbers.percent_floor(F.floor("value"), F.lit(512)).alias("whole_pct"),
    )


@query(
    "unit_scale",
    """SELECT event_id, (user_id * 1000003) / 1e9::DOUBLE AS gb, event_id AS mib FROM events""",
)
def unit_scale(spark, sf_dir):
    printed = F.concat(F.col("event_id").cast("string"), F.lit(" MiB"))
    return events(spark, sf_dir).select(
        "event_id",
        numbers.gigabytes(F.col("user_id") * 1000003).alias("gb"),
        digits(printed).cast("bigint").alias("mib"),
    )


@query(
    "timestamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp,
       date_trunc('millisecond', ts) AS log_time FROM events""",
)
def timestamps(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id",
        times.stamp(ts).alias("stamp"),
        times.stamp(ts, times.FILE_STAMP_FORMAT).alias("file_stamp"),
        times.parse_log_stamp(F.concat(times.log_stamp(ts), F.lit(" - INFO - x"))).alias("log_time"),
    )


@query(
    "run_name",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type ELSE 'run-' || strftime(ts, '%Y%m%d-%H%M%S') END AS name
FROM events""",
)
def run_name(spark, sf_dir):
    given = F.when(F.col("event_type") != "error", F.col("event_type"))
    return events(spark, sf_dir).select("event_id", times.run_name(given, F.col("ts")).alias("name"))


@query("kv_parse", f"WITH {STATS_SQL} SELECT run, batch_size, perplexity, '42' AS seed, 'a: b,c' AS tags FROM stats")
def kv_parse(spark, sf_dir):
    body = F.col("body")
    args = records.kv_arguments(body)
    return run_stats(spark, sf_dir).select(
        "run",
        records.kv_field(body, "Maximum batch size").try_cast("int").alias("batch_size"),
        records.kv_field(body, "Final perplexity").try_cast("double").alias("perplexity"),
        args["seed"].alias("seed"),
        args["tags"].alias("tags"),
    )


@query("csv_fields", "SELECT event_id, event_type AS name, user_id AS device, value FROM events")
def csv_fields_query(spark, sf_dir):
    line = F.concat_ws(" ,  ", "event_type", F.col("user_id").cast("string"), F.col("value").cast("string"))
    fields = events(spark, sf_dir).select("event_id", csv_fields(line).alias("f"))
    return fields.select(
        "event_id",
        F.col("f")[0].alias("name"),
        F.col("f")[1].cast("bigint").alias("device"),
        F.col("f")[2].cast("double").alias("value"),
    )


@query(
    "json_functions",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       '{"event":"' || event_type || '","user":' || user_id || '}' AS record FROM events""",
)
def json_functions(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct(F.col("event_type").alias("event"), F.col("user_id").alias("user"))).alias("record"),
    )


@query(
    "row_perplexity",
    """SELECT event_id, round(exp(CASE WHEN event_type <> 'view' THEN value / 100 END), 6) AS pplx,
       round(exp(CASE WHEN event_type = 'view' THEN value / 200 END), 6) AS eval_pplx FROM events""",
)
def row_perplexity(spark, sf_dir):
    logs = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("value") / 100).alias("loss"),
        F.when(F.col("event_type") == "view", F.col("value") / 200).alias("eval_loss"),
    )
    return ops.row_perplexity(logs).select(
        "event_id", F.round("pplx", 6).alias("pplx"), F.round("eval_pplx", 6).alias("eval_pplx")
    )


@query(
    "perplexity",
    """SELECT l_returnflag AS grp, round(exp(sum((1 + 20 * l_discount) * l_quantity) / sum(l_quantity)), 6) AS perplexity,
       sum(l_quantity) AS weight FROM lineitem GROUP BY 1""",
)
def perplexity(spark, sf_dir):
    losses = load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("grp"),
        (1 + 20 * F.col("l_discount")).alias("loss"),
        F.col("l_quantity").alias("weight"),
    )
    return ops.perplexity(losses, "grp")


@query(
    "metrics_long",
    """SELECT event_id, 'train/value' AS metric, value FROM events
UNION ALL SELECT event_id, 'train/user', CAST(user_id AS DOUBLE) FROM events
UNION ALL SELECT event_id, 'train/big', value FROM events WHERE value > 100""",
)
def metrics_long(spark, sf_dir):
    wide = events(spark, sf_dir).select(
        "event_id",
        F.col("value").alias("train/value"),
        F.col("user_id").cast("double").alias("train/user"),
        F.when(F.col("value") > 100, F.col("value")).alias("train/big"),
    )
    return ops.metrics_long(wide, ["event_id"], ["train/value", "train/user", "train/big"])


# --- logs ---------------------------------------------------------------------------------------


@query(
    "read_logs",
    """SELECT event_id, ts AS logged_at, row_number() OVER (ORDER BY event_id) AS position FROM events""",
)
def read_logs(spark, sf_dir):
    """Events written in order as log files and read back: line numbers give every event's place."""
    folder = work_path(spark, "logs")
    line = F.concat_ws(" ", F.col("event_id").cast("string"), F.col("ts").cast("string"))
    events(spark, sf_dir).orderBy("event_id").select(line.alias("value")).write.text(folder)
    lines = sources.read_logs(spark, folder, "*.txt")
    sizes = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"))  # one row per writing task
    shifts = sizes.select("path", (F.sum("n").over(Window.orderBy("path")) - F.col("n")).alias("shift"))
    fields = F.split("line", " ", 2)
    return lines.join(shifts, "path").select(
        fields[0].cast("bigint").alias("event_id"),
        fields[1].cast("timestamp_ntz").alias("logged_at"),
        (F.col("shift") + F.col("line_no")).alias("position"),
    )


@query(
    "parse_log",
    f"""WITH {LOG_SQL}
SELECT run, line_no, ts, event, device, CASE WHEN event IN ('gpu', 'ram') THEN value END AS used,
       CASE WHEN event IN ('probe', 'probe_result', 'found', 'safe_probe', 'safe_result') OR k = 17 THEN b END AS batch_size,
       CASE WHEN event = 'probe' THEN 1 WHEN k = 18 THEN b END AS grad_accum, result,
       CASE WHEN event = 'stage' THEN CAST(event_id % 6 + 1 AS INTEGER) END AS stage,
       CASE WHEN event = 'stage' THEN 'next stage ' || b END AS title,
       CASE k WHEN 0 THEN 'train' WHEN 1 THEN 'eval' END AS dataset,
       CASE k WHEN 10 THEN 'page_error' WHEN 12 THEN 'found' WHEN 13 THEN 'processed' WHEN 14 THEN 'too_short' WHEN 15 THEN 'file_error' END AS kind,
       CASE WHEN k = 10 THEN b END AS page,
       CASE WHEN k IN (10, 13, 14, 15) THEN '/in/my doc ' || event_id || '.src' END AS path,
       CASE WHEN k = 12 THEN event_id END AS files,
       CASE WHEN k IN (0, 1, 2) THEN event_id WHEN k = 3 THEN CAST(b AS BIGINT) END AS first_count,
       CASE WHEN k = 2 THEN CAST(b AS BIGINT) WHEN k = 3 THEN event_id END AS second_count,
       CASE k WHEN 6 THEN TRUE WHEN 7 THEN FALSE END AS cache_hit,
       CASE WHEN event = 'argument' THEN 'seed' END AS name, CASE WHEN event = 'argument' THEN CAST(event_id AS VARCHAR) END AS argument,
       CASE WHEN k = 8 THEN value END AS eval_loss, CASE WHEN k = 9 THEN CAST(floor(value) AS BIGINT) END AS seconds,
       CASE WHEN k = 19 THEN value END AS perplexity,
       CASE WHEN event = 'epoch' THEN 'Epoch ' || event_id % 3 + 1 || '/3' END AS epoch
FROM log""",
)
def parse_log(spark, sf_dir):
    """Every event kind of the grammar with all its typed fields."""
    parsed = ops.parse_log(log_lines(spark, sf_dir))
    return parsed.withColumn("eval_loss", F.col("metrics")["eval_loss"]).select(
        *"run line_no ts event device used batch_size grad_accum result stage title dataset kind page path files".split(),
        *"first_count second_count cache_hit name eval_loss perplexity epoch".split(),
        F.col("value").alias("argument"),
        F.col("seconds").cast("bigint").alias("seconds"),
    )


@query(
    "hardware_usage",
    f"""WITH {LOG_SQL}
SELECT run, CASE event WHEN 'gpu' THEN 'gpu' ELSE 'ram' END AS kind, device, count(*) AS samples, max(value) AS peak_used,
       round(avg(value), 6) AS mean_used, arg_max(ts, {{v: value, t: ts}}) AS peak_ts,
       max(CAST(floor(value) AS BIGINT) * 100 // (CASE event WHEN 'gpu' THEN 512 ELSE 1082 END)) AS peak_percent
FROM log WHERE event IN ('gpu', 'ram') GROUP BY ALL""",
)
def hardware_usage(spark, sf_dir):
    samples = ops.hardware_samples(ops.parse_log(log_lines(spark, sf_dir)))
    return ops.hardware_usage(samples, "run", "kind", "device")


@query("last_value_per_run", f"WITH {LOG_SQL}, {LAST_SQL} SELECT * FROM last")
def last_value_per_run(spark, sf_dir):
    return ops.last_values(ops.parse_log(log_lines(spark, sf_dir)))


@query(
    "tail_per_run",
    """SELECT event_type AS run, event_id AS line_no, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 5""",
)
def tail_per_run(spark, sf_dir):
    lines = events(spark, sf_dir).select(F.col("event_type").alias("run"), F.col("event_id").alias("line_no"), "value")
    return ops.tail_per_run(lines)


@query(
    "retain_last",
    """SELECT user_id AS run, event_id AS step FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 1""",
)
def retain_last(spark, sf_dir):
    saved = events(spark, sf_dir).select(F.col("user_id").alias("run"), F.col("event_id").alias("step"))
    return ops.retain_last(saved, 1)


@query(
    "elapsed",
    f"""WITH {LOG_SQL},
spans AS (SELECT run, min(ts) AS started, max(ts) AS ended FROM log GROUP BY run),
stages AS (SELECT run, CAST(event_id % 6 + 1 AS INTEGER) AS stage, min(ts) AS started FROM log WHERE event = 'stage' GROUP BY ALL),
ends AS (SELECT run, stage, s.started, coalesce(lead(s.started) OVER (PARTITION BY run ORDER BY s.started, stage), spans.ended) AS ended
         FROM stages s JOIN spans USING (run)),
rows AS (SELECT run, CAST(NULL AS INTEGER) AS stage, started, ended FROM spans UNION ALL SELECT * FROM ends)
SELECT run, stage, started, round(epoch_ms(ended) / 1000.0::DOUBLE - epoch_ms(started) / 1000.0::DOUBLE, 3) AS seconds FROM rows""",
)
def elapsed(spark, sf_dir):
    return ops.elapsed(ops.parse_log(log_lines(spark, sf_dir)))


@query(
    "run_log_match",
    """WITH runs AS (SELECT DISTINCT 'run_' || user_id AS run FROM events),
logs AS (SELECT DISTINCT 'run_' || user_id AS run, '/logs/run_' || user_id || '_gpu' || event_id % 8 || '.log' AS path
         FROM events WHERE event_type = 'error')
SELECT run, min(path) AS log_path FROM runs LEFT JOIN logs USING (run) GROUP BY run""",
)
def run_log_match(spark, sf_dir):
    runs = events(spark, sf_dir).select(user_run().alias("run")).distinct()
    name = F.concat(user_run(), F.lit("_gpu"), F.col("event_id") % 8, F.lit(".log"))
    logs = events(spark, sf_dir).filter("event_type = 'error'").select(
        F.concat(F.lit("/logs/"), name).alias("path"), name.alias("file_name")
    )
    return sources.match_logs(runs, logs)


# --- trials -------------------------------------------------------------------------------------


@query(
    "trial_frontier",
    f"""WITH {TRIALS_SQL}
SELECT run, max(batch_size) FILTER (result = 'success') AS largest_success, min(batch_size) FILTER (result <> 'success') AS smallest_failure,
       count(*) FILTER (result = 'oom') AS ooms, count(*) AS trials,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE, 3) AS seconds
FROM trials GROUP BY run""",
)
def trial_frontier(spark, sf_dir):
    return ops.trial_frontier(batch_trials(spark, sf_dir))


@query(
    "log_trials",
    f"""WITH {LOG_SQL} SELECT run, b AS batch_size, result, line_no AS seq, ts
FROM log WHERE event IN ('probe_result', 'safe_result') AND NOT twin""",
)
def log_trials(spark, sf_dir):
    return ops.trials(ops.parse_log(log_lines(spark, sf_dir)))


@query(
    "search_bounds",
    f"""WITH {TRIALS_SQL}
SELECT run, seq, batch_size, result, greatest(1, coalesce(max(batch_size) FILTER (result = 'success') OVER w + 1, 1)) AS lower,
       least(64, coalesce(min(batch_size) FILTER (result <> 'success') OVER w - 1, 64)) AS upper
FROM trials WINDOW w AS (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def search_bounds(spark, sf_dir):
    attempts = batch_trials(spark, sf_dir).select("run", "seq", "batch_size", "result")
    return ops.search_bounds(attempts, 1, 64)


# --- statistics, comparison, status -------------------------------------------------------------


def stored_stats(spark, sf_dir):
    """Statistics texts as files, one per run in a folder named ``run=<run> 5%``; the seed stands there twice."""
    folder = work_path(spark, "run_stats")
    body = F.replace(F.col("body"), F.lit("Arguments:\n"), F.lit("Arguments:\n  seed: 1\n"))
    rows = run_stats(spark, sf_dir).select(F.concat("run", F.lit(" 5%")).alias("run"), body.alias("value"))
    rows.write.partitionBy("run").text(folder)
    return folder


def read_stats(spark, sf_dir):
    """The stored statistics, read back and parsed, under the names the runs have."""
    parsed = sources.read_run_stats(spark, stored_stats(spark, sf_dir), "part-*")
    # the writer escapes the percent sign of a folder's name
    return parsed.withColumn("run", F.regexp_extract("run", "^run=(.*) 5%25$", 1))


@query(
    "read_run_stats",
    f"""WITH {STATS_SQL}
SELECT run, completed_at, batch_size, grad_accum, effective_batch, perplexity, training_time, CAST(user_id AS VARCHAR) AS user_arg,
       '42' AS seed FROM stats""",
)
def read_run_stats(spark, sf_dir):
    """Statistics files of run folders; of a repeated argument the last counts."""
    args = F.col("args")
    return read_stats(spark, sf_dir).withColumns({"user_arg": args["user"], "seed": args["seed"]}).drop("args")


BODY_SQL = f"""WITH {STATS_SQL}
SELECT run, 'Training completed at: ' || strftime(completed_at, '%Y-%m-%d %H:%M:%S') || chr(10) ||
  'Maximum batch size: ' || batch_size || chr(10) || 'Gradient accumulation steps: ' || grad_accum || chr(10) ||
  'Effective batch size: ' || effective_batch || chr(10) || 'Final perplexity: ' || printf('%.2f', perplexity) || chr(10) ||
  'Total training time: ' || training_time || chr(10) || chr(10) || 'Arguments:' || chr(10) ||
  '  seed: 42' || chr(10) || '  tags: a: b,c' || chr(10) || '  user: ' || user_id AS body FROM stats"""


@query("write_run_stats", BODY_SQL)
def write_run_stats(spark, sf_dir):
    """Statistics stored as typed rows with a map of arguments, read back and rendered as text."""
    path = work_path(spark, "run_stats")
    sources.write_run_stats(sources.parse_run_stats(run_stats(spark, sf_dir)), path)
    body = sources.stats_text(
        F.col("completed_at"),
        F.col("batch_size"),
        F.col("grad_accum"),
        F.col("perplexity"),
        times.parse_duration("training_time"),
        F.col("args"),
    )
    return spark.read.parquet(path).select("run", body.alias("body"))


@query(
    "write_summary",
    f"""WITH {STATS_SQL}
SELECT 'run = ' || run || chr(10) || 'completed_at = ' || strftime(completed_at, '%Y-%m-%d %H:%M:%S') || chr(10) ||
  'batch_size = ' || batch_size || chr(10) || 'grad_accum = ' || grad_accum || chr(10) || 'effective_batch = ' || effective_batch || chr(10) ||
  'perplexity = ' || perplexity || chr(10) || 'training_time = ' || training_time || chr(10) || 'arguments' || chr(10) ||
  '  seed: 42' || chr(10) || '  tags: a: b,c' || chr(10) || '  user: ' || user_id AS summary
FROM stats""",
)
def write_summary(spark, sf_dir):
    """Report sections written as text and read back."""
    path = work_path(spark, "summary")
    sources.write_summary(sources.parse_run_stats(run_stats(spark, sf_dir)), path)
    return sources.read_summary(spark, path)


@query(
    "rank_runs",
    f"""WITH {STATS_SQL} SELECT run, batch_size, effective_batch, perplexity, training_time,
  row_number() OVER (ORDER BY effective_batch DESC, run DESC) AS position FROM stats""",
)
def rank_runs(spark, sf_dir):
    parsed = sources.parse_run_stats(run_stats(spark, sf_dir))
    return ops.rank_runs(parsed).select("run", "batch_size", "effective_batch", "perplexity", "training_time", "position")


BEST_SQL = """
best AS (SELECT (SELECT run FROM stats ORDER BY effective_batch DESC, run DESC LIMIT 1) AS best_batch_run,
  (SELECT max(effective_batch) FROM stats) AS best_effective_batch,
  (SELECT run FROM stats ORDER BY perplexity, run LIMIT 1) AS best_perplexity_run, (SELECT min(perplexity) FROM stats) AS best_perplexity)
"""


@query("best_run", f"WITH {STATS_SQL}, {BEST_SQL} SELECT * FROM best")
def best_run(spark, sf_dir):
    return ops.best_run(sources.parse_run_stats(run_stats(spark, sf_dir)))


@query(
    "compare_runs",
    f"""WITH {STATS_SQL}, {BEST_SQL}
SELECT run, batch_size, effective_batch, stats.perplexity, training_time,
       '  seed: 42' || chr(10) || '  tags: a: b,c' || chr(10) || '  user: ' || user_id AS config,
       run = best_batch_run AS best_batch, run = best_perplexity_run AS best_perplexity,
       row_number() OVER (ORDER BY effective_batch DESC, run DESC) AS position FROM stats, best""",
)
def compare_runs(spark, sf_dir):
    compared = ops.compare_runs(sources.parse_run_stats(run_stats(spark, sf_dir)))
    return compared.withColumn("config", sources.argument_lines(F.col("args"))).drop("args")


def facts(spark, sf_dir):
    marks = run_markers(spark, sf_dir)
    stats = sources.parse_run_stats(run_stats(spark, sf_dir))
    owned = stats.join(marks.filter("has_stats").select("run"), "run", "left_semi")
    logs = ops.last_values(ops.parse_log(log_lines(spark, sf_dir)))
    return ops.run_facts(marks, marks.filter("has_pid"), owned, logs)


FACTS_SQL = f"""{LOG_SQL}, {LAST_SQL}, {STATS_SQL}, {MARKERS_SQL},
facts AS (SELECT run, has_pid, has_stats, CASE WHEN has_stats THEN batch_size END AS batch_size,
  CASE WHEN has_stats THEN perplexity END AS perplexity, found_batch, epoch, last.last_ts
  FROM markers JOIN stats USING (run) LEFT JOIN last USING (run))
"""


@query("run_status_join", f"WITH {FACTS_SQL} SELECT * FROM facts")
def run_status_join(spark, sf_dir):
    return facts(spark, sf_dir)


@query(
    "run_status",
    f"""WITH {FACTS_SQL},
state AS (SELECT *, CASE WHEN NOT has_pid THEN 'Unknown' WHEN last_ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 6 HOUR THEN 'Running'
  WHEN has_stats THEN 'Completed' ELSE 'Failed' END AS status FROM facts)
SELECT run, status, status || CASE status
  WHEN 'Running' THEN coalesce(' - Batch size: ' || found_batch, '') || coalesce(' - ' || epoch, '')
  WHEN 'Completed' THEN ' - Batch size: ' || batch_size || ', Perplexity: ' || perplexity ELSE '' END AS detail FROM state""",
)
def run_status(spark, sf_dir):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return ops.run_status(facts(spark, sf_dir), as_of, "INTERVAL 6 HOURS")


# What every run of the grid declares, and what a few declare otherwise. Written out here once more, apart
# from the operator's own table.
GRID_SQL = """
keys(key, value, switch) AS (VALUES
  ('train_test_split', '0.9', FALSE), ('learning_rate', '0.0002', FALSE), ('num_epochs', '3', FALSE), ('max_length', '512', FALSE),
  ('seed', '42', FALSE), ('start_batch_size', '1', FALSE), ('max_batch_size', '128', FALSE), ('safe_batch_size', '8', FALSE),
  ('base_grad_accum', '32', FALSE), ('flash_attention', 'true', TRUE), ('sdpa_attention', 'true', TRUE), ('lora_r', '8', FALSE),
  ('lora_alpha', '32', FALSE), ('lora_dropout', '0.1', FALSE), ('lora_target_modules', 'q_proj,k_proj,v_proj,o_proj', FALSE),
  ('load_in_4bit', 'true', TRUE), ('load_in_8bit', 'false', TRUE), ('use_fp16', 'true', TRUE), ('use_bf16', 'false', TRUE),
  ('compile_model', 'false', TRUE), ('use_gradient_checkpointing', 'true', TRUE), ('use_8bit_optimizer', 'true', TRUE),
  ('use_double_quant', 'true', TRUE), ('logging_steps', '10', FALSE), ('eval_steps', '100', FALSE), ('save_steps', '500', FALSE),
  ('save_total_limit', '1', FALSE), ('use_wandb', 'false', TRUE), ('wandb_project', 'llama-finetuning', FALSE), ('wandb_tags', '', FALSE)),
names(num, name) AS (VALUES (0, 'exp1_all_optimizations'), (1, 'exp2_lora_only'), (2, 'exp3_8bit_quantization'), (3, 'exp4_higher_lora_rank'),
  (4, 'exp5_bf16_precision'), (5, 'exp6_max_batch_size'), (6, 'exp7_higher_lr'), (7, 'exp8_different_modules')),
changes(num, key, value) AS (VALUES
  (1, 'load_in_4bit', 'false'), (1, 'use_8bit_optimizer', 'false'), (1, 'use_double_quant', 'false'),
  (2, 'load_in_4bit', 'false'), (2, 'load_in_8bit', 'true'), (2, 'use_double_quant', 'false'), (3, 'lora_r', '16'), (3, 'lora_alpha', '64'),
  (4, 'use_fp16', 'false'), (4, 'use_bf16', 'true'), (5, 'num_epochs', '1'), (5, 'start_batch_size', '16'), (5, 'max_batch_size', '256'),
  (5, 'safe_batch_size', '32'), (6, 'learning_rate', '0.0005'), (7, 'lora_target_modules', 'q_proj,v_proj')),
grid AS (
  SELECT num, name, key, coalesce(c.value, k.value) AS declared,
         CASE WHEN switch AND k.value = 'true' THEN 'true' ELSE coalesce(c.value, k.value) END AS effective
  FROM names CROSS JOIN keys k LEFT JOIN changes c USING (num, key))
"""


@query(
    "sweep_grid",
    f"""WITH {GRID_SQL},
used AS (SELECT user_id, user_id % 8 AS num, count(*) AS events FROM events GROUP BY user_id)
SELECT name, key, declared, effective, count(*) AS runs, CAST(sum(events) AS BIGINT) AS events
FROM used JOIN grid USING (num) GROUP BY ALL""",
)
def sweep_grid_query(spark, sf_dir):
    """Configuration values in use: every user is a run of one of the named configurations."""
    names = F.array(*[F.lit(name) for name in RUNS])
    used = (
        events(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("name", F.get(names, (F.col("user_id") % 8).cast("int")))
    )
    grid = sweep_grid(spark).select("name", "effective", F.explode("declared").alias("key", "declared"))
    values = grid.select("name", "key", "declared", F.col("effective")[F.col("key")].alias("effective"))
    by_name = used.groupBy("name").agg(F.count(F.lit(1)).alias("runs"), F.sum("events").alias("events"))
    return by_name.join(F.broadcast(values), "name").select("name", "key", "declared", "effective", "runs", "events")
