"""Registered streaming queries; each runs over the available input and returns the stored result."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.session import work_path
from textloom.sources.tail import tail_logs
from textloom.streaming import streams
from textloom.streaming.live import live_status as live
from textloom.tables import load

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table_stream(spark, sf_dir, name):
    """A table as a stream, whether it is one file or a folder of files."""
    path, schema = f"{sf_dir}/{name}.parquet", load(spark, sf_dir, name).schema
    if streams.is_folder(spark, path):
        return streams.file_stream(spark, path, schema, "*")
    return streams.file_stream(spark, sf_dir, schema, f"{name}.parquet")


@query(
    "stream_ingest",
    "SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS text_md5 FROM documents WHERE length(text) >= 500",
)
def stream_ingest(spark, sf_dir):
    out = work_path(spark, "ingest")
    running = streams.stream_ingest(table_stream(spark, sf_dir, "documents"), f"{out}/data", f"{out}/checkpoint")
    stored = streams.finish(running, lambda: spark.read.parquet(f"{out}/data"))
    return stored.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "stream_usage",
    """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(user_id % 8 AS INTEGER) AS device, value FROM events)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, device, count(*) AS samples, max(value) AS peak_used,
       round(avg(value), 6) AS mean_used,
       window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts) - INTERVAL 10 MINUTE) FROM events) AS closed
FROM w GROUP BY ALL""",
)
def stream_usage(spark, sf_dir):
    """All windows; those the watermark has passed are closed."""
    out = work_path(spark, "usage")
    session = streams.state_session(spark)
    session.conf.set("spark.sql.session.timeZone", "UTC")  # the table's times have no zone
    samples = table_stream(session, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 8).cast("int").alias("device"), F.col("value").alias("used")
    )
    running = streams.stream_usage(samples, f"{out}/data", f"{out}/checkpoint")
    stored = streams.finish(running, lambda: streams.current_usage(session, f"{out}/data"))
    return stored.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "device",
        "samples",
        "peak_used",
        F.round("mean_used", 6).alias("mean_used"),
        "closed",
    )


@query(
    "stream_status",
    """SELECT event_type AS run, count(*) AS events, max(event_id) AS event_id, arg_max(ts, event_id) AS ts,
       arg_max(value, event_id) AS value FROM events GROUP BY event_type""",
)
def stream_status(spark, sf_dir):
    out = work_path(spark, "status")
    events = table_stream(streams.state_session(spark), sf_dir, "events").withColumn("run", F.col("event_type"))
    latest = streams.latest_per_run(events, F.col("event_id"), "event_id", "ts", "value")
    running = streams.stream_status(latest, f"{out}/data", f"{out}/checkpoint")
    return streams.finish(running, lambda: streams.current_status(spark, f"{out}/data"))


@query(
    "log_tail",
    """SELECT event_id, ts AS logged_at, CASE WHEN event_id <= (SELECT max(event_id) // 2 FROM events) THEN 1 ELSE 2 END AS trigger,
       row_number() OVER (ORDER BY event_id) AS position FROM events""",
)
def log_tail(spark, sf_dir):
    """Events written as logs in two halves with a trigger after each: every line arrives once, in its half and place."""
    out = work_path(spark, "tail")
    line = F.concat_ws(" ", F.col("event_id").cast("string"), F.col("ts").cast("string"))
    events = load(spark, sf_dir, "events")
    middle = F.floor(events.agg(F.max("event_id")).scalar() / 2)
    for trigger, half in ((1, F.col("event_id") <= middle), (2, F.col("event_id") > middle)):
        events.filter(half).orderBy("event_id").select(line.alias("value")).write.mode("append").text(f"{out}/logs")
        lines = tail_logs(spark, f"{out}/logs", "*.txt").withColumn("trigger", F.lit(trigger))
        streams.run_available(lines, f"{out}/lines", f"{out}/checkpoint").awaitTermination()
    lines = spark.read.parquet(f"{out}/lines")
    sizes = lines.groupBy("trigger", "path").agg(F.count(F.lit(1)).alias("n"))  # one row per writing task
    before = sizes.select("trigger", "path", (F.sum("n").over(Window.orderBy("trigger", "path")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("trigger", "path").orderBy("position"))
    fields = F.split("line", " ", 2)
    return lines.withColumn("place", place).join(before, ["trigger", "path"]).select(
        fields[0].cast("bigint").alias("event_id"),
        fields[1].cast("timestamp_ntz").alias("logged_at"),
        "trigger",
        (F.col("before") + F.col("place")).alias("position"),
    )


@query(
    "live_status",
    """WITH f AS (SELECT 'run_' || user_id AS run, bool_or(value > 60) AS has_pid, bool_or(event_type = 'purchase') AS has_stats,
                  date_trunc('millisecond', max(ts)) AS last_ts FROM events GROUP BY user_id),
m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT run, CASE WHEN NOT has_pid THEN 'Unknown' WHEN last_ts + INTERVAL 6 HOUR >= mark THEN 'Running'
                 WHEN has_stats THEN 'Completed' ELSE 'Failed' END AS status, has_pid, has_stats, last_ts
FROM f, m""",
)
def live_status(spark, sf_dir):
    """Every event as a line of its user's run, some with its marker or statistics; runs end by timers at the watermark."""
    out = work_path(spark, "live")
    session = streams.timer_session(spark)
    lines = table_stream(session, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_type"
    )
    changed = live(lines, 6 * 3600, "10 minutes", F.col("value") > 60, F.col("event_type") == "purchase")
    running = streams.stream_status(changed, f"{out}/data", f"{out}/checkpoint")
    stored = streams.finish(running, lambda: streams.current_status(session, f"{out}/data"))
    return stored.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))


@query(
    "ingest_once",
    "SELECT DISTINCT md5(text) AS digest, length(text) AS n_chars FROM documents WHERE length(text) >= 500",
)
def ingest_once(spark, sf_dir):
    """Different texts of all documents, dated by the trigger that reads them: files may have no time, or an old one."""
    out = work_path(spark, "once")
    arriving = table_stream(streams.state_session(spark), sf_dir, "documents").withColumn("arrived", F.current_timestamp())
    running = streams.ingest_once(arriving, f"{out}/data", f"{out}/checkpoint")
    return streams.finish(running, lambda: spark.read.parquet(f"{out}/data")).select("digest", "n_chars")
