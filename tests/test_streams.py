import os
from datetime import datetime, timedelta
from hashlib import md5

from pyspark.sql import functions as F

from textloom.operators import runs as ops
from textloom.plans import streams as plans
from textloom.streaming import streams
from textloom.streaming.live import live_status

DOCS = "doc_id long, text string"
EVENTS = "run string, event_id long, ts timestamp, device int, used double"


def put(spark, folder, rows, schema, name):
    frame = spark.createDataFrame(rows, schema)
    if "ts" in frame.columns:
        frame = frame.withColumn("ts", F.col("ts").cast("timestamp"))
    frame.coalesce(1).write.parquet(os.path.join(folder, "staging", name))
    source = os.path.join(folder, "in")
    os.makedirs(source, exist_ok=True)
    staged = os.path.join(folder, "staging", name)
    part = next(p for p in os.listdir(staged) if p.endswith(".parquet"))
    os.link(os.path.join(staged, part), os.path.join(source, name + ".parquet"))
    return source


def test_ingest_reads_each_file_once(spark, folder):
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")
    for i, rows in enumerate([[(1, "x" * 9), (2, "x")], [(3, "x" * 9)], []]):
        source = put(spark, folder, rows, DOCS, f"f{i}") if rows else os.path.join(folder, "in")
        stream = streams.file_stream(spark, source, spark.createDataFrame([], DOCS).schema)
        stored = streams.finish(streams.stream_ingest(stream, out, state, 5), lambda: spark.read.parquet(out))
        assert sorted(r.doc_id for r in stored.collect()) == ([1], [1, 3], [1, 3])[i]


def test_usage_drops_late_rows_and_keeps_open_windows(spark, folder):
    schema = EVENTS.replace("timestamp", "string")
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")

    def run(source):
        stream = streams.file_stream(streams.state_session(spark), source, spark.createDataFrame([], EVENTS).schema)
        query = streams.stream_usage(stream, out, state)
        return streams.finish(query, lambda: streams.current_usage(spark, out)).collect()

    first = [("r", 1, "2024-01-01 00:10:00", 0, 5.0), ("r", 2, "2024-01-01 00:20:00", 0, 7.0), ("r", 3, "2024-01-01 02:00:00", 0, 1.0)]
    got = run(put(spark, folder, first, schema, "a"))
    assert sorted((r.window_start.hour, r.samples, r.mean_used, r.closed) for r in got) == [(0, 2, 6.0, True), (2, 1, 1.0, False)]
    late = [("r", 4, "2024-01-01 00:30:00", 0, 99.0), ("r", 5, "2024-01-01 04:00:00", 0, 2.0)]
    got = run(put(spark, folder, late, schema, "b"))
    assert sorted((r.window_start.hour, r.samples, r.peak_used, r.closed) for r in got) == [(0, 2, 7.0, True), (2, 1, 1.0, True), (4, 1, 2.0, False)]
    assert len([d for d in os.listdir(out) if d.startswith("version=")]) <= 2


def test_status_stays_current(spark, folder):
    schema = EVENTS.replace("timestamp", "string")
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")

    def run(source):
        stream = streams.file_stream(streams.state_session(spark), source, spark.createDataFrame([], EVENTS).schema)
        latest = streams.latest_per_run(stream, F.col("event_id"), "event_id", "used")
        query = streams.stream_status(latest, out, state)
        return streams.finish(query, lambda: streams.current_status(spark, out)).collect()

    got = run(put(spark, folder, [("a", 1, "2024-01-01 00:00:00", 0, 5.0), ("b", 2, "2024-01-01 00:00:00", 0, 6.0)], schema, "a"))
    assert sorted((r.run, r.events, r.used) for r in got) == [("a", 1, 5.0), ("b", 1, 6.0)]
    got = run(put(spark, folder, [("a", 7, "2024-01-01 00:00:00", 0, 9.0), ("a", 3, "2024-01-01 00:00:00", 0, 1.0)], schema, "b"))
    assert sorted((r.run, r.events, r.used) for r in got) == [("a", 3, 9.0), ("b", 1, 6.0)]
    for i, name in enumerate("cde"):
        got = run(put(spark, folder, [("a", 10 + i, "2024-01-01 00:00:00", 0, 1.0 * i)], schema, name))
    assert sorted((r.run, r.events, r.used) for r in got) == [("a", 6, 2.0), ("b", 1, 6.0)]
    assert len([d for d in os.listdir(out) if d.startswith("version=")]) == 2


def test_a_silent_run_ends_by_its_timer(spark, folder):
    """After each restart the table equals the batch status at the watermark."""
    schema = "run string, event_id long, ts string, device int, used double"
    start, seen = datetime(2024, 1, 1), []
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")
    steps = [
        [("a", 0, 1), ("b", 0, 1), ("c", 1, 0), ("d", 2, 3)],  # run, minute, bits: 1 marker, 2 statistics
        [("d", 40, 0), ("b", 41, 2)],
        [("d", 300, 0)],
        [("c", 301, 1), ("e", 330, 1)],
        [("e", 700, 0)],
    ]
    told = set()
    for i, rows in enumerate(steps):
        seen += [(r, start + timedelta(minutes=m), bits) for r, m, bits in rows]
        source = put(spark, folder, [(r, i, str(start + timedelta(minutes=m)), bits, 0.0) for r, m, bits in rows], schema, f"s{i}")
        session = streams.timer_session(spark)
        lines = streams.file_stream(session, source, spark.createDataFrame([], EVENTS).schema)
        has = lambda bit: F.col("device").bitwiseAND(F.lit(bit)) != 0
        query = streams.stream_status(live_status(lines, 3600, "5 minutes", has(1), has(2)), out, state)
        got = {r.run: r.status for r in streams.finish(query, lambda: streams.current_status(session, out)).collect()}
        mark = max(t for _, t, _ in seen) - timedelta(minutes=5)
        facts = [
            (r, any(x & 1 for q, _, x in seen if q == r), any(x & 2 for q, _, x in seen if q == r), max(t for q, t, _ in seen if q == r))
            for r in {r for r, _, _ in seen}
        ]
        facts = spark.createDataFrame(facts, "run string, has_pid boolean, has_stats boolean, last_ts timestamp_ntz")
        for name in ("found_batch", "epoch", "batch_size", "perplexity"):
            facts = facts.withColumn(name, F.lit(None).cast("string"))
        batch = ops.run_status(facts, F.lit(mark).cast("timestamp_ntz"), "INTERVAL 60 MINUTES")
        assert got == {r.run: r.status for r in batch.collect()}
        told |= set(got.values())
    assert told == {"Unknown", "Running", "Completed", "Failed"}


def test_a_text_is_ingested_once_across_files_and_restarts(spark, folder):
    schema = "doc_id long, text string, arrived timestamp"
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")
    day = datetime(2024, 1, 1)
    steps = [
        ([(1, "a" * 9, day), (2, "a" * 9, day), (3, "b" * 9, day), (4, "short", day), (5, None, day)], {"a", "b"}),
        ([(6, "a" * 9, day + timedelta(days=1)), (7, "c" * 9, day + timedelta(days=1))], {"c"}),
        ([(8, "d" * 9, day + timedelta(days=30))], {"d"}),
        ([(9, "a" * 9, day + timedelta(days=31)), (10, "d" * 9, day + timedelta(days=31))], {"a"}),  # forgotten, remembered
    ]
    before = 0
    for i, (rows, new) in enumerate(steps):
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.parquet(os.path.join(folder, "staging", f"o{i}"))
        source = os.path.join(folder, "in")
        os.makedirs(source, exist_ok=True)
        part = next(p for p in os.listdir(os.path.join(folder, "staging", f"o{i}")) if p.endswith(".parquet"))
        os.link(os.path.join(folder, "staging", f"o{i}", part), os.path.join(source, f"o{i}.parquet"))
        stream = streams.file_stream(streams.state_session(spark), source, frame.schema)
        stored = streams.finish(streams.ingest_once(stream, out, state, 6), lambda: spark.read.parquet(out)).collect()
        assert len(stored) == before + len(new)
        before = len(stored)
        assert new <= {r.text[0] for r in stored}


def stored_table(spark, folder):
    """Documents as a folder of three files, named unlike the table."""
    rows = [(1, "en", "a" * 600), (2, "de", "b" * 600), (3, "en", "a" * 600), (4, "en", "short"), (5, None, None), (5, "fr", "c" * 500)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("n_chars", F.length("text").cast("long"))
    frame.repartition(3).write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def test_stream_ingest_of_a_table_in_many_files(spark, folder):
    got = plans.stream_ingest(spark, stored_table(spark, folder)).collect()
    assert sorted((r.doc_id, r.lang, r.n_chars) for r in got) == [(1, "en", 600), (2, "de", 600), (3, "en", 600), (5, "fr", 500)]


def test_ingest_once_of_a_table_in_many_files(spark, folder):
    got = plans.ingest_once(spark, stored_table(spark, folder)).collect()
    assert sorted((r.digest, r.n_chars) for r in got) == sorted((md5((c * n).encode()).hexdigest(), n) for c, n in (("a", 600), ("b", 600), ("c", 500)))


def test_ingest_once_of_files_without_a_time(spark, folder):
    table = os.path.join(stored_table(spark, folder), "documents.parquet")
    for name in os.listdir(table):
        os.utime(os.path.join(table, name), (0, 0))
    got = plans.ingest_once(spark, folder).collect()
    assert sorted((r.digest, r.n_chars) for r in got) == sorted((md5((c * n).encode()).hexdigest(), n) for c, n in (("a", 600), ("b", 600), ("c", 500)))


def test_texts_dated_by_their_trigger_are_ingested_once_across_restarts(spark, folder):
    out, state = os.path.join(folder, "out"), os.path.join(folder, "state")
    schema = spark.createDataFrame([], DOCS).schema
    for i, (rows, texts) in enumerate([([(1, "a" * 9), (2, "a" * 9)], "a"), ([(3, "a" * 9), (4, "b" * 9)], "ab"), ([(5, "c" * 9), (6, "b" * 9)], "abc")]):
        source = put(spark, folder, rows, DOCS, f"t{i}")
        stream = streams.file_stream(streams.state_session(spark), source, schema).withColumn("arrived", F.current_timestamp())
        stored = streams.finish(streams.ingest_once(stream, out, state, 5), lambda: spark.read.parquet(out))
        assert sorted(r.text[0] for r in stored.collect()) == list(texts)
