import os

import pytest
from pyspark.sql import functions as F

from textloom.functions import records
from textloom.operators import runs as ops
from textloom.operators.sweep import sweep_grid
from textloom.sources import runs as sources

#: Invented: one message or more of every kind.
MESSAGES = """Arguments:
  rate: 0.5
  labels:
Found 40 source files
Error on page 3 of /in/my doc.src: torn
Extracted text too short for /in/b.src
Successfully processed /out/c.txt
Error processing /in/d.src: no memory
GPU Memory Usage: GPU 1: 4.0MB/2000.0MB (0.2%)
RAM Usage: 3.5GB/64.0GB (5.5%)
Step 1: Reading texts...
Training on 36 files, testing on 4 files
Cache not found, starting over
Loading raw text dataset from cache
Train dataset size: 500 samples
Eval dataset size: 60 samples
Step 2: Looking for a batch size...
Initial search range: 3 to 12
Testing a safe batch size of 4 first
Safe batch size 4 works! Going on...
Batch size 4 works!
Trying batch size: 8 with gradient accumulation steps: 4
OOM error at batch size 8
Trying batch size: 6 with gradient accumulation steps: 5
Batch size 6 works!
Trying batch size: 7 with gradient accumulation steps: 4
Error at batch size 7: CUDA gone
Trying batch size: 7 with gradient accumulation steps: 4
OOM error at batch size 7
Maximum batch size found: 6
Final evaluation metrics: {'eval_loss': 1.25, 'epoch': 2.0}
Training complete in 1h 2m 3s!
Maximum batch size: 6
Gradient accumulation steps: 5
Final perplexity: 3.49""".split("\n")
#: One message a second, but for two lines that belong to the record above them.
UNTIMED = ["GPU Memory Usage: GPU 0: 8.0MB/2000.0MB (0.4%), GPU 1: 990.0MB/2000.0MB (49.5%)", "Epoch 2/5"]
LOG = [f"2031-07-09 04:{i // 60:02d}:{i % 60:02d},{i % 10}00 - {'WARNING' if 'rror' in m else 'INFO'} - {m}" for i, m in enumerate(MESSAGES)]
LOG = [line if " -   " not in line else line.split(" - ", 2)[2] for line in LOG] + ["2031-07-09 05:00:00,250 - INFO - "] + UNTIMED


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame([("r", i + 1, line) for i, line in enumerate(LOG)], "run string, line_no long, line string")
    return ops.parse_log(lines).cache()


def rows(parsed, event):
    return parsed.filter(F.col("event") == event).orderBy("line_no").collect()


def test_log_grammar(parsed):
    assert [(r.name, r.value) for r in rows(parsed, "argument")] == [("rate", "0.5"), ("labels", "")]
    assert [(r.kind, r.page, r.path, r.files) for r in rows(parsed, "extract")] == [
        ("found", None, None, 40),
        ("page_error", 3, "/in/my doc.src", None),
        ("too_short", None, "/in/b.src", None),
        ("processed", None, "/out/c.txt", None),
        ("file_error", None, "/in/d.src", None),
    ]
    assert [(r.device, r.used, r.total, r.pct) for r in rows(parsed, "gpu")][0] == (1, 4.0, 2000.0, 0.2)
    assert [(r.used, r.total, r.pct, r.device) for r in rows(parsed, "ram")] == [(3.5, 64.0, 5.5, None)]
    assert [(r.first_count, r.second_count) for r in rows(parsed, "split") + rows(parsed, "range")] == [(36, 4), (3, 12)]
    assert [(r.stage, r.title) for r in rows(parsed, "stage")] == [(1, "Reading texts..."), (2, "Looking for a batch size...")]
    assert [(r.dataset, r.first_count) for r in rows(parsed, "size")] == [("train", 500), ("eval", 60)]
    assert [r.cache_hit for r in rows(parsed, "cache")] == [False, True]
    assert [(r.batch_size, r.grad_accum) for r in rows(parsed, "probe")] == [(8, 4), (6, 5), (7, 4), (7, 4)]
    assert rows(parsed, "eval")[0].metrics["eval_loss"] == 1.25
    final = rows(parsed, "final")
    assert [r.seconds for r in final] == [3723, None, None, None]
    assert [r.batch_size for r in final] == [None, 6, None, None]
    assert final[2].grad_accum == 5 and final[3].perplexity == 3.49
    assert rows(parsed, "extract")[1].level == "WARNING"
    assert parsed.filter("event is null").filter("result is not null").count() == 0


def test_lines_without_time_inherit(parsed):
    gpu = rows(parsed, "gpu")[1]
    assert str(gpu.ts) == "2031-07-09 05:00:00.250000" and gpu.level == "INFO"
    assert rows(parsed, "epoch")[0].epoch == "Epoch 2/5"
    assert str(rows(parsed, "argument")[1].ts) == "2031-07-09 04:00:00"


def test_devices_of_one_line_and_usage(parsed):
    samples = ops.hardware_samples(parsed)
    peaks = {(r.kind, r.device): r for r in ops.hardware_usage(samples, "run", "kind", "device").collect()}
    assert set(peaks) == {("gpu", 0), ("gpu", 1), ("ram", None)}
    assert peaks["gpu", 1].peak_used == 990.0 and peaks["gpu", 1].peak_percent == 49
    assert str(peaks["gpu", 1].peak_ts) == "2031-07-09 05:00:00.250000"


def test_search_trace(parsed):
    """The safe size is one trial although reported twice; a size that fails twice is two."""
    attempts = ops.trials(parsed)
    trace = [(r.batch_size, r.result) for r in attempts.orderBy("seq").collect()]
    assert trace == [(4, "success"), (8, "oom"), (6, "success"), (7, "fail"), (7, "oom")]
    frontier = ops.trial_frontier(attempts).first()
    assert (frontier.largest_success, frontier.smallest_failure, frontier.ooms, frontier.trials) == (6, 7, 2, 5)
    assert frontier.seconds == pytest.approx(8.9)
    bounds = [(r.lower, r.upper) for r in ops.search_bounds(attempts.drop("ts"), 3, 12).orderBy("seq").collect()]
    assert bounds == [(3, 12), (5, 12), (5, 7), (7, 7), (7, 6)]


@pytest.mark.parametrize("golden", [[(2, "success"), (17, "success"), (25, "oom"), (21, "oom"), (19, "success"), (20, "oom")]])
def test_search_of_the_published_run(spark, golden):
    """Sizes tried between 2 and 32, a fixed value: the range closes on 19."""
    attempts = spark.createDataFrame([("r", i, b, r) for i, (b, r) in enumerate(golden)], "run string, seq long, batch_size int, result string")
    ends = [(r.lower, r.upper) for r in ops.search_bounds(attempts, 2, 32).orderBy("seq").collect()]
    assert ends == [(2, 32), (3, 32), (18, 32), (18, 24), (18, 20), (20, 20)]


def test_ordinary_line_before_the_safe_one_stays(spark):
    text = ["Batch size 8 works!", "Safe batch size 8 works! Going on...", "Safe batch size 9 failed. Using batch size 1", "Error at batch size 9: x"]
    frame = spark.createDataFrame([("r", i, f"2031-07-09 04:00:0{i},000 - INFO - {t}") for i, t in enumerate(text)], "run string, line_no long, line string")
    found = [(r.seq, r.batch_size, r.result) for r in ops.trials(ops.parse_log(frame)).orderBy("seq").collect()]
    assert found == [(0, 8, "success"), (1, 8, "success"), (2, 9, "fail")]


def test_elapsed(parsed):
    spans = {r.stage: r.seconds for r in ops.elapsed(parsed).collect()}
    assert spans[None] == pytest.approx(3600.25) and spans[1] == pytest.approx(6.6)
    assert spans[2] == pytest.approx(3600.25 - 16.6)


def test_last_values(parsed):
    last = ops.last_values(parsed).first()
    assert (last.found_batch, last.epoch) == (6, "Epoch 2/5")


def test_read_logs_in_blocks(spark, folder):
    """A file read in many blocks keeps its line numbers."""
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    for run in ("a", "b_gpu9", "my run 5%+1"):
        with open(os.path.join(folder, f"{run}_gpu0.log"), "w") as f:
            f.write("\n".join(f"{run} {line}" for line in lines) + "\n")
    with open(os.path.join(folder, "c.txt"), "w") as f:
        f.write("not a log\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = sources.read_logs(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for run in ("a", "b_gpu9", "my run 5%+1"):
        mine = sorted((r.line_no, r.line) for r in got if r.file_name == f"{run}_gpu0.log")
        assert mine == [(i + 1, f"{run} {line}") for i, line in enumerate(lines)]
    named = spark.createDataFrame([(r.path, r.file_name) for r in got], "path string, file_name string").distinct()
    runs = spark.createDataFrame([("a",), ("b",), ("b_gpu9",), ("c",)], "run string")
    assert named.filter("file_name = 'my run 5%+1_gpu0.log'").count() == 1
    matched = {r.run: r.log_path and os.path.basename(r.log_path) for r in sources.match_logs(runs, named).collect()}
    assert matched == {"a": "a_gpu0.log", "b": "b_gpu9_gpu0.log", "b_gpu9": "b_gpu9_gpu0.log", "c": None}
    assert named.select(sources.run_of_log(F.col("file_name")).alias("r")).filter("r = 'a'").count() == 1


STATS = """Training completed at: 2031-07-09 05:00:00
Maximum batch size: {b}
Gradient accumulation steps: 1
Effective batch size: {b}
Final perplexity: {p}
Total training time: 0h 50m 1s

Arguments:
  seed: 41
  path: /a: b
  seed: 42
"""


@pytest.fixture
def stats(spark, folder):
    for name, b, p in [("one", 12, 9.25), ("my run 5%+1", 12, 6.5), ("three", 4, 6.5), ("broken", "x", "")]:
        os.mkdir(os.path.join(folder, name))
        with open(os.path.join(folder, name, "training_stats.txt"), "w") as f:
            f.write(STATS.format(b=b, p=p))
    os.makedirs(os.path.join(folder, "empty", "deep"))
    with open(os.path.join(folder, "empty", "deep", "training_stats.txt"), "w") as f:
        f.write(STATS.format(b=1, p=1))
    with open(os.path.join(folder, "one", "process_pid.txt"), "w") as f:
        f.write("1")
    return sources.read_run_stats(spark, folder)


def test_stats_files(stats):
    parsed = {r.run: r for r in stats.collect()}
    assert set(parsed) == {"one", "my run 5%+1", "three", "broken"}
    assert parsed["one"].batch_size == 12 and parsed["one"].perplexity == 9.25
    assert str(parsed["one"].completed_at) == "2031-07-09 05:00:00"
    assert parsed["one"].args == {"seed": "42", "path": "/a: b"}
    assert parsed["broken"].batch_size is None and parsed["broken"].perplexity is None


def test_no_run_has_finished(spark, folder):
    os.mkdir(os.path.join(folder, "run"))
    assert sources.read_run_stats(spark, folder).count() == 0


def test_markers(spark, folder, stats):
    marks = {r.run: (r.has_pid, r.has_stats) for r in sources.owned_markers(spark, folder).filter("run <> 'deep'").collect()}
    assert marks == {"one": (True, True), "my run 5%+1": (False, True), "three": (False, True), "broken": (False, True)}


def test_stats_round_trip(spark, stats):
    body = sources.stats_text(
        F.col("completed_at"), F.col("batch_size"), F.col("grad_accum"), F.col("perplexity"), F.lit(3001.5), F.col("args")
    )
    good = stats.filter("run <> 'broken'")
    again = sources.parse_run_stats(good.select("run", body.alias("body")))
    assert sorted(map(str, again.collect())) == sorted(map(str, good.collect()))


def test_ranking_and_best(stats):
    good = stats.filter("run <> 'broken'")
    assert [r.run for r in ops.rank_runs(good).orderBy("position").collect()] == ["one", "my run 5%+1", "three"]
    assert tuple(ops.best_run(good).first()) == ("one", 12, "my run 5%+1", 6.5)
    marks = {r.run: (r.best_batch, r.best_perplexity) for r in ops.compare_runs(good).collect()}
    assert marks == {"one": (True, False), "my run 5%+1": (False, True), "three": (False, False)}


def test_summary(stats, spark, folder):
    path = os.path.join(folder, "summary")
    sources.write_summary(stats.filter("run in ('one', 'broken')"), path)
    text = {r.summary.split("\n")[0]: r.summary for r in sources.read_summary(spark, path).collect()}
    assert set(text) == {"run = one", "run = broken"}
    assert "\neffective_batch = 12\n" in text["run = one"] and "\n  path: /a: b\n  seed: 42" in text["run = one"]
    assert "perplexity" not in text["run = broken"]


def test_status_precedence(spark):
    schema = "run string, has_pid boolean, has_stats boolean, batch_size int, perplexity double, found_batch int, epoch string, last_ts string"
    frame = spark.createDataFrame(
        [
            ("unknown", False, True, 1, 1.0, 1, None, "2024-01-30 00:00:00"),
            ("running", True, True, 1, 1.0, 11, "Epoch 1/3", "2024-01-29 23:55:00"),
            ("bare", True, False, None, None, None, None, "2024-01-30 00:00:00"),
            ("completed", True, True, 11, 4.5, 11, None, "2024-01-29 00:00:00"),
            ("failed", True, False, None, None, 3, None, "2024-01-29 00:00:00"),
            ("silent", True, False, None, None, None, None, None),
        ],
        schema,
    ).withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))
    got = {r.run: r.detail for r in ops.run_status(frame, F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")).collect()}
    assert got == {
        "unknown": "Unknown",
        "running": "Running - Batch size: 11 - Epoch 1/3",
        "bare": "Running",
        "completed": "Completed - Batch size: 11, Perplexity: 4.5",
        "failed": "Failed",
        "silent": "Failed",
    }


def test_grid_declares_and_takes_effect(spark):
    grid = {r.name: r for r in sweep_grid(spark).collect()}
    assert len(grid) == 8
    adapter = grid["exp2_lora_only"]
    assert adapter.declared["load_in_4bit"] == "false" and adapter.effective["load_in_4bit"] == "true"
    assert grid["exp3_8bit_quantization"].effective["load_in_8bit"] == "true"
    assert grid["exp6_max_batch_size"].declared["max_batch_size"] == "256"
    assert grid["exp1_all_optimizations"].declared == grid["exp1_all_optimizations"].effective


def test_classify_and_prefix(spark):
    frame = spark.createDataFrame([("CUDA out of memory. x",), ("not enough memory",), ("boom",), (None,)], "m string")
    assert [r.c for r in frame.select(records.classify_error(F.col("m")).alias("c")).collect()] == ["oom", "oom", "fail", "success"]
    metrics = spark.range(1).select(records.prefix_metrics(F.create_map(F.lit("loss"), F.lit(1.0)), "eval").alias("m"))
    assert metrics.first().m == {"eval/loss": 1.0}


def test_integer_percent_of_large_amounts(spark):
    from textloom.functions.numbers import percent_floor

    amount = 9_007_199_254_740_993
    row = spark.range(1).select(percent_floor(F.lit(amount), F.lit(100)).alias("a"), percent_floor(F.lit(995), F.lit(1000)).alias("b")).first()
    assert (row.a, row.b) == (amount, 99)


def test_weighted_perplexity(spark):
    frame = spark.createDataFrame([("a", 2.0, 8.0), ("a", 4.0, 2.0)], "g string, loss double, weight double")
    assert ops.perplexity(frame, "g").first().perplexity == pytest.approx(2.718281828**2.4, abs=1e-5)


def test_missing_loss_stays_missing(spark):
    frame = spark.createDataFrame([(1.0, None)], "loss double, eval_loss double")
    row = ops.row_perplexity(frame).first()
    assert row.pplx == pytest.approx(2.718281828) and row.eval_pplx is None


def test_tail(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("run"), F.col("id").alias("line_no"))
    assert sorted(r.line_no for r in ops.tail_per_run(frame).collect()) == list(range(85, 100))
