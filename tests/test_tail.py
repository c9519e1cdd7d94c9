import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import runs as ops
from textloom.sources import runs as sources
from textloom.sources.tail import LogTailReader, tail_logs
from textloom.streaming import streams


def append(folder, name, data):
    os.makedirs(os.path.join(folder, "logs"), exist_ok=True)
    with open(os.path.join(folder, "logs", name), "ab") as file:
        file.write(data)


def trigger(spark, folder, number):
    """One run of the query from its checkpoint, as after a restart; the lines it brought."""
    lines = tail_logs(spark, f"file:{folder}/logs", block_bytes=64).withColumn("trigger", F.lit(number))
    streams.run_available(lines, f"{folder}/out", f"{folder}/state").awaitTermination()
    new = spark.read.parquet(f"{folder}/out").filter(F.col("trigger") == number)
    return sorted((r.file_name, r.position, r.line) for r in new.collect())


def test_appended_lines_arrive_once_and_half_lines_wait(spark, folder):
    append(folder, "a_gpu0.log", b"one\ntwo\nhal")
    append(folder, "other.txt", b"no\n")
    assert trigger(spark, folder, 1) == [("a_gpu0.log", 0, "one"), ("a_gpu0.log", 4, "two")]
    append(folder, "a_gpu0.log", b"f\r\n\n\xff\xc3\xa4\n")
    append(folder, "b_gpu1.log", b"new\n")
    assert trigger(spark, folder, 2) == [("a_gpu0.log", 8, "half"), ("a_gpu0.log", 14, ""), ("a_gpu0.log", 15, "�ä"), ("b_gpu1.log", 0, "new")]
    assert trigger(spark, folder, 3) == []
    append(folder, "b_gpu1.log", b"".join(b"line %d %s\n" % (i, b"x" * (i % 150)) for i in range(200)))
    got = trigger(spark, folder, 4)
    assert [line for _, _, line in got] == [f"line {i} {'x' * (i % 150)}" for i in range(200)]
    valid = F.is_valid_utf8("line") & ~F.col("line").contains("\ufffd")
    seen = spark.read.parquet(f"{folder}/out").filter(valid).select("file_name", "line")
    whole = sources.read_logs(spark, f"{folder}/logs").filter(valid).select("file_name", "line")
    assert seen.count() == 205
    assert seen.exceptAll(whole).count() == 0 and whole.exceptAll(seen).count() == 0


def test_a_file_started_anew_is_read_from_its_start(spark, folder):
    append(folder, "a.log", b"old line one\nold line two\n")
    assert len(trigger(spark, folder, 1)) == 2
    os.truncate(os.path.join(folder, "logs", "a.log"), 0)
    append(folder, "a.log", b"anew\n")
    assert trigger(spark, folder, 2) == [("a.log", 0, "anew")]


def test_tailed_lines_parse_like_read_ones(spark, folder):
    stamp = "2024-01-01 00:00:0{} - INFO - "
    append(folder, "r_gpu0.log", (stamp.format(1) + "Batch size 8 works!\n" + stamp.format(2) + "GPU Memory").encode())
    trigger(spark, folder, 1)
    append(folder, "r_gpu0.log", b" Usage: GPU 0: 5MB/10MB (50.0%)\n")
    trigger(spark, folder, 2)
    tailed = spark.read.parquet(f"{folder}/out").select(sources.run_of_log(F.col("file_name")).alias("run"), F.col("position").alias("line_no"), "line")
    read = sources.read_logs(spark, f"{folder}/logs").select(sources.run_of_log(F.col("file_name")).alias("run"), "line_no", "line")
    parsed = [sorted((r.run, r.event, r.batch_size, r.device) for r in ops.parse_log(x).collect()) for x in (tailed, read)]
    assert parsed[0] == parsed[1] and len(parsed[0]) == 2


@pytest.mark.parametrize("block", [1, 3, 7, 50, 10_000])
def test_blocks_of_any_size_hold_each_line_once(folder, block):
    raw = b"".join(b"%d%s\n" % (i, b"y" * (i * 7 % 23)) for i in range(60)) + b"rest"
    append(folder, "a.log", raw)
    reader = LogTailReader(f"{folder}/logs", "*.log", block)
    end = reader.latestOffset()
    assert end == {"a.log": len(raw) - 4}
    for start in ({}, {"a.log": raw.index(b"\n20") + 1}):
        rows = [b for span in reader.partitions(start, end) for b in reader.read(span)]
        table = pa.Table.from_batches(rows).to_pydict()
        since = start.get("a.log", 0)
        assert table["line"] == raw[since:-4].decode().split("\n")[:-1]
        assert all(raw[p:].startswith(line.encode() + b"\n") for p, line in zip(table["position"], table["line"]))
    assert reader.partitions(end, end) == []
