import os

import pytest
from pyspark.sql import functions as F

from textloom.sources import snapshots

SCHEMA = "path string, part int, digest string"


def write(spark, folder, name, rows):
    path = os.path.join(folder, name)
    snapshots.write_snapshot(spark.createDataFrame(rows, SCHEMA).repartition(3), ["path", "part"], "digest", path)
    return path


@pytest.mark.parametrize("touched", [0, 1, 7, 2_000])
def test_equals_a_full_outer_join(spark, folder, touched):
    old = {(f"/in/{i}", i % 3): f"d{i}" for i in range(2_000)}
    new = dict(old)
    for i in range(touched):
        kind, key = i % 3, (f"/in/{i}", i % 3)
        if kind == 0:
            new[key] = "other"
        elif kind == 1:
            del new[key]
        else:
            new[f"/in/new{i}", 0] = None
    paths = [write(spark, folder, n, [(*k, d) for k, d in rows.items()]) for n, rows in (("old", old), ("new", new))]
    got = {(r.path, r.part): r.change for r in snapshots.snapshot_diff(spark, *paths, ["path", "part"]).collect()}
    want = {k: "new" if k not in old else "removed" if k not in new else "changed" for k in old.keys() | new.keys() if old.get(k, 0) != new.get(k, 0)}
    assert got == want
    branches, leaves = snapshots.changed_buckets(spark, *paths)
    assert len(branches) <= touched and leaves.count() <= touched and (touched == 0) == (not branches)


def test_only_partitions_of_differing_branches_are_read(spark, folder):
    rows = [(f"/in/{i}", 0, "d") for i in range(3_000)]
    paths = [write(spark, folder, "old", rows), write(spark, folder, "new", [*rows[1:], ("/in/0", 0, "e")])]
    diff = snapshots.snapshot_diff(spark, *paths, ["path", "part"])
    assert [(r.path, r.change) for r in diff.collect()] == [("/in/0", "changed")]
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(branch") in (2, 4)  # of the final and the initial plan
    files = {f.split("branch=")[1][:2] for f in diff.inputFiles() if "branch=" in f}
    read = spark.read.parquet(f"{paths[0]}/rows").filter(F.col("branch").isin(snapshots.changed_buckets(spark, *paths)[0]))
    assert read.count() < 60 and len(files) >= 1


def test_empty_snapshots(spark, folder):
    paths = [write(spark, folder, "old", []), write(spark, folder, "new", [("/in/a", 0, "d")])]
    got = snapshots.snapshot_diff(spark, *paths, ["path", "part"]).collect()
    assert [(r.path, r.change) for r in got] == [("/in/a", "new")]
    assert [r.change for r in snapshots.snapshot_diff(spark, *paths[::-1], ["path", "part"]).collect()] == ["removed"]
    assert snapshots.snapshot_diff(spark, paths[0], paths[0], ["path", "part"]).count() == 0
