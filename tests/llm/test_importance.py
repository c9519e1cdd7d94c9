import collections
import math
import random

import helpers
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.llm import importance, plans
from textloom.llm.common import SpanHasher

SF = "/root/testdata/sf0.01"


def buckets(text):
    hasher = SpanHasher()
    return [b for _, _, bucket, _ in importance.text_buckets(pa.array([text]), hasher) for b in bucket.tolist()]


def test_log_weight_is_the_sum_of_log_ratios(spark):
    texts = [helpers.prose(i, 5 + 3 * i) for i in range(12)] + ["", "a", "a!! b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    got = {r.doc_id: r for r in importance.resample(docs, labels, F.col("quality") == 1, k=5).collect()}
    raw, target = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        raw.update(buckets(t))
        if i < 8 and i % 2:
            target.update(buckets(t))
    scale = sum(target.values()) / sum(raw.values())
    for i, t in enumerate(texts):
        logs = [math.log((target[b] + 4) / (raw[b] * scale + 4)) for b in buckets(t)]
        want = sum(math.copysign(max(abs(x) - 0.35, 0), x) for x in logs) / max(len(logs), 1) * 200
        assert math.isclose(got[i].log_weight, want, abs_tol=1e-6)
    best = sorted(got.values(), key=lambda r: -r.gumbel_key)[:5]
    assert {r.doc_id for r in got.values() if r.kept} == {r.doc_id for r in best}


def test_kth_largest(spark):
    r = random.Random(3)
    for values in ([1.0], [2.0] * 50, [r.gauss(0, 1) for _ in range(3_000)], [5.0, 5.0, 1e300, -1e300, 5.0000000001, 0.0], [math.exp(r.gauss(0, 20)) for _ in range(500)]):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        for k in {1, 2, len(values) // 2 or 1, len(values)} & set(range(1, len(values) + 1)):
            assert importance.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_draws_follow_the_weights(spark):
    """Drawing one of three rows by its noisy weight, over many seeds, meets the probabilities."""
    weights = np.array([0.6, 0.3, 0.1])
    rows = spark.createDataFrame([(i,) for i in range(3)], "doc_id long")
    keys = [importance.gumbel("doc_id", s).alias(f"s{s}") for s in range(1_500)]
    noise = np.array([list(r) for r in rows.orderBy("doc_id").select(*keys).collect()])
    picks = (noise + np.log(weights)[:, None]).argmax(axis=0)
    assert np.abs(np.bincount(picks, minlength=3) / 1_500 - weights).max() < 0.05


INSULTS = "trash pathetic idiot disgusting worthless stupid clown loser scum moron".split()


def test_toxic_and_junk_rows_go_and_clean_rows_stay(spark):
    """Labels of documents that the target does not hold."""
    sf = "/root/testdata/sf0.1"
    docs, labels = plans.table(spark, sf, "documents"), plans.table(spark, sf, "labels")
    used = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    found = importance.resample(docs, used, (F.col("quality") == 1) & (F.col("toxic") == 0))
    text = F.col("text").rlike(r"(?i)\b(" + "|".join(INSULTS) + r")\b")
    rest = labels.join(used, "doc_id", "left_anti").join(docs.select("doc_id", text.alias("insults")), "doc_id")
    rows = rest.join(found, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.toxic]
    toxic = [r.kept for r in rows if r.toxic and r.insults]
    junk = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.88 and np.mean(toxic) < 0.2 and np.mean(junk) < 0.05
    kept = plans.QUERIES["op1_importance"](spark, SF)
    assert 0 < kept.count() < 1_000 and kept.filter("not kept").count() == 0


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = helpers.odd_docs(spark)
    got = importance.resample(docs, labels, F.col("quality") == 1)
    assert got.count() == docs.count()
    assert all(r.log_weight == 0 for r in got.collect() if r.doc_id in (0, 1, 2, 5 + 300))
    none = importance.resample(docs, labels.limit(0), F.col("quality") == 1)
    assert none.filter("kept").count() == docs.count()
    assert importance.resample(helpers.no_docs(spark), labels, F.col("quality") == 1).count() == 0
    assert importance.resample(docs, labels, F.col("quality") == 1, k=0).filter("kept").count() == 0
