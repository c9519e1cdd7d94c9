import zlib

import helpers
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.llm import plans, toxicity
from textloom.llm.common import SpanHasher

SF = "/root/testdata/sf0.01"
BAD = {"xx": ["grobl", "fiesk", "murzt"], "yy": ["ulumi", "awako", "oneti"]}
OF = {"xx": "kala mola tula neki soru veki lamo tiko".split(), "yy": "zwrt brzk strn plch gdrt krsz wrzs zdrb".split()}


def example(r, lang, bad, words=None):
    text = list(r.choice(OF[lang], words or int(r.integers(5, 60))))
    for _ in range(2 * bad):
        text.insert(int(r.integers(0, len(text) + 1)), r.choice(BAD[lang]))
    return " ".join(text)


def corpus(n=600):
    r = np.random.default_rng(4)
    return [(i, example(r, ("xx", "yy")[i % 2], i % 5 == 0), ("xx", "yy")[i % 2], int(i % 5 == 0)) for i in range(n)]


def tables(spark, rows):
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")


def fitted(rows):
    hasher = SpanHasher()
    examples = []
    for _, text, lang, label in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        examples.append((label, lang, toxicity.buckets(raw, np.array([0, len(raw)]), hasher)[0]))
    return toxicity.fit(examples)


def slow_logit(model, text):
    """One window after another."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words, _ = toxicity.buckets(raw, np.array([0, len(raw)]), SpanHasher())
    x = [model.embedding[a] + model.embedding[b] for a, b in words] + [np.zeros(toxicity.EMBEDDING)] * toxicity.PAD
    pooled = []
    for w in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            weights = [model.filters[:, toxicity.COLUMNS[w, j] + f] for j in range(w)]
            pooled.append(max([0] + [sum(float(x[i + j] @ weights[j]) for j in range(w)) for i in range(len(words))]))
    return float(np.maximum(np.array(pooled) + model.bias, 0) @ model.layer + model.shift)


def test_logits_equal_single_windows_in_any_batch():
    rows = corpus(200)
    model, hasher = fitted(rows), SpanHasher()
    texts = [t for _, t, _, _ in rows[:15]] + [None, "", "!!", "ä", "GROBL fiesk"] + [" ".join(t for _, t, _, _ in rows)]
    logit, language = model.predict(pa.array(texts), hasher)
    for i, text in enumerate(texts):
        assert abs(logit[i] - slow_logit(model, text or "")) < 2e-3
        alone = model.predict(pa.array([text], pa.string()), hasher, most=300)  # in many stretches
        assert abs(alone[0][0] - logit[i]) < 2e-3 and alone[1][0] == language[i]


def test_gradients_lower_the_loss_and_held_out_rows_are_told(spark):
    rows = corpus(1_500)
    docs, labels = tables(spark, rows)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    want = {r[0]: r for r in rows}
    assert len(got) == len(rows)
    held = [i for i in got if got[i].held_out]
    assert set(held) == {i for i in want if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([got[i].predicted == want[i][3] for i in held]) > 0.98
    assert np.mean([got[i].lang_pred == want[i][2] for i in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_and_other_columns_play_no_part(spark):
    rows = corpus(300)
    docs, labels = tables(spark, rows)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.when(toxicity.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    names = ("doc_id", "score", "predicted", "lang_pred")
    assert helpers.rows_of(toxicity.toxicity(docs, labels), *names) == helpers.rows_of(toxicity.toxicity(other, turned), *names)


def test_thresholds_are_the_best_of_their_language():
    r = np.random.default_rng(1)
    for _ in range(20):
        counts = np.zeros((2, toxicity.STEPS), np.int64)
        clean, bad = r.integers(100, 200, 50), r.integers(150, 260, 20)
        np.add.at(counts, (0, clean), 1)
        np.add.at(counts, (1, bad), 1)

        def f1(step):
            caught = (bad >= step).sum()
            return 2 * caught / ((clean >= step).sum() + caught + len(bad))

        step = (toxicity._best(counts) + toxicity.STEPS / 20) * 10
        assert f1(np.ceil(step)) >= max(f1(s) for s in range(toxicity.STEPS)) - 1e-12


def test_odd_rows_clashing_columns_and_missing_labels(spark):
    docs = helpers.odd_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(None, 1, 1), (3, None, 2), (5, 7, 3), (4, 0, 0), (4, 0, 0)], "doc_id long, toxic int, score int")
    got = toxicity.toxicity(docs, labels)
    assert got.count() == docs.count() and got.filter("score is null or predicted is null or held_out is null").count() == 0
    unknown = [r.score for r in got.join(docs.filter("text is null or text = ''").select("doc_id").distinct(), "doc_id").collect()]
    assert max(unknown) - min(unknown) < 1e-9
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.filter("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity(helpers.no_docs(spark), labels).count() == 0
    assert toxicity.toxicity(docs.drop("lang"), labels, lang=None).count() == docs.count()


def test_held_out_rows_of_the_table(spark):
    got = plans.QUERIES["op13_toxicity"](spark, SF)
    assert got.count() == plans.table(spark, SF, "documents").count()
    rows = got.join(plans.table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    scores, truth = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert np.mean((scores >= 0.5) == truth) > 0.93
    assert np.mean([a > b for a in scores[truth == 1] for b in scores[truth == 0]]) > 0.85
