"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is the bag of its hashed subwords, the three and four byte windows of its lower-cased words with one
boundary byte on either side. The mean of their embeddings goes through a linear layer and a softmax. Both
layers are trained in numpy by stochastic gradient descent on a bounded, hash-ordered sample of labelled rows
(``SAMPLE_ROWS``); their product is one small table, and a prediction is a gather and a sum over the whole text.

A temperature fitted on rows kept out of the training turns the softmax into a calibrated score. A text is
rejected when it has no letter or when its score lies below the threshold that rejects at most
``reject_rate`` of the labelled rows with a letter that are neither held out nor learned from. All of them are
scored for that, in one pass that counts scores by steps of 1 / ``SCORE_STEPS``.

Results for odd input: null, empty and letterless texts are ``und`` with score 0 and are rejected. Copies get
equal results. A table without any label gives a model without classes: every text is ``und``. Long texts are
read whole. Columns of the table stay as they are; the results go to columns the caller names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, free_name, pieces, utf8

UNKNOWN = "und"
SAMPLE_ROWS = 3_000
BUCKETS = 1 << 15  # per window size
WINDOWS = (3, 4)
FACTORS = (2_654_435_761, 2_246_822_519)
EMBEDDING = 16
SCORE_STEPS = 1 << 10  # the highest step ends at 1, so that scores close to 1 are never told apart
SEED = 7

#: Letters in lower case, bytes beyond ASCII as they are, all else a boundary.
NORMAL = np.full(256, 0x20, np.uint8)
NORMAL[0x80:] = np.arange(0x80, 0x100)
for _c in range(ord("a"), ord("z") + 1):
    NORMAL[_c] = NORMAL[_c - 32] = _c


def subwords(body: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the window whose second byte is each byte, one array per window size; -1 where there is none.

    Every text has a boundary byte of its own before its first and after its last byte.
    """
    n = len(body)
    wide = np.full(n + 4, 0x20, np.uint32)
    wide[1 : n + 1] = NORMAL[body]
    filled = offsets[1:] > offsets[:-1]
    starts, ends = offsets[:-1][filled], offsets[1:][filled]
    for k, (size, factor) in enumerate(zip(WINDOWS, FACTORS)):
        code = np.zeros(n, np.uint32)
        good = np.ones(n, bool)
        for j in range(size):
            at = wide[j : n + j].copy()
            if j == 0:
                at[starts] = 0x20  # the byte before each text
            for back in range(1, j):  # the bytes after each text
                at[np.maximum(ends - back, starts)] = 0x20
            code |= at << np.uint32(8 * j)
            if 0 < j < size - 1:
                good &= at != 0x20
        for back in range(1, size - 2):  # windows that go beyond the byte after their text
            good[np.maximum(ends - back, starts)] = False
        bucket = ((code * np.uint32(factor)) >> np.uint32(17)).astype(np.int64) + k * BUCKETS
        yield np.where(good, bucket, -1)


@dataclass
class LanguageModel:
    """``table`` is embedding times weights, with a last row of zeros for "no window"."""

    classes: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    facts: dict = field(default_factory=dict)

    def logits(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text: the summed table rows over the number of windows, plus the bias."""
        rows = len(offsets) - 1
        total, windows = np.zeros((rows, len(self.classes))), np.zeros(rows)
        real = np.flatnonzero(offsets[1:] > offsets[:-1])
        if len(real):
            for bucket in subwords(body, offsets):
                windows[real] += np.add.reduceat(bucket >= 0, offsets[:-1][real], dtype=np.int64)
                for c in range(len(self.classes)):
                    total[real, c] += np.add.reduceat(self.table[:, c][bucket], offsets[:-1][real])
        return total / np.maximum(windows, 1)[:, None] + self.bias

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Best class and calibrated score of each text."""
        body, offsets = utf8(texts)
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for first, last in pieces(offsets):
            at = offsets[first : last + 1]
            p = softmax(self.logits(body[at[0] : at[-1]], at - at[0]) / self.temperature)
            best[first:last], score[first:last] = p.argmax(1), p.max(1)
        return best, score


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(doc_id: str) -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each labelled text, and of one short stretch of it, with their shares, as bytes."""
    for batch in batches:
        body, offsets = utf8(batch.column(0))
        out = []
        for i, label in enumerate(batch.column(1).to_pylist()):
            text = body[offsets[i] : offsets[i + 1]]
            size = 16 + (len(text) * 31) % 200
            at = (len(text) * 7919) % max(len(text) - size, 1)
            for short, part in ((False, text), (True, text[at : at + size])):
                bucket = np.concatenate([b[b >= 0] for b in subwords(part, np.array([0, len(part)]))])
                if len(bucket):
                    index, count = np.unique(bucket, return_counts=True)
                    out.append((label, short, index.astype("<u2").tobytes(), (count / count.sum()).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else ([],) * 4, EXAMPLE_TYPES)],
            names=["label", "short", "bucket", "share"],
        )


EXAMPLE_TYPES = (pa.string(), pa.bool_(), pa.binary(), pa.binary())


def _smallest(known: DataFrame, sample_rows: int) -> DataFrame:
    """Rows ``(id, label, at)`` that hold the ``sample_rows`` smallest ``at`` of each label, and about as many more.

    Rows are counted by label and bit length of the hash, so a label of any size is at most 64 counts.
    """
    bits = F.length(F.bin("at"))
    sizes = known.groupBy("label", bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("label").orderBy("bits").rowsBetween(Window.unboundedPreceding, -1))
    last = sizes.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < sample_rows)
    last = last.groupBy("label").agg(F.max("bits").alias("last"))
    # a row per class; broadcast by hint, or the rows would be dealt by label before they are bounded
    return known.join(F.broadcast(last), "label").filter(bits <= F.col("last")).select("id", "label", "at")


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    doc_id: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    reject_rate: float = 0.001,
    epochs: int = 4,
) -> LanguageModel:
    """Fit on at most ``sample_rows`` labelled rows that are not held out, the same number of each label.

    Only ids and labels are read to choose them: counts by label and bit length of a hash bound the rows that can be
    chosen, and only those meet in a window. The driver gets buckets of the sample and counts of scores, never texts.
    """
    order = F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string"), F.col(label)), 1)
    known = docs.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(
        F.col(doc_id).alias("id"), F.col(label).alias("label"), order.alias("at")
    )
    turn = F.row_number().over(Window.partitionBy("label").orderBy("at", "id"))
    chosen = _smallest(known, sample_rows).withColumn("turn", turn).filter(F.col("turn") <= sample_rows).orderBy("turn", "at", "id")
    chosen = chosen.limit(sample_rows).select("id").distinct()
    labelled = (
        bounded_batches(docs).filter(F.col(label).isNotNull() & F.col(text).isNotNull())
        .select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), F.col(doc_id).alias("id"))
    )
    rows = (
        labelled.join(F.broadcast(chosen), "id", "left_semi")  # at most sample_rows ids
        .select("text", "label")
        .mapInArrow(_examples, "label string, short boolean, bucket binary, share binary")
        .toArrow()
    )
    examples = [  # views of the Arrow buffers
        (label.as_py(), short.as_py(), np.frombuffer(bucket.as_buffer(), "<u2"), np.frombuffer(share.as_buffer(), "<f4"))
        for label, short, bucket, share in zip(*rows.columns)
        if bucket.is_valid
    ]
    examples.sort(key=lambda e: (e[0], e[1], len(e[2]), e[2][:32].tolist(), e[3][:32].tolist()))
    model, kept_out = _fit(examples, epochs)
    del examples, rows
    pa.default_memory_pool().release_unused()
    if model.classes:
        others = labelled.filter(F.col("id").isNotNull() & ~held_out("id") & _letters("text"))
        others = others.join(F.broadcast(chosen), "id", "left_anti")
        model.threshold = _threshold(model, others, kept_out, reject_rate)
    return model


def _letters(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def _threshold(model: LanguageModel, others: DataFrame, kept_out: np.ndarray, reject_rate: float) -> float:
    """Largest step that at most ``reject_rate`` of the scores of ``others`` and ``kept_out`` lie below."""
    top = SCORE_STEPS - 1
    step = F.least(F.floor(predictor(model)(F.col("text"))["score"] * SCORE_STEPS), F.lit(top)).cast("int")
    counted = others.select(step.alias("step")).groupBy("step").count().toArrow()  # at most SCORE_STEPS rows
    counts = np.bincount(np.minimum((kept_out * SCORE_STEPS).astype(np.int64), top), minlength=SCORE_STEPS)
    counts[counted["step"].to_numpy()] += counted["count"].to_numpy()
    model.facts["calibration_rows"] = int(counts.sum())
    steps = np.flatnonzero(counts)
    below = np.cumsum(counts[steps]) - counts[steps]
    return float(steps[below <= reject_rate * counts.sum()][-1]) / SCORE_STEPS


def _fit(examples: list, epochs: int) -> tuple[LanguageModel, np.ndarray]:
    """Model without a threshold, and the scores of the whole texts kept out of its training."""
    classes = sorted({e[0] for e in examples})
    size = BUCKETS * len(WINDOWS)
    if not classes:
        return LanguageModel([], np.zeros((size + 1, 0), np.float32), np.zeros(0)), np.zeros(0)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(examples))
    kept_out, used = order[: len(order) // 5], order[len(order) // 5 :]
    target = np.array([classes.index(e[0]) for e in examples])
    embedding = np.zeros((size, EMBEDDING))
    weights, bias = rng.normal(0, 1 / np.sqrt(EMBEDDING), (EMBEDDING, len(classes))), np.zeros(len(classes))
    steps, done = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            rate, done = 1.0 - done / steps, done + 1
            bucket, part = examples[i][2], examples[i][3].astype(float)
            hidden = part @ embedding[bucket]
            wrong = softmax((hidden @ weights + bias)[None])[0]
            wrong[target[i]] -= 1
            back = weights @ wrong
            weights -= 0.1 * rate * np.outer(hidden, wrong)
            bias -= 0.01 * rate * wrong
            embedding[bucket] -= 20.0 * rate * part[:, None] * back  # averaged inputs need a large step
    table = np.zeros((size + 1, len(classes)), np.float32)
    table[:-1] = embedding @ weights
    model = LanguageModel(classes, np.asfortranarray(table), bias)
    whole = [i for i in (kept_out if len(kept_out) else order) if not examples[i][1]] or list(order)
    logits = np.array([examples[i][3].astype(float) @ table[examples[i][2]] + bias for i in whole])
    truth = target[whole]
    tries = np.exp(np.linspace(np.log(0.05), np.log(20), 60))
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tries]
    model.temperature = float(tries[int(np.argmin(loss))])
    p = softmax(logits / model.temperature)
    model.facts = {"examples": len(examples), "kept_out_accuracy": float((p.argmax(1) == truth).mean())}
    return model, p.max(1)


def predictor(model: LanguageModel):
    """Column function ``text -> struct(lang, score)``, evaluated in Arrow batches."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array(model.classes, dtype=object)
        for texts in batches:
            best, score = model.predict(texts)
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score)], names=["lang", "score"]
            )

    return predict


def identify(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    lang: str = "lang_pred",
    score: str = "score",
    rejected: str = "rejected",
) -> DataFrame:
    """Add language, calibrated score and rejection; columns of these names are replaced."""
    if not model.classes:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0), rejected: F.lit(True)})
    found = predictor(model)(F.col(text))
    kept = F.when(_letters(text), found)  # evaluated once: the struct is a column of its own below
    name = free_name(docs, "found")
    return (
        docs.withColumn(name, kept)
        .withColumns(
            {
                lang: F.coalesce(F.col(f"{name}.lang"), F.lit(UNKNOWN)),
                score: F.coalesce(F.col(f"{name}.score"), F.lit(0.0)),
                rejected: F.coalesce(F.col(f"{name}.score") < model.threshold, F.lit(True)),
            }
        )
        .drop(name)
    )


def accepted(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The documents whose language is told, with all their columns as they were."""
    model = train(docs, text, label, doc_id)
    own, lang, score, gone = (free_name(docs, name) for name in ("own_text", "lang", "score", "rejected"))
    flagged = identify(docs.withColumn(own, F.col(text)), model, own, lang, score, gone)
    return flagged.filter(~F.col(gone)).select(*docs.columns)
