"""Toxicity by a convolutional text classifier, with thresholds calibrated by language.

A word is a run of letters and digits; its embedding is the sum of two rows of a hashed table, one for the word and one
for its first bytes. Filters of several widths run over the embeddings of a text, each keeps its largest value over the
whole text, and a logistic layer turns these into one logit. Embeddings, filters and layer are trained in numpy by
stochastic gradients on a bounded sample of labelled rows: the ``SAMPLE_ROWS`` / 2 of each label with the smallest
hashes, as far as their texts have up to ``TRAIN_BYTES`` bytes. Words met in fewer than ``LEAST_TEXTS`` of
them are unknown words, with an embedding of zeros; so are some of the others at each reading, so that not only the
strongest word of a text is learned from.

The language of a text is told by its words too (smoothed counts of the same sample), so nothing but the text goes into
a score. All labelled rows that are not held out, whatever their length, then calibrate the thresholds: per language the
logit at which labels are told apart best (F1), from one count by language, label and logit step; languages with fewer
than ``LEAST`` rows of either label share the threshold of all rows. A score is the logistic function of the logit less
the threshold, so 0.5 is the border in every language.

Every text is scored once, whole: long ones in stretches that overlap by a window. Only ids, logits and languages are
stored and joined with the labels.

Results for odd input: null, empty and wordless texts get the score of a text without known words. Rows are scored one
by one, copies alike up to rounding; every row of an id counts with every label row of that id, null labels and ids with none. Without
labels of both kinds every score is the share of label 1, or 0 without labels. A table without languages has the one
threshold. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import LOWER, SpanHasher, bounded_batches, pieces, scramble, store, stretches, utf8, word_spans

SAMPLE_ROWS = 6_000
TRAIN_BYTES = 1 << 14
BUCKETS = 1 << 15  # for words, and as many for their first bytes
HEAD = 4
EMBEDDING = 12
FILTERS = 8  # of each width
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
EPOCHS = 8
DROP = 0.4  # share of words left out at each reading
BATCH = 32
LEAST_TEXTS = 3  # of the sample that hold a known word
LEAST = 20
STEPS = 400  # logit steps of a tenth of a unit
SEED = 5
#: First column of each width and offset in the filters' matrix.
COLUMNS = {}
for _w in WIDTHS:
    for _j in range(_w):
        COLUMNS[_w, _j] = len(COLUMNS) * FILTERS


def buckets(body: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Two buckets of every word of some texts, and the number of words of each text."""
    body = LOWER[body]
    starts, ends, counts = word_spans(body, offsets, False)
    whole = (hasher(body, starts, ends) >> np.uint64(49)).astype(np.int32)
    code = np.zeros(len(starts), np.uint64)
    for j in range(HEAD):
        at = np.minimum(starts + j, len(body) - 1)
        code = (code << np.uint64(8)) | np.where(starts + j < ends, body[at], 0).astype(np.uint64)
    head = (scramble(code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int32) + BUCKETS
    return np.column_stack([whole, head]), counts


@dataclass
class ToxicityModel:
    """``share`` is the constant score of a model that could not be trained."""

    embedding: np.ndarray | None = None
    filters: np.ndarray | None = None
    bias: np.ndarray | None = None
    layer: np.ndarray | None = None
    shift: float = 0.0
    languages: list[str] = field(default_factory=list)
    words: np.ndarray | None = None
    share: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)  # -1 is the one of all rows
    facts: dict = field(default_factory=dict)

    def place(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embeddings of texts with rows of zeros after each, where each text starts, and which word each row is, or -1."""
        starts = np.cumsum(counts + PAD) - (counts + PAD)
        x = np.zeros((int(counts.sum()) + PAD * len(counts) + PAD, EMBEDDING), np.float32)
        at = np.arange(len(words)) + np.repeat(np.arange(len(counts)) * PAD, counts)
        x[at] = self.embedding[words[:, 0]] + self.embedding[words[:, 1]]
        source = np.full(len(x), -1)
        source[at] = np.arange(len(words))
        return x, starts, source

    def windows(self, x: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Values of all filters from each word on; 0, as of unknown words, in the rows after a text."""
        n, flat = len(x) - PAD, x @ self.filters
        parts = []
        for w in WIDTHS:
            part = flat[:n, COLUMNS[w, 0] : COLUMNS[w, 0] + FILTERS].copy()
            for j in range(1, w):
                part += flat[j : n + j, COLUMNS[w, j] : COLUMNS[w, j] + FILTERS]
            parts.append(part)
        values = np.hstack(parts)
        values[source[:n] < 0] = 0
        return values

    def pooled(self, words: np.ndarray, counts: np.ndarray, goes_on: bool = False) -> np.ndarray:
        """Largest values of each text; where it ``goes_on``, its last words are left to the next stretch."""
        x, starts, source = self.place(words, counts)
        if goes_on:
            source[source >= len(words) - PAD] = -1
        return np.maximum.reduceat(self.windows(x, source), starts) if len(counts) else np.zeros((0, FILTERS * len(WIDTHS)), np.float32)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0).astype(float) @ self.layer + self.shift

    def told(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Summed log shares of the words of each text, a column for each language."""
        total = np.zeros((len(counts), len(self.languages)))
        full = np.flatnonzero(counts)
        if len(full) and self.languages:
            rows = self.words[words[:, 0]] + self.words[words[:, 1]]
            total[full] = np.add.reduceat(rows, (np.cumsum(counts) - counts)[full])
        return total

    def predict(self, texts: pa.Array, hasher: SpanHasher, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Logit and number of the language of each text, -1 without a word."""
        body, offsets = utf8(texts)
        logit, language = np.zeros(len(texts)), np.full(len(texts), -1)
        for first, last in pieces(offsets, most):
            pooled = told = before = None
            for begin, end in stretches(body, offsets[first], offsets[last], most):
                at = np.clip(offsets[first : last + 1], begin, end) - begin
                words, counts = buckets(body[begin:end], at, hasher)
                here = self.told(words, counts)
                told = here if told is None else told + here
                if before is not None:  # further stretches of one text
                    words, counts = np.vstack([before, words]), counts + len(before)
                before = words[-PAD:]
                here = self.pooled(words, counts, end < offsets[last])
                pooled = here if pooled is None else np.maximum(pooled, here)
            logit[first:last] = self.logits(pooled)
            if self.languages:
                language[first:last] = np.where(told.any(1), told.argmax(1), -1)
        return logit, language

    def scores(self, logit: Column, language: Column) -> Column:
        """Column of scores."""
        if self.embedding is None:
            return F.lit(self.share)
        border = F.lit(self.thresholds.get(-1, 0.0))
        for number, value in self.thresholds.items():
            border = F.when(language == number, F.lit(value)).otherwise(border) if number >= 0 else border
        return 1 / (1 + F.exp(border - logit))


def fit(examples: list[tuple[int, str | None, np.ndarray]], epochs: int = EPOCHS, drop: float = DROP) -> ToxicityModel:
    """``examples`` are (label, language, buckets of the words); Adagrad over small batches."""
    labels = np.array([e[0] for e in examples], float)
    if len(set(labels)) < 2:
        return ToxicityModel(share=float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(SEED)
    held = np.zeros(2 * BUCKETS, np.int64)
    for _, _, words in examples:
        held[np.unique(words)] += 1
    known = held >= LEAST_TEXTS
    model = ToxicityModel(
        embedding=(rng.normal(0, 0.02, (2 * BUCKETS, EMBEDDING)) * known[:, None]).astype(np.float32),
        filters=rng.normal(0, 0.3, (EMBEDDING, len(COLUMNS) * FILTERS)).astype(np.float32),
        bias=np.zeros(FILTERS * len(WIDTHS)),
        layer=rng.normal(0, 0.3, FILTERS * len(WIDTHS)),
    )
    steps = {k: np.full(getattr(model, k).shape, 1e-6) for k in ("embedding", "filters", "bias", "layer")}

    def move(name: str, gradient: np.ndarray, rate: float, at=slice(None)) -> None:
        steps[name][at] += gradient * gradient
        getattr(model, name)[at] -= (rate * gradient / np.sqrt(steps[name][at])).astype(getattr(model, name).dtype)

    width = np.repeat(WIDTHS, FILTERS)
    column = np.concatenate([np.arange(FILTERS) for _ in WIDTHS])
    for epoch in range(epochs):
        rate = 0.05 * (1 - epoch / epochs)
        order = rng.permutation(len(examples))
        for first in range(0, len(order), BATCH):
            chosen = order[first : first + BATCH]
            words = np.concatenate([examples[i][2] for i in chosen])
            counts = np.array([len(examples[i][2]) for i in chosen])
            x, starts, source = model.place(words, counts)
            x[rng.random(len(x)) < drop] = 0
            values = model.windows(x, source)
            ends = np.append(starts[1:], len(values))
            top = np.array([values[a:b].argmax(0) + a for a, b in zip(starts, ends)])  # texts x filters
            pooled = np.take_along_axis(values, top, 0)
            active = np.maximum(pooled + model.bias, 0)
            wrong = (1 / (1 + np.exp(-(active @ model.layer + model.shift))) - labels[chosen]) / len(chosen)
            back = wrong[:, None] * model.layer * (active > 0)
            grown, filters = np.zeros(x.shape), np.zeros(model.filters.shape)
            for j in range(PAD + 1):
                use = width > j
                place = np.array([COLUMNS[w, j] for w in width[use]]) + column[use]
                rows = top[:, use] + j
                gone = back[:, use] * (source[top[:, use]] >= 0)
                np.add.at(filters.T, np.broadcast_to(place, rows.shape), x[rows] * gone[..., None])
                np.add.at(grown, rows, model.filters.T[place][None] * gone[..., None])
            moved = np.flatnonzero(grown.any(1) & (source >= 0))
            touched = words[source[moved]].ravel()
            touched, inverse = np.unique(touched, return_inverse=True)
            gradient = np.zeros((len(touched), EMBEDDING))
            np.add.at(gradient, inverse, np.repeat(grown[moved], 2, axis=0))
            use = known[touched]
            move("embedding", gradient[use], rate, touched[use])
            move("filters", filters + 1e-5 * model.filters, rate)
            move("layer", wrong @ active + 1e-4 * model.layer, rate)
            move("bias", back.sum(0), rate)
            model.shift -= rate * wrong.sum()
    model.languages = sorted({e[1] for e in examples if e[1] is not None})
    seen = np.ones((2 * BUCKETS, len(model.languages)))
    for _, language, words in examples:
        if language is not None:
            np.add.at(seen, (words.ravel(), model.languages.index(language)), 1)
    model.words = np.log(seen / seen.sum(0)).astype(np.float32)
    return model


# --- on tables -------------------------------------------------------------------------------------------------------


def held_out(doc_id: str) -> Column:
    """Rows whose crc32 of the id as text leaves 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _known(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """``(id, label)`` of the rows that labels may be learned from."""
    rows = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & ~held_out(doc_id))
    return rows.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        body, offsets = utf8(batch.column(0))
        words, counts = buckets(body, offsets, hasher)
        lists = pa.ListArray.from_arrays(pa.array(2 * np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(words.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), lists], names=["label", "lang", "words"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    train_bytes: int = TRAIN_BYTES,
) -> ToxicityModel:
    """Fit on the bounded sample; the driver gets buckets of its words, never texts."""
    known = _known(labels, doc_id, label).distinct()
    order = [F.xxhash64("id", "label"), F.col("id")]
    one, two = (known.filter(F.col("label") == y).orderBy(*order).limit(sample_rows // 2) for y in (0, 1))
    own = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    texts = bounded_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), own.alias("lang"))
    rows = (
        texts.filter(F.octet_length("text") <= train_bytes)
        .join(F.broadcast(one.unionByName(two)), "id")  # at most sample_rows ids
        .select("text", "label", "lang")
        .mapInArrow(_words, "label int, lang string, words array<int>")
        .toArrow()
    )
    lists = rows["words"].combine_chunks()
    flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    examples = [
        (y, l, flat[a:b].reshape(-1, 2))
        for y, l, a, b in zip(rows["label"].to_pylist(), rows["lang"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist())
    ]
    examples.sort(key=lambda e: (e[0], e[1] or "", len(e[2]), e[2][:32].tolist(), int(e[2].sum())))
    return fit(examples)


def predictor(model: ToxicityModel):
    """Column function ``text -> struct(logit, language)``, evaluated in Arrow batches."""

    @F.arrow_udf("struct<logit:double,language:int>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = SpanHasher()
        for texts in batches:
            logit, language = model.predict(texts, hasher)
            yield pa.StructArray.from_arrays([pa.array(logit), pa.array(language, pa.int32())], names=["logit", "language"])

    return predict


def _best(counts: np.ndarray) -> float:
    """Logit at which the two labels (rows: clean, toxic; columns: steps) are told apart best; the middle, if many are."""
    caught = np.append(np.cumsum(counts[1][::-1])[::-1], 0)
    blamed = np.append(np.cumsum(counts[0][::-1])[::-1], 0)
    f1 = 2 * caught / np.maximum(caught + blamed + counts[1].sum(), 1)
    at = np.flatnonzero(f1 == f1.max())
    return (at[0] + at[-1]) / 2 / 10 - STEPS / 20


def calibrate(model: ToxicityModel, found: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> None:
    """Set the thresholds from ``found`` ``(id, logit, language)`` and all labels that may be learned from."""
    if model.embedding is None:
        return
    step = F.least(F.greatest(F.floor(F.col("logit") * 10) + STEPS // 2, F.lit(0)), F.lit(STEPS - 1)).cast("int")
    rows = found.filter(F.col("id").isNotNull()).join(_known(labels, doc_id, label), "id")
    counted = rows.groupBy("language", "label", step.alias("step")).count().toArrow().to_pylist()  # bounded by the steps
    table = np.zeros((len(model.languages) + 1, 2, STEPS), np.int64)
    for r in counted:
        table[r["language"], r["label"], r["step"]] += r["count"]  # -1 is the last
    model.thresholds = {-1: _best(table.sum(0))}
    for i in range(len(model.languages)):
        if table[i].sum(1).min() >= LEAST:
            model.thresholds[i] = _best(table[i])


def toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", lang: str | None = "lang", doc_id: str = "doc_id", label: str = "toxic"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, lang_pred)`` of every document."""
    model = train(docs, labels, text, lang, doc_id, label)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    if model.embedding is None:
        found = texts.select("id", F.lit(0.0).alias("logit"), F.lit(-1).alias("language"))
    else:
        found = texts.select("id", predictor(model)(F.col("text")).alias("found")).select("id", "found.*")
    found, _ = store(found, "toxicity")
    calibrate(model, found, labels, doc_id, label)
    score = model.scores(F.col("logit"), F.col("language"))
    names = F.array(*[F.lit(x) for x in model.languages]).cast("array<string>")
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.get(names, F.col("language")).alias("lang_pred"),
    )
