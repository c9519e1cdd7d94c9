"""Token ids in ORC: sorted by document, with row indexes and Bloom filters on the id.

Texts are dealt by ranges of the document id and sorted inside each range, encoded in Arrow batches, and written
with Spark's ORC writer: integer run-length encoding for the ids, row-index entries of ``ROW_INDEX`` rows, a Bloom
filter on the document id per entry, stripes that tasks read in parallel. A lookup of one document is pruned by
the statistics and the filter; a scan splits at stripes.

Encoding: the byte-level BPE vocabulary cuts a text into words before it merges, and equal words get equal ids.
So a batch is cut into words with array operations, every distinct word of the batch goes through the library's
model once per worker, and the ids are put together by position. The cut is exact for ASCII, accented Latin
letters and common typographic marks; a text with anything else, or one whose hashed words do not compare equal
byte by byte, goes through the library as a whole. Strings of special tokens are recognised as the library does
by default.

Results for odd input: a null or empty text is the end id alone. Null ids come first. Repeated rows are all
written, in the order of their texts. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import SpanHasher, bounded_batches, pieces, utf8, worker_store
from textloom.session import work_path

END = 0
ROW_INDEX = 1_000
STRIPE_BYTES = 16 << 20
KNOWN_WORDS = 300_000  # words a worker remembers, in two tables
BATCH_BYTES = 2 << 20

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("local_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)

#: Kinds of bytes for the cut into words: 0 blank, 1 letter, 2 digit, 3 other, 9 not handled here.
KINDS = np.full(256, 9, np.uint8)
KINDS[:0x80] = 3
KINDS[0x1C:0x20] = 9  # libraries differ on whether these are blank
for _c in b"\t\n\x0b\x0c\r ":
    KINDS[_c] = 0
for _c in b"0123456789":
    KINDS[_c] = 2
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
    KINDS[_c] = 1
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")  # fixed values: the vocabulary's own cut


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes without one follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_kinds(body: np.ndarray) -> np.ndarray:
    """Kind of each byte; all bytes of a character get the character's kind."""
    kind = KINDS[body]
    lead = np.flatnonzero(body == 0xC3)  # U+00C0 to U+00FF: letters but for the two signs
    lead = lead[lead + 1 < len(body)]
    after = body[lead + 1]
    kind[lead] = kind[lead + 1] = np.where((after == 0x97) | (after == 0xB7), 3, 1)
    lead = np.flatnonzero(body == 0xE2)  # U+2010 to U+2027: dashes, quotes, bullets, dots
    lead = lead[lead + 2 < len(body)]
    lead = lead[(body[lead + 1] == 0x80) & (body[lead + 2] >= 0x90) & (body[lead + 2] <= 0xA7)]
    kind[lead] = kind[lead + 1] = kind[lead + 2] = 3
    return kind


def word_starts(body: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the vocabulary's pattern starts a new word; right for texts without kind 9."""
    n = len(body)
    cut = np.ones(n + 1, bool)
    cut[1:n] = kind[1:] != kind[:-1]
    cut[offsets] = True
    first_of_text = np.zeros(n + 1, bool)
    first_of_text[offsets] = True
    runs = np.flatnonzero(cut)
    starts, ends = runs[:-1], runs[1:]
    # a blank run before visible text gives its last character away: a space joins what follows
    blank = (kind[starts] == 0) & ~first_of_text[ends] if len(starts) else np.zeros(0, bool)
    last = ends[blank] - 1
    cut[last] = True
    space = body[last] == 0x20
    cut[ends[blank][space]] = False
    # an apostrophe alone, not joined to a space, takes the contraction that follows
    mark = np.flatnonzero(body == 0x27)
    mark = mark[cut[mark] & cut[mark + 1]]
    for at in mark.tolist():
        if at + 1 < n and not first_of_text[at + 1] and kind[at + 1] == 1:
            for tail in CONTRACTIONS:
                end = at + 1 + len(tail)
                if body[at + 1 : end].tobytes() == tail and not first_of_text[at + 2 : end].any():
                    cut[at + 1] = False
                    cut[end] = True
                    break
    cut[n] = True
    return np.flatnonzero(cut[:n])


class WordTable:
    """Ids of the words a worker has met: a number per word, and the ids of all numbers in one array."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids, self.filled = np.zeros(1 << 18, np.int32), 0

    def add(self, word: bytes, ids: Sequence[int]) -> None:
        n, end = len(self.number), self.filled + len(ids)
        if n == len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * n), np.resize(self.size, 2 * n)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.begin[n], self.size[n] = self.filled, len(ids)
        self.ids[self.filled : end] = ids
        self.filled, self.number[word] = end, n


class Encoder:
    """Encodes Arrow batches with a byte-level vocabulary of the tokenizers library; one per task."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.kept = worker_store(f"tokenizer {path}")
        if not self.kept:
            self.kept |= {"library": Tokenizer.from_file(path), "words": WordTable(), "older": WordTable()}
        self.library = self.kept["library"]
        self.model, self.letters = self.library.model, byte_letters()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.hasher = SpanHasher(BATCH_BYTES)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.int32)

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, WordTable]:
        """Number of each word in the worker's table; unknown words go through the library's model.

        A full table becomes the older one, from which words still in use are taken over as they come.
        """
        if len(self.kept["words"].number) >= KNOWN_WORDS // 2:
            self.kept |= {"older": self.kept["words"], "words": WordTable()}
        table, older = self.kept["words"], self.kept["older"]
        for word in {w for w in words if w not in table.number}:
            n = older.number.get(word)
            if n is not None:
                table.add(word, older.ids[older.begin[n] : older.begin[n] + older.size[n]])
            else:
                found = self.model.tokenize(word.decode("latin-1").translate(self.letters))
                table.add(word, [t.id for t in found])
        return np.fromiter(map(table.number.__getitem__, words), np.int64, len(words)), table

    def __call__(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in a row, and the number of ids of each text."""
        rows, raw = len(offsets) - 1, body.tobytes()
        kind = byte_kinds(body)
        odd = np.zeros(rows, bool)  # texts for the library as a whole

        def mark(places) -> None:
            odd[np.searchsorted(offsets, places, side="right") - 1] = True

        mark(np.flatnonzero(kind == 9))
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                mark(at)
                at = raw.find(token, at + 1)
        starts = word_starts(body, offsets, kind)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        length = np.diff(np.append(starts, len(body)))
        hashes = self.hasher(body, starts, starts + length)
        order = np.argsort(hashes)
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        # equal hashes must be equal words: compare every occurrence with its representative, byte by byte
        there = np.repeat((starts[first][which] - starts).astype(np.int32), length)
        there += np.arange(len(body), dtype=np.int32)
        differs = np.flatnonzero(body != body.take(there, mode="clip"))
        mark(differs)
        mark(starts[length != length[first][which]])
        words_before = np.searchsorted(starts, offsets)
        used = np.zeros(len(first), bool)
        used[which if not odd.any() else which[np.repeat(~odd, np.diff(words_before))]] = True
        begin, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        spans = zip(starts[first][used].tolist(), (starts + length)[first][used].tolist())
        number, table = self.numbers([raw[a:b] for a, b in spans])
        begin[used], size[used] = table.begin[number], table.size[number]
        per_word = size[which]
        ends = np.cumsum(per_word)
        ids = table.ids[np.repeat(begin[which] - ends + per_word, per_word) + np.arange(ends[-1])]
        bounds = np.append(0, ends)[words_before]
        if not odd.any():
            return ids, np.diff(bounds)
        parts = [
            self.whole(raw[offsets[i] : offsets[i + 1]]) if odd[i] else ids[bounds[i] : bounds[i + 1]]
            for i in range(rows)
        ]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, rows)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start, part = Encoder(path), 0, TaskContext.get().partitionId()
        for batch in batches:
            body, offsets = utf8(batch.column(1))
            for first, last in pieces(offsets, BATCH_BYTES):
                at = offsets[first : last + 1]
                ids, counts = encoder(body[at[0] : at[-1]], at - at[0])
                counts = counts + 1
                ends = np.cumsum(counts)
                out = np.full(int(ends[-1]), end_id, np.int32)
                inner = np.ones(len(out), bool)
                inner[ends - 1] = False
                out[inner] = ids
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(out)),
                    ],
                    names=SCHEMA.names,
                )
                start += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, text: str = "text", doc_id: str = "doc_id", end_id: int = END
) -> None:
    """Encode every text and write the ORC files in ascending order of the document id."""
    rows = bounded_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    (
        rows.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_encode(tokenizer, end_id), SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(ROW_INDEX))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, part, local_start, n_tokens, ids)`` as stored; filters on ``doc_id`` prune stripes."""
    return spark.read.schema(SCHEMA).orc(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        at = ids.offsets.to_numpy().tolist()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
        crc = np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(2),
                pa.array(np.diff(at).astype(np.int64)),
                pa.array(crc),
            ],
            names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files.

    The ids before a file are the sums of the files before it: one row per file meets in the window.
    """
    totals = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = (
        read_tokens(spark, path)
        .select("doc_id", "part", "local_start", "ids")
        .mapInArrow(_digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    )
    return rows.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenized(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the table of token ids to the shared folder and return its digest."""
    path = work_path(docs.sparkSession, "token-ids")
    write_tokens(docs, path, tokenizer, text, doc_id)
    return token_digest(docs.sparkSession, path)
