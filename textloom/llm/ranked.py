"""Ranked lexical search over posting lists that are cut into geometric blocks.

A document is the vector of its terms' shares of a score, so the score of a document for an item is a plain sum over
the item's terms. The documents are read once into a table of such vectors (only terms that some item asks for; the
statistics N, L and df are taken over all documents), which is searched piece by piece inside the tasks:

* The posting list of a term is clustered by the similarity of its documents: some of them stand for clusters, every
  document goes to the most similar one, by random projections of the vectors. Clusters are cut into blocks.
* Each block keeps the coordinatewise maximum of its documents over the terms that some item asks for together with
  the term of the list. The sum of an item's coordinates bounds the score of every document in the block.
* An item goes through its lists from the rarest term on. A document is met in the list of the rarest of the item's
  terms it holds, so a list's bounds leave out the terms before. Blocks are opened by falling bound and skipped only
  when the bound lies below the item's k-th best score so far; what is open is scored exactly, in integers.

No block is skipped on an estimate, so the result is exact. The best of every task meet in a window in two steps.
Items are dealt into blocks of about ``BLOCK_TERMS`` terms by the hash of their id; each block is one pass and is the
only thing that is broadcast. Terms beyond ``KEY_BYTES`` bytes stand as their SHA-256.

Results for odd input: null, empty and termless texts are in no result, and items without terms have none. Rows of
documents count one by one, so copies and repeated ids are ranked each; equal scores go by id, nulls last. Rows of
one item id (null is one) are one item with all their terms. Empty tables give an empty result. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import LOWER, SpanHasher, bounded_batches, discard, pieces, store, stretches, utf8, word_spans

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOP = 10
BLOCK_TERMS = 1 << 19  # terms of the items in one pass
KEY_BYTES = 64
PIECE_DOCS = 4_096
PIECE_POSTINGS = 1 << 19
BLOCK_DOCS = 32
SKETCH = 16
SALTS = 64
WORDS_AT_ONCE = 1 << 18


def terms_of(text: Column) -> Column:
    """Distinct terms of a text as keys: the term, or a zero character and the SHA-256 of a long one."""
    found = F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(TERM), F.lit(0)))
    key = lambda t: F.when(F.octet_length(t) <= KEY_BYTES, t).otherwise(F.concat(F.lit("\0"), F.sha2(t, 256)))
    return F.transform(found, key)


# --- documents as vectors ------------------------------------------------------------------------------------------


class TermTable:
    """Numbers of the sought terms, found by hash and compared byte by byte."""

    def __init__(self, keys: list[str]) -> None:
        raw = [k.encode() for k in keys]
        self.long = {k: i for i, k in enumerate(raw) if k[:1] == b"\0"}
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(k) for k in raw])]).astype(np.int64)
        self.hasher = SpanHasher()
        hashes = self.hasher(self.bytes, self.at[:-1], self.at[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each span, -1 where it is none of the terms."""
        found = np.full(len(starts), -1, np.int64)
        for first in range(0, len(starts) if len(self.hashes) else 0, WORDS_AT_ONCE):
            part = slice(first, first + WORDS_AT_ONCE)
            found[part] = self._find(body, starts[part], ends[part])
        for i in np.flatnonzero(ends - starts > KEY_BYTES) if self.long else ():
            key = b"\0" + hashlib.sha256(body[starts[i] : ends[i]].tobytes()).hexdigest().encode()
            found[i] = self.long.get(key, -1)
        return found

    def _find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = self.hasher(body[starts[0] : ends[-1]], starts - starts[0], ends - starts[0])
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.where(self.hashes[place] == hashes, self.order[place], -1)
        at = np.flatnonzero(number >= 0)
        size = ends[at] - starts[at]
        fits = size == np.diff(self.at)[number[at]]
        number[at[~fits]] = -1
        at, size = at[fits], size[fits]
        if len(at):
            begin = np.cumsum(size) - size
            inside = np.arange(size.sum()) - np.repeat(begin, size)
            same = body[np.repeat(starts[at], size) + inside] == self.bytes[np.repeat(self.at[number[at]], size) + inside]
            number[at[~np.logical_and.reduceat(same, begin)]] = -1
        return number

    def vectors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of terms of each text, and for what is sought in it: the row's end, the term's number, its count."""
        body, offsets = utf8(texts)
        size, total, keys = self.at.size, np.zeros(len(texts), np.int64), []
        for first, last in pieces(offsets):
            for begin, end in stretches(body, offsets[first], offsets[last]):
                at = np.clip(offsets[first : last + 1], begin, end) - begin
                part = LOWER[body[begin:end]]
                starts, ends, counts = word_spans(part, at, False)
                number, row = self.find(part, starts, ends), np.repeat(np.arange(first, last), counts)
                total[first:last] += counts
                keys.append((row * size + number)[number >= 0])
        key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
        return total, np.cumsum(np.bincount(key // size, minlength=len(texts))), key % size, count


def _vectors(docs: DataFrame, keys: list[str], text: str, doc_id: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable(shared.value)
        for batch in batches:
            total, ends, number, count = table.vectors(batch.column(1))
            at = pa.array(np.concatenate([[0], ends]), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (number, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), *lists], names=["id", "n", "terms", "counts"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = bounded_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(read, f"id {kind}, n bigint, terms array<int>, counts array<int>")


# --- pieces of the index ---------------------------------------------------------------------------------------------


class Items:
    """Items of one pass: their terms by rising document frequency, and the weights and companions of terms."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, df: np.ndarray) -> None:
        self.weights, self.size = weights, len(weights)
        self.terms = [t[np.lexsort((t, df[t]))] for t in terms]
        self.holders: dict[int, list[int]] = {}
        for i, own in enumerate(self.terms):
            for t in own.tolist():
                self.holders.setdefault(t, []).append(i)
        self.projection = np.random.default_rng(11).choice(np.array([-1, 1], np.float32), (self.size, SKETCH))

    def companions(self, term: int) -> np.ndarray:
        """Terms that some item asks for together with this one, itself included, in order."""
        return np.unique(np.concatenate([self.terms[i] for i in self.holders[term]]))


class Piece:
    """Some documents as posting lists; lists are blocked and summed up when an item first needs them."""

    def __init__(self, items: Items, ends: np.ndarray, terms: np.ndarray, shares: np.ndarray) -> None:
        self.items, self.ends, self.begins = items, ends, np.concatenate([[0], ends[:-1]])
        self.terms, self.shares = terms, shares
        docs = np.repeat(np.arange(len(ends)), ends - self.begins)
        order = np.argsort(terms, kind="stable")
        self.listed, by = docs[order], terms[order]
        first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.zeros(0, np.int64)
        self.lists = dict(zip(by[first].tolist(), zip(first.tolist(), [*first[1:].tolist(), len(by)])))
        self.most = np.zeros(items.size, np.int64)
        if len(by):
            self.most[by[first]] = np.maximum.reduceat(shares[order], first)
        self.sketch = np.zeros((len(ends), SKETCH), np.float32)
        full = np.flatnonzero(ends > self.begins)
        if len(full):
            rows = items.projection[terms] * shares[:, None].astype(np.float32)
            self.sketch[full] = np.add.reduceat(rows, self.begins[full])
            self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1), 1e-9)[:, None]
        self.blocked: dict[int, tuple] = {}
        self.seen = np.full(len(ends), -1, np.int64)
        self.opened = self.skipped = 0

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some documents, and where each document's entries end among them."""
        size = self.ends[docs] - self.begins[docs]
        ends = np.cumsum(size)
        return np.repeat(self.begins[docs] - (ends - size), size) + np.arange(size.sum()), ends

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents of a list in the order of its blocks, the bounds of the blocks, their summary and its terms."""
        if term not in self.blocked:
            first, last = self.lists[term]
            docs = self.listed[first:last]
            borders = [0]
            if len(docs) > BLOCK_DOCS:
                stand = docs[:: BLOCK_DOCS]
                cluster = (self.sketch[docs] @ self.sketch[stand].T).argmax(1)
                order = np.argsort(cluster, kind="stable")
                docs, ends = docs[order], np.cumsum(np.bincount(cluster, minlength=len(stand)))
                for end in ends.tolist():
                    borders += range(borders[-1] + BLOCK_DOCS, end, BLOCK_DOCS)
                    if end > borders[-1]:
                        borders.append(end)
            else:
                borders.append(len(docs))
            borders = np.array(borders)
            columns = self.items.companions(term)
            entries, ends = self._entries(docs)
            block = np.repeat(np.repeat(np.arange(len(borders) - 1), np.diff(borders)), np.diff(ends, prepend=0))
            column = np.minimum(np.searchsorted(columns, self.terms[entries]), len(columns) - 1)
            real = columns[column] == self.terms[entries]
            summary = np.zeros((len(borders) - 1, len(columns)), np.int64)
            np.maximum.at(summary, (block[real], column[real]), self.shares[entries[real]])
            self.blocked[term] = docs, borders, summary, columns
        return self.blocked[term]

    def search(self, item: int, best: Best) -> None:
        terms = np.array([t for t in self.items.terms[item].tolist() if t in self.lists], np.int64)
        if not len(terms):
            return
        left = np.cumsum(self.most[terms][::-1])[::-1]
        wanted = np.zeros(self.items.size, bool)
        wanted[terms] = True
        for i, term in enumerate(terms.tolist()):
            if left[i] < best.least:
                break
            docs, borders, summary, columns = self.blocks(term)
            bound = summary[:, np.searchsorted(columns, terms[i:])].sum(1)
            order = np.argsort(-bound, kind="stable")
            at, step = 0, 4
            while at < len(order) and bound[order[at]] >= best.least:
                chosen = order[at : at + step]
                chosen = chosen[bound[chosen] >= best.least]
                self.opened += len(chosen)
                size = borders[chosen + 1] - borders[chosen]
                places = np.repeat(borders[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                found = docs[places]
                found = found[self.seen[found] != item]
                self.seen[found] = item
                if len(found):
                    entries, ends = self._entries(found)
                    running = np.cumsum(np.where(wanted[self.terms[entries]], self.shares[entries], 0))[ends - 1]
                    best.take(found, np.diff(running, prepend=0))
                at, step = at + step, step * 2
            self.skipped += max(len(order) - at, 0)


class Best:
    """The best documents of an item so far, highest score first, equal scores by id, nulls last."""

    def __init__(self, top: int, kind: pa.DataType) -> None:
        self.top, self.least, self.pool = top, 1, None
        self.rows = pa.table({"score": pa.array([], pa.int64()), "id": pa.array([], kind)})

    def take(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        new = pa.table({"score": pa.array(scores[good]), "id": self.pool.take(pa.array(docs[good]))})
        rows = pa.concat_tables([self.rows, new])
        order = pc.sort_indices(rows, sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_end")
        self.rows = rows.take(order[: self.top])
        if len(self.rows) == self.top:
            self.least = max(self.rows["score"][-1].as_py(), 1)


def shares(n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, docs: int, words: int):
    """Each entry's part of a score; products beyond 64 bits are taken in Python's integers."""
    most = int(n.max()) if len(n) else 0
    if 90 * most * docs < 1 << 63:
        length = 10 + (90 * n * docs) // words
    else:
        length = np.array([10 + (90 * x * docs) // words for x in n.tolist()], np.int64)
    each = np.repeat(length, np.diff(ends, prepend=0))
    return weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * each))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to pieces."""
    waiting, docs, postings = [], 0, 0
    for batch in batches:
        for first in range(0, len(batch), PIECE_DOCS // 4):
            part = batch.slice(first, PIECE_DOCS // 4)
            waiting.append(part)
            docs, postings = docs + len(part), postings + len(part.column("terms").flatten())
            if docs >= PIECE_DOCS or postings >= PIECE_POSTINGS:
                yield pa.Table.from_batches(waiting)
                waiting, docs, postings = [], 0, 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _searched(
    vectors: DataFrame, ids: pa.Array, item_kind: str, terms: list[np.ndarray], weights: np.ndarray, df: np.ndarray, docs: int, words: int, top: int
) -> DataFrame:
    """The best documents of each item in every task."""
    shared = vectors.sparkSession.sparkContext.broadcast((ids, terms, weights, df))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, own, weight, frequency = shared.value
        items, best = Items(own, weight, frequency), None
        for table in _gathered(batches):
            table = table.combine_chunks()
            number, pool = table["n"].to_numpy(), table["id"].combine_chunks()
            lists = table["terms"].combine_chunks()
            flat = lists.flatten().to_numpy().astype(np.int64)
            counts = table["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py())[1:].astype(np.int64)
            piece = Piece(items, ends, flat, shares(number, ends, flat, counts, weight, docs, words))
            best = best or [Best(top, pool.type) for _ in own]
            for i, kept in enumerate(best):
                kept.pool = pool
                piece.search(i, kept)
                kept.pool = None
        for i, kept in enumerate(best or []):
            if len(kept.rows):
                rows = kept.rows.combine_chunks()
                same = pa.array(np.full(len(rows), i), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [same, item_ids.take(same), *(rows[c].combine_chunks() for c in ("id", "score"))],
                    names=["item", "item_id", "doc_id", "score"],
                )

    doc_kind = vectors.schema["id"].dataType.simpleString()
    return vectors.filter(F.size("terms") > 0).mapInArrow(run, f"item int, item_id {item_kind}, doc_id {doc_kind}, score bigint")


def search(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", top: int = TOP
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.explode(terms_of(F.col(item_text).cast("string"))).alias("term")).distinct()
    asked, asked_path = store(asked, "items")
    blocks = max(1, math.ceil(asked.count() / BLOCK_TERMS))
    found = []
    for block in range(blocks):
        # about BLOCK_TERMS short terms
        own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        own = own.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).toArrow()
        ids, lists = own["item_id"].combine_chunks(), own["terms"].combine_chunks()
        keys = pc.unique(lists.flatten())
        number = pc.index_in(lists.flatten(), value_set=keys).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = np.split(number, lists.offsets.to_numpy()[1:-1]) if len(ids) else []
        vectors, _ = store(_vectors(docs, keys.to_pylist(), text, doc_id), "vectors")
        totals = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(keys), np.int64)
        held = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row for each of the terms
        df[held["t"].to_numpy()] = held["count"].to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        part = _searched(vectors, ids, asked.schema["item_id"].dataType.simpleString(), terms, weights, df, totals[0], totals[1], top)
        found.append(part.withColumn("block", F.lit(block)))
    discard(spark, asked_path)
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    near = Window.partitionBy("block", "item", "salt").orderBy(*order)
    near = rows.select("*", salt).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


#: The same by counting every term of every document.
ORACLE = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM documents
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM benchmark)
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, totals GROUP BY term, docs
), parts AS (
  SELECT item_id, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS part
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), totals
), scored AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM parts GROUP BY ALL HAVING sum(part) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
