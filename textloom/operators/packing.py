"""Encoded chunks put together: several in a row of fixed length, or padded to the longest of their batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.ranking import global_rank
from textloom.operators.tokens import IGNORED_LABEL, MAX_LENGTH, PAD
from textloom.session import materialise


def packing_plan(counts: dict[int, int], width: int = MAX_LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, longest first, and how many rows follow each, from the number of chunks of each length.

    Lengths go from long to short into the rows whose space they fill best; equal rows are one entry with a number, so
    the work depends on the different lengths only.
    """
    spaces: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in spaces if s >= length), default=width)
            pattern, rows = next(iter(spaces.get(space, {(): left}).items()))
            copies = min(space // length, left)
            taken = min(left // copies, rows)
            if pattern:
                spaces[space][pattern] -= taken
                if not spaces[space][pattern]:
                    del spaces[space][pattern]
                if not spaces[space]:
                    del spaces[space]
            grown = (*pattern, *[length] * copies)
            there = spaces.setdefault(space - length * copies, {})
            there[grown] = there.get(grown, 0) + taken
            left -= taken * copies
    return sorted(((p, n) for there in spaces.values() for p, n in there.items()), reverse=True)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, copies, row, slot)``: from rank ``first`` on, chunks of a length fill ``copies`` slots of each row."""
    used: dict[int, int] = {}
    out, row = [], 0
    for pattern, rows in plan:
        for length in dict.fromkeys(pattern):
            copies = pattern.count(length)
            out.append((length, used.get(length, 0), copies, row, pattern.index(length)))
            used[length] = used.get(length, 0) + copies * rows
        row += rows
    return out


def pack_sequences(
    encoded: DataFrame,
    keys: Sequence[str] = ("doc_id", "chunk_no"),
    width: int = MAX_LENGTH,
    ids: str = "input_ids",
    mask: str = "attention_mask",
    pad: int = PAD,
    seed: int = 42,
) -> DataFrame:
    """Rows of ``width`` ids that hold whole chunks: ``(row_id, input_ids, segment_ids, position_ids, segments)``.

    Padding of the chunks is left out. Segments are numbered from 1 in a row and positions start anew in each; padding
    has segment 0 and position 0. ``segments`` names the chunks, their starts and lengths. Chunks without ids are in no
    row; longer ones than ``width`` are an error of the caller.

    Only the number of chunks of each length, at most ``width`` numbers, decides which lengths share a row. Chunks of
    a length take their places by an exact distributed rank, and the ids are shuffled once, to their rows.
    """
    keys = list(keys)
    real = F.slice(F.col(ids), 1, F.aggregate(mask, F.lit(0), lambda a, x: a + x)).alias("_ids")
    chunks = materialise(encoded.select(*keys, real).withColumn("_length", F.size("_ids")).filter("_length > 0"), "unpadded")
    counts = {r["_length"]: r["count"] for r in chunks.groupBy("_length").count().collect()}  # at most width rows
    slots = chunks.sparkSession.createDataFrame(
        _slots(packing_plan(counts, width)), "_length int, _first long, _copies int, _row long, _slot int"
    )
    places = slots.groupBy("_length").agg(F.sort_array(F.collect_list(F.struct("_first", "_copies", "_row", "_slot"))).alias("_places"))
    ranked = global_rank(chunks.select(*keys, "_length"), keys, seed, "_rank", within=["_length"])
    at = F.col("_rank") - 1
    place = F.element_at(F.filter("_places", lambda p: p["_first"] <= at), -1)
    placed = ranked.join(F.broadcast(places), "_length").select(*keys, at.alias("_at"), place.alias("_p"))  # at most width rows
    inside = F.col("_at") - F.col("_p._first")
    placed = placed.select(
        *keys,
        (F.col("_p._row") + F.floor(inside / F.col("_p._copies"))).alias("row_id"),
        (F.col("_p._slot") + F.pmod(inside, F.col("_p._copies"))).alias("_slot"),
    )
    rows = placed.join(chunks, keys).groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("_slot", "_ids", F.struct(*keys).alias("_key")))).alias("_held")  # a row's worth
    )
    lengths = F.transform("_held", lambda h: F.size(h["_ids"]))
    rows = rows.select("row_id", "_held", F.explode(F.array(lengths)).alias("_lengths"))
    start = lambda i: F.aggregate(F.slice("_lengths", 1, i), F.lit(0), lambda a, n: a + n)
    rest = F.lit(width) - F.aggregate("_lengths", F.lit(0), lambda a, n: a + n)
    segments = F.transform(
        "_held", lambda h, i: F.struct(*[h["_key"][k].alias(k) for k in keys], start(i).alias("start"), F.size(h["_ids"]).alias("length"))
    )
    return rows.select(
        "row_id",
        F.concat(F.flatten(F.transform("_held", lambda h: h["_ids"])), F.array_repeat(F.lit(pad), rest)).alias("input_ids"),
        _filled(F.transform("_lengths", lambda n, i: F.array_repeat(i + 1, n)), rest).alias("segment_ids"),
        _filled(F.transform("_lengths", lambda n: F.sequence(F.lit(0), n - 1)), rest).alias("position_ids"),
        segments.alias("segments"),
    )


def _filled(parts: Column, rest: Column) -> Column:
    return F.concat(F.flatten(parts), F.array_repeat(F.lit(0), rest))


def unpack_sequences(packed: DataFrame) -> DataFrame:
    """The chunks of packed rows with their ids: ``(row_id, *keys, ids)``."""
    held = packed.select("row_id", "input_ids", F.explode("segments").alias("_s"))
    ids = F.slice("input_ids", F.col("_s.start") + 1, F.col("_s.length")).alias("ids")
    return held.select("row_id", "_s.*", ids).drop("start", "length")


def collate_batches(
    rows: DataFrame,
    by: Sequence[str] = ("batch_id",),
    order: str = "pos_in_batch",
    ids: str = "input_ids",
    mask: str = "attention_mask",
    pad: int = PAD,
) -> DataFrame:
    """One row a batch: ``(*by, rows, width, input_ids, attention_mask, labels)``, flat arrays of ``rows`` x ``width`` values.

    A batch is as wide as its longest row without padding; ``labels`` ignore padding. A batch holds the rows the plan put
    there, so a group is bounded by the batch size.
    """
    real = F.slice(F.col(ids), 1, F.aggregate(mask, F.lit(0), lambda a, x: a + x))
    held = rows.select(*by, F.struct(F.col(order).alias("at"), real.alias("ids")).alias("_r"))
    held = held.groupBy(*by).agg(F.sort_array(F.collect_list("_r"))["ids"].alias("_ids"))
    width = F.array_max(F.transform("_ids", lambda x: F.size(x)))
    # the generator keeps the sort from being repeated in every use of the column
    held = held.select(*by, F.explode(F.array(F.struct("_ids", width.alias("width")))).alias("_b")).select(*by, "_b.*")

    def flat(of, filler: int) -> Column:
        line = lambda x: F.concat(of(x), F.array_repeat(F.lit(filler), F.col("width") - F.size(x)))
        return F.flatten(F.transform("_ids", line))

    return held.select(
        *by,
        F.size("_ids").alias("rows"),
        "width",
        flat(lambda x: x, pad).alias("input_ids"),
        flat(lambda x: F.array_repeat(F.lit(1), F.size(x)), 0).alias("attention_mask"),
        flat(lambda x: x, IGNORED_LABEL).alias("labels"),
    )
