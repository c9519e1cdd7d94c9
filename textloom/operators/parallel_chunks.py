"""Greedy paragraph packing of documents that are too long for one task, with the chunks of :mod:`chunks`.

The packer's only state between paragraphs is how full the open chunk is, and all that is over the limit behaves alike,
so a block of paragraphs is a table from the state before it to the state after it. Tables of consecutive blocks are
composed in groups, groups of groups and so on until one group per document is left; on the way back every group learns
its first state. Then each block is packed on its own from its state. Blocks hold lengths only; texts are joined to
their chunks and meet there, so no task holds more than a chunk's text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.numbers import bounded_runs
from textloom.functions.text import paragraphs
from textloom.operators.chunks import CHUNK_LIMIT
from textloom.session import materialise

BLOCK = 4_096  # paragraphs of a table
GROUP = 256  # tables that are composed at once
HELD_BYTES = 4 << 20  # of the rows that a task makes at once


def _transition(sizes: np.ndarray, limit: int, gap: int, states: np.ndarray) -> np.ndarray:
    """States after some paragraphs, for each state before them; ``limit`` + 1 stands for all above the limit."""
    states = states.copy()
    for size in np.minimum(sizes, limit + 1).tolist():
        fresh = (states == 0) | (states + size > limit)
        states = np.where(fresh, size, np.minimum(states + gap + size, limit + 1))
        if (states == states[0]).all():  # what came before does not matter any more
            states = states[:1]
    return states


def _starts(sizes: np.ndarray, limit: int, gap: int, state: int) -> tuple[np.ndarray, int]:
    """Whether each paragraph starts a chunk."""
    out = np.zeros(len(sizes), bool)
    for i, size in enumerate(sizes.tolist()):
        out[i] = state == 0 or state + size > limit
        state = size if out[i] else state + gap + size
    return out, state


def _after(table: np.ndarray, state):
    """The state or states after a table; a table of one state gives it whatever came before."""
    return table[state] if len(table) > 1 else table


def _in_runs(batches: Iterator[pa.RecordBatch], column: str, item: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces whose lists hold ``HELD_BYTES`` at ``item`` bytes for each element."""
    for batch in batches:
        held = np.asarray(pc.list_value_length(batch.column(column))) + 1  # a row is counted besides its elements
        for start, end in bounded_runs(held, max(HELD_BYTES // item, 1)):
            yield batch.slice(start, end - start)


def _tables(limit: int, gap: int, names: list[str]):
    """A table for each block: ``limit`` + 2 states, or one where what came before does not matter."""

    def made(batch: pa.RecordBatch, end: int, tables: list[bytes]) -> pa.RecordBatch:
        own = batch.slice(end - len(tables), len(tables))
        columns = [own.column(n) for n in (*names, "_block")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(tables, pa.binary())], names=[*names, "_at", "_table"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables, held = [], 0
            for i, (number, sizes) in enumerate(zip(batch.column("_block").to_pylist(), batch.column("_sizes"))):
                # a document starts empty, so its first block needs one state only
                states = np.arange(limit + 2) if number else np.zeros(1, np.int64)
                tables.append(_transition(sizes.values.to_numpy(), limit, gap, states).astype("<i4").tobytes())
                held += len(tables[-1])
                if held > HELD_BYTES:
                    yield made(batch, i + 1, tables)
                    tables, held = [], 0
            yield made(batch, len(batch), tables)

    return run


def _composed(names: list[str]):
    """One table for each group, in the order of ``_held``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # of as many bytes as Arrow batches may have; a group's table is no longer than those it is made of
            tables = []
            for held in batch.column("_held"):
                state = None
                for table in held.values.field("_table"):
                    table = np.frombuffer(table.as_buffer(), "<i4")
                    state = table if state is None else _after(table, state)
                tables.append(np.ascontiguousarray(state).tobytes())
            columns = [batch.column(n) for n in (*names, "_group")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tables, pa.binary())], names=[*names, "_at", "_table"])

    return run


def _walked(names: list[str]):
    """The state before each table of a group, from the state before the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for held, state in zip(batch.column("_held"), batch.column("_state").to_pylist()):
                own = []
                for table in held.values.field("_table"):
                    own.append(state)
                    state = int(np.atleast_1d(_after(np.frombuffer(table.as_buffer(), "<i4"), state))[0])
                states.append(own)
            at = pa.array([held.values.field("_at").to_pylist() for held in batch.column("_held")], pa.list_(pa.int64()))
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, at, pa.array(states, pa.list_(pa.int32()))], names=[*names, "_ats", "_states"])

    return run


def _first_states(tables: DataFrame, names: list[str], kinds: str, group: int) -> DataFrame:
    """``(*names, _at, _state)``: the state before each table of ``(*names, _at, _table)``."""
    held = tables.groupBy(*names, F.floor(F.col("_at") / group).alias("_group")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_table"))).alias("_held")  # at most ``group`` tables
    )
    if tables.agg(F.coalesce(F.max("_at"), F.lit(0))).first()[0] < group:
        started = held.withColumn("_state", F.lit(0))
    else:
        above = materialise(held.mapInArrow(_composed(names), f"{kinds}, _at bigint, _table binary"), "tables")
        states = _first_states(above, names, kinds, group).withColumnRenamed("_at", "_group")
        started = held.join(states, [*names, "_group"])
    walked = started.select(*names, "_held", "_state").mapInArrow(_walked(names), f"{kinds}, _ats array<bigint>, _states array<int>")
    pairs = F.explode(F.arrays_zip("_ats", "_states")).alias("_z")
    return walked.select(*names, pairs).select(*names, F.col("_z._ats").alias("_at"), F.col("_z._states").alias("_state"))


def _numbered(limit: int, gap: int, names: list[str]):
    """Blocks with the chunk number of each paragraph inside the block: -1 goes on with what was open, null is in none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_runs(batches, "_sizes", 8):
            numbers, counts = [], []
            for sizes, state in zip(batch.column("_sizes"), batch.column("_state").to_pylist()):
                sizes = sizes.values.to_numpy()
                starts, _ = _starts(sizes, limit, gap, state)
                real = starts & (sizes > 0)
                number = np.cumsum(real) - 1
                numbers.append(pa.array(number, pa.int64(), mask=starts & (sizes == 0)))
                counts.append(int(real.sum()))
            ends = np.cumsum([0, *map(len, numbers)])
            flat = pa.concat_arrays(numbers) if numbers else pa.array([], pa.int64())
            columns = [batch.column(n) for n in (*names, "_block")]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(counts, pa.int64())], names=[*names, "_block", "_numbers", "_count"])

    return run


def pack_parts(
    parts: DataFrame,
    keys: Sequence[str],
    separator: str = "\n\n",
    limit: int = CHUNK_LIMIT,
    part_no: str = "part_no",
    text_col: str = "text",
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """``(*keys, chunk_no, text)`` from one row per paragraph, numbered from 0 in its document without gaps.

    The chunks are those of :func:`chunks.chunk_paragraphs` on the joined text; ``keys`` name a document and are not null.
    """
    names, types = list(keys), dict(parts.dtypes)
    kinds = ", ".join(f"`{n}` {types[n]}" for n in names)
    number = F.floor(F.col(part_no) / block).alias("_block")
    sizes = parts.groupBy(*names, number).agg(
        F.sort_array(F.collect_list(F.struct(part_no, F.length(text_col).alias("_n"))))["_n"].alias("_sizes")  # at most ``block``
    )
    sizes = materialise(sizes, "sizes")
    tables = materialise(sizes.mapInArrow(_tables(limit, len(separator), names), f"{kinds}, _at bigint, _table binary"), "tables")
    states = _first_states(tables, names, kinds, group).withColumnRenamed("_at", "_block")
    numbered = sizes.join(states, [*names, "_block"]).mapInArrow(
        _numbered(limit, len(separator), names), f"{kinds}, _block bigint, _numbers array<bigint>, _count bigint"
    )
    numbered = materialise(numbered, "numbers")
    earlier = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = numbered.select(*names, "_block", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"))
    places = numbered.join(before, [*names, "_block"]).select(*names, "_block", "_before", F.posexplode("_numbers").alias("_i", "_number"))
    places = places.filter("_number is not null").select(
        *names, (F.col("_block") * block + F.col("_i")).alias(part_no), (F.col("_before") + F.col("_number")).cast("int").alias("chunk_no")
    )
    held = parts.select(*names, F.col(part_no).cast("long").alias(part_no), text_col).join(places, [*names, part_no])
    texts = F.sort_array(F.collect_list(F.struct(part_no, text_col)))[text_col]  # a chunk's paragraphs
    return held.groupBy(*names, "chunk_no").agg(F.array_join(texts, separator).alias(text_col))


def parallel_pack(
    df: DataFrame, keys: Sequence[str], separator: str = "\n\n", limit: int = CHUNK_LIMIT, text_col: str = "text", block: int = BLOCK, group: int = GROUP
) -> DataFrame:
    """:func:`pack_parts` over the paragraphs of texts; a document is read by one task and packed by many."""
    parts = df.select(*keys, F.posexplode(paragraphs(F.col(text_col), separator)).alias("part_no", text_col))
    return pack_parts(parts, keys, separator, limit, "part_no", text_col, block, group)
