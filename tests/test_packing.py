import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.operators import packing

ENCODED = "doc_id long, chunk_no int, input_ids array<int>, attention_mask array<int>"


def encoded(spark, lengths, width):
    rows = []
    for i, n in enumerate(lengths):
        ids = [2] + [100 + i] * (n - 1) if n else []
        rows.append((i // 3, i % 3, ids + [0] * (width - n), [1] * n + [0] * (width - n)))
    return spark.createDataFrame(rows, ENCODED)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_a_plan_holds_every_chunk_once(counts):
    plan = packing.packing_plan(counts, 32)
    held = Counter()
    for pattern, rows in plan:
        assert sum(pattern) <= 32 and rows > 0
        for length in pattern:
            held[length] += rows
    assert held == counts
    rows, least = sum(n for _, n in plan), -(-sum(k * n for k, n in counts.items()) // 32)
    assert rows <= 2 * least + 1
    assert len(plan) <= 32 * max(len(counts), 1)


@pytest.mark.parametrize("width", [8, 32])
def test_rows_hold_whole_chunks_with_segments_and_positions(spark, width):
    r = random.Random(width)
    lengths = [r.choice((1, 2, 3, 5, width // 2, width - 1, width, r.randint(1, width))) for _ in range(300)] + [0, 0, width]
    frame = encoded(spark, lengths, width).repartition(4)
    packed = packing.pack_sequences(frame, width=width).collect()
    want = {(i // 3, i % 3): [2] + [100 + i] * (n - 1) for i, n in enumerate(lengths) if n}
    seen = {}
    assert sorted(p.row_id for p in packed) == list(range(len(packed)))
    for p in packed:
        assert len(p.input_ids) == len(p.segment_ids) == len(p.position_ids) == width
        at = 0
        for k, s in enumerate(p.segments):
            assert s.start == at
            part = slice(at, at + s.length)
            assert p.segment_ids[part] == [k + 1] * s.length and p.position_ids[part] == list(range(s.length))
            assert (s.doc_id, s.chunk_no) not in seen
            seen[s.doc_id, s.chunk_no] = p.input_ids[part]
            at += s.length
        assert p.input_ids[at:] == p.segment_ids[at:] == p.position_ids[at:] == [0] * (width - at)
    assert seen == want
    again = {r.row_id: r.input_ids for r in packing.pack_sequences(frame.repartition(7), width=width).collect()}
    assert again == {p.row_id: p.input_ids for p in packed}
    back = packing.unpack_sequences(packing.pack_sequences(frame, width=width))
    assert {(r.doc_id, r.chunk_no): r.ids for r in back.collect()} == want


def test_no_chunks_no_rows(spark):
    assert packing.pack_sequences(encoded(spark, [], 8), width=8).count() == 0
    assert packing.pack_sequences(encoded(spark, [0, 0], 8), width=8).count() == 0


def test_batches_are_as_wide_as_their_longest_row(spark):
    frame = encoded(spark, [3, 5, 1, 8, 2], 8).withColumn("batch_id", F.floor(F.col("doc_id") / 1)).withColumn("pos_in_batch", F.col("chunk_no"))
    got = {r.batch_id: r for r in packing.collate_batches(frame).collect()}
    assert (got[0].rows, got[0].width) == (3, 5) and (got[1].rows, got[1].width) == (2, 8)
    assert got[0].input_ids == [2, 100, 100, 0, 0, 2, 101, 101, 101, 101, 2, 0, 0, 0, 0]
    assert got[0].attention_mask == [1, 1, 1, 0, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    assert got[0].labels == [2, 100, 100, -100, -100, 2, 101, 101, 101, 101, 2, -100, -100, -100, -100]
