import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.operators import chunks
from textloom.operators import parallel_chunks as pc


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 14), max_size=60), st.integers(1, 12), st.integers(1, 3))
def test_a_table_holds_the_state_after_its_block(sizes, limit, gap):
    sizes = np.array(sizes, np.int64)
    found = pc._transition(sizes, limit, gap, np.arange(limit + 2))
    for state in range(limit + 2):
        want = min(pc._starts(sizes, limit, gap, state)[1], limit + 1)
        assert (found[state] if len(found) > 1 else found[0]) == want


@pytest.mark.parametrize("block, group", [(1, 2), (3, 2), (7, 3), (4_096, 256)])
def test_equals_the_packer_of_whole_documents(spark, block, group):
    r = random.Random(block)
    docs = [(1, ""), (2, "\n\n\n"), (3, "x" * 50), (4, "a\n" * 30)]
    for i in range(10, 30):
        docs.append((i, "\n".join("y" * r.choice((0, 0, 1, 2, 5, 9, 10, 11, 25)) for _ in range(r.randint(1, 120)))))
    docs.append((99, "\n".join("z" * (i % 7) for i in range(700))))
    frame = spark.createDataFrame([*docs, (100, None)], "doc_id long, text string")
    want = sorted((r.doc_id, r.chunk_no, r.text) for r in chunks.chunk_paragraphs(frame, "\n", 10).collect())
    got = pc.parallel_pack(frame, ["doc_id"], "\n", 10, block=block, group=group)
    assert sorted((r.doc_id, r.chunk_no, r.text) for r in got.collect()) == want


def test_one_huge_document(spark):
    text = "\n\n".join(f"{i} " + "w" * (i * 37 % 300) for i in range(30_000))
    frame = spark.createDataFrame([("d", 5, text)], "doc string, version int, text string")
    want = sorted((r.chunk_no, r.text) for r in chunks.chunk_paragraphs(frame).collect())
    got = pc.parallel_pack(frame, ["doc", "version"], block=512, group=8)
    assert sorted((r.chunk_no, r.text) for r in got.collect()) == want


def test_no_documents(spark):
    assert pc.parallel_pack(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0


def test_tables_take_bounded_memory():
    """Tables of one state where the past does not matter, and batches of few full ones."""
    sizes = pa.array([[0, 1]] * 3_000, pa.list_(pa.int32()))
    blocks = {"doc_id": list(range(3_000)), "_block": [0, 1, 2] * 1_000, "_sizes": sizes}
    made = list(pc._tables(2_048, 1, ["doc_id"])([pa.RecordBatch.from_pydict(blocks)]))
    lengths = [len(t) for b in made for t in b.column("_table").to_pylist()]
    assert lengths == [4, 2_050 * 4, 2_050 * 4] * 1_000
    assert max(sum(map(len, b.column("_table").to_pylist())) for b in made) <= pc.HELD_BYTES + 2_050 * 4
    assert [i for b in made for i in b.column("doc_id").to_pylist()] == list(range(3_000))
    full = {"doc_id": [1], "_block": [1], "_sizes": pa.array([[3_000, 1]], pa.list_(pa.int32()))}
    assert [len(t) for b in pc._tables(2_048, 1, ["doc_id"])([pa.RecordBatch.from_pydict(full)]) for t in b.column("_table").to_pylist()] == [4]


def test_numbers_come_in_bounded_batches():
    sizes = pa.array([[1] * 4_096] * 400, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "_block": [0] * 400, "_sizes": sizes, "_state": [0] * 400})
    made = list(pc._numbered(10, 1, ["doc_id"])([batch]))
    assert [i for b in made for i in b.column("doc_id").to_pylist()] == list(range(400))
    assert max(b.column("_numbers").nbytes for b in made) <= pc.HELD_BYTES * 1.2
