"""Sharding, mixing and chats."""

import math
from collections import Counter

import duckdb
import helpers
import pytest
from pyspark.sql import functions as F

from textloom.llm import chat_parts, mixing, permutation, plans

SF = "/root/testdata/sf0.01"


# --- sharding


def slow_table(shards, size):
    order = [[(permutation._hash(f"offset {s}") + j * (permutation._hash(f"step {s}") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    table, at = {}, [0] * len(shards)
    while len(table) < size:
        for k in range(len(shards)):
            if len(table) == size:
                break
            while order[k][at[k]] in table:
                at[k] += 1
            table[order[k][at[k]]] = k
    return [table[i] for i in range(size)]


def test_table_is_filled_in_turns():
    for shards, size in ((["a"], 2), (["a", "b", "c"], 13), ([f"s{i}" for i in range(10)], 101)):
        assert permutation.lookup_table(shards, size) == slow_table(shards, size)
    full = Counter(permutation.lookup_table())
    assert max(full.values()) - min(full.values()) <= 1
    fewer = permutation.lookup_table(permutation.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(permutation.lookup_table(), fewer))
    assert moved < 0.06 * permutation.TABLE
    for bad in ([], ["a", "a"], ["a", "b", "c"]):
        with pytest.raises(ValueError):
            permutation.lookup_table(bad, 2)


def test_place_looks_slots_up(spark):
    got = plans.QUERIES["op6_shard_table"](spark, SF).collect()
    table = permutation.lookup_table()
    assert len(got) == plans.table(spark, SF, "documents").count()
    assert all(r.shard == permutation.SHARDS[table[r.slot]] for r in got)
    slots = {r.doc_id: r.s for r in spark.range(1000).select(F.col("id").alias("doc_id"), permutation.slot_of(F.col("id"), F.lit("")).alias("s")).collect()}
    assert all(slots[r.doc_id] == r.slot for r in got)


def test_shards_are_written_whole(spark, folder):
    docs = helpers.odd_docs(spark)
    permutation.write_shards(docs, f"{folder}/shards", shards=["a", "b", "c"], size=13)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == docs.count() and set(back.columns) == {*docs.columns, "shard"}
    assert permutation.place(docs).count() == docs.count() and permutation.place(helpers.no_docs(spark)).count() == 0


# --- mixing


def slow_targets(sizes):
    """Targets by sharing excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest} if rest else {}
        above = [s for s in rest if share[s] > 3 * sizes[s] * (1 + 1e-12)]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 10, None: 10}, {"a": 1, "b": 1000, "c": 10, "d": 3, None: 7}, {"z": 5}, {"a": 0, "b": 4}, {"a": 0}, {f"s{i}": i * i % 37 for i in range(25)}],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    want = slow_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_words_come_near_the_targets(spark):
    """In order of size the whole error is a matter of the largest texts."""
    rows = mixing.copies(plans.table(spark, "/root/testdata/sf0.1", "documents")).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 3
    assert all(abs(taken[s] - t) < largest[s] and abs(taken[s] - t) < 0.05 * t for s, t in target.items())


def test_mixed_rows(spark):
    docs = helpers.odd_docs(spark)
    counts = mixing.copies(docs)
    assert counts.count() == docs.count()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want, got = Counter(), Counter(r.doc_id for r in out.collect())
    for r in counts.collect():
        want[r.doc_id] += r.copies
    assert got == +want
    assert mixing.copies(helpers.no_docs(spark)).count() == 0 and mixing.mixed(helpers.no_docs(spark)).count() == 0
    assert helpers.rows_of(counts, "doc_id", "copies") == helpers.rows_of(mixing.copies(docs.repartition(5)), "doc_id", "copies")


# --- chats


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, parts array<struct<type:string,text:string,ref:string,tokens:int>>, text string, body string, t int, head int")


def text(*said):
    return [("text", s, None, None) for s in said]


NASTY = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<\\\\|end|>", "[\\INST]", "<|image:1|>", "<<|part|>>", "\\", "a\\", "<", "[", "$1 \\1", "", "é😀\n\n", "<s><s>", "<|text|><|turn|>"]


def test_round_trip_of_control_strings(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], text(s), None, None, None, None) for i, s in enumerate(NASTY) for t in range(3)]
    rows += [(99, i, "assistant", text(s, NASTY[-i]), None, None, None, None) for i, s in enumerate(NASTY)]
    back = chat_parts.read_chats(chat_parts.format_chats(chats(spark, rows)))
    for r in back.collect():
        mine = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: x[1])
        said = ["".join(p[1] for p in x[3]) for x in mine]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], s) for x, s in zip(mine, said)]
        assert r.loss_text == "".join(s for x, s in zip(mine, said) if x[2] == "assistant")


def test_attachments_become_placeholders(spark):
    parts = [("text", "see ", None, None), ("image", None, "img/1.png", None), ("audio", None, "a.wav", 40), None, ("video", None, "v.mp4", None), (None, " end", None, None)]
    rows = [(1, 0, "user", parts, None, None, None, None), (1, 1, "assistant", [("document", None, "d.pdf", None)], None, None, None, None), (1, 2, "user", None, None, None, None, None)]
    r = chat_parts.format_chats(chats(spark, rows)).first()
    assert [(a.turn_no, a.number, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (1, 1, "image", "img/1.png", 256), (1, 2, "audio", "a.wav", 40), (1, 3, "video", "v.mp4", 64), (2, 1, "document", "d.pdf", 1024),
    ]
    assert r.attachment_tokens == 256 + 40 + 64 + 1024
    back = chat_parts.read_chats(chat_parts.format_chats(chats(spark, rows))).first()
    assert [t.text for t in back.turns] == ["see <|image:1|><|audio:2|><|attachment:3|> end", "<|document:1|>", ""]
    assert back.loss_text == "<|document:1|>"


def test_odd_chats(spark):
    rows = [(None, None, None, text("x"), None, None, None, None), (1, 2, "assistant", text("b"), None, None, None, None), (1, None, "user", text("first"), None, None, None, None), (1, 2, "assistant", text("b"), None, None, None, None), (1, 2, "assistant", text(None), None, None, None, None), (2, 0, "a<|end|>b", text("y " * 100_000), None, None, None, None)]
    got = {r.conv_id: r for r in chat_parts.read_chats(chat_parts.format_chats(chats(spark, rows))).collect()}
    assert [t.text for t in got[1].turns] == ["first", "", "b", "b"] and got[1].loss_text == "bb"
    assert got[None].turns[0].role == "" and got[2].turns[0].role == "a<|end|>b" and len(got[2].turns[0].text) == 200_000
    assert chat_parts.format_chats(chats(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op8_mixing", "op10_chat_parts"])
def test_queries_match_sql(spark, name):
    from compare import connect, mismatch

    assert duckdb and mismatch(spark, connect(SF), SF, plans.QUERIES[name], plans.ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op6_shard_table", "op8_mixing", "op10_chat_parts"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD", "CartesianProduct"))


def test_mixed_leaves_columns_with_helpers_names(spark):
    names = ["_size_own", "_turn_own", "_turn_copy", "_key_source", "_key", "_of", "_n", "_own_size"]
    docs = spark.range(60).selectExpr("id as doc_id", "repeat('w ', 1 + cast(id % 9 as int)) as text", "if(id % 3 = 0, 'a', 'b') as source")
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.distinct().exceptAll(docs).count() == 0
    taken = mixing.copies(docs).selectExpr("sum(copies) as n").first().n
    assert got.count() == taken > 0
