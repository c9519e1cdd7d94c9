import itertools
import random
import re

import helpers
import numpy as np
import pytest
import xxhash

from textloom.llm import golay, plans
from textloom.llm.components import components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Fingerprint of each id to its component by all pairs."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(fps), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("text", [t for t in helpers.ODD_TEXTS if t] + ["A b C d E f", helpers.prose(1, 700), "É è É é"])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert golay.fingerprint(text.encode()) == slow_fingerprint(text)


def test_words_within_two_bits_share_a_key():
    table = golay.decoding_table()
    assert (table >= 0).any(axis=1).all() and (table[:, 0] >= 0).all()
    r = random.Random(2)
    for _ in range(3_000):
        x = r.getrandbits(23)
        y = x
        for bit in r.sample(range(23), r.randint(0, 2)):
            y ^= 1 << bit
        keys = []
        for v in (x, y):
            errors = table[golay.syndrome(v)]
            keys.append({(v ^ int(e)) >> 11 for e in errors if e >= 0})
        assert keys[0] & keys[1]


def test_syndromes_agree_with_division():
    words = np.array([0, 1, 5, (1 << 23) - 1, 1234567], np.uint64)
    assert golay.syndromes(words).tolist() == [golay.syndrome(int(w)) for w in words]


def test_links_are_those_of_all_pairs(spark):
    """Planted fingerprints: random ones, chains of 1 to 5 flipped bits, and one dense ball."""
    r = random.Random(4)
    fps = [r.getrandbits(64) for _ in range(150)]
    for base in fps[:60]:
        at = base
        for _ in range(r.randint(1, 4)):
            for bit in r.sample(range(64), r.randint(1, 5)):
                at ^= 1 << bit
            fps.append(at)
    fps += [fps[0] ^ 1 << a ^ 1 << b for a, b in itertools.combinations(range(24), 2)]
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found, _ = golay.links(nodes)
    got = {r.node: r.component for r in components(found, "a", "b").collect()}
    want = slow_components({s: f for s, f in zip(signed, fps)})
    same = {}
    for node in signed:
        same.setdefault(want[node], set()).add(got.get(node, node))
    assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)
    assert found.count() < 276 * 275 / 2 / 10  # the ball alone has that many pairs


def test_query_matches_brute_force(spark):
    docs = plans.table(spark, SF, "documents").select("doc_id", "text").collect()
    fps = {d.doc_id: slow_fingerprint(d.text) for d in docs}
    want = slow_components(fps)
    got = plans.QUERIES["op4_golay_dedup"](spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{fps[i]:016x}", want[i]) for i in fps
    )


def test_odd_rows(spark):
    docs = helpers.odd_docs(spark)
    got = golay.near_copies(docs).collect()
    assert len(got) == docs.count()
    blank = {r.doc_id: r.component_id for r in got if r.fp == 0}
    assert blank[0] == blank[1] == blank[2] == blank[100] == 0 and blank[None] == 0
    kept = golay.first_of_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) <= 1 and ids.count(None) == 2 and 100 not in ids


def test_empty_tables(spark):
    empty = helpers.no_docs(spark)
    assert golay.near_copies(empty).collect() == []
    assert golay.first_of_group(empty).columns == empty.columns and golay.first_of_group(empty).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    got = components(chain, "a", "b").collect()
    assert len(got) == 201 and {r.component for r in got} == {0}
    odd = spark.createDataFrame([(1, None), (None, 2), (3, 3), (5, 4), (4, 5)], "x long, y long")
    assert helpers.rows_of(components(odd, "x", "y"), "node", "component") == [(4, 4), (5, 4)]


def test_each_group_keeps_a_row_where_ids_repeat(spark):
    a, b = helpers.prose(1, 60), helpers.prose(2, 60)
    first, last = sorted([a, b])
    rows = [(3, first), (5, first), (5, last), (7, last), (9, helpers.prose(3, 60)), (9, helpers.prose(4, 60)), (9, helpers.prose(4, 60)), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = helpers.rows_of(golay.first_of_group(docs), "doc_id", "text")
    want = [(3, first), (5, last), (9, helpers.prose(3, 60)), (9, helpers.prose(4, 60)), (None, a)]
    assert got == sorted(want, key=repr)


def test_keys_are_never_broadcast(spark, monkeypatch):
    """Spark takes the seventy keys of a fingerprint for one row, which no driver could hold."""
    plan = {}

    def kept(df, label, store=golay.store):
        plan[label] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, label)

    monkeypatch.setattr(golay, "store", kept)
    nodes = spark.createDataFrame([(v,) for v in (0, 1, 3, 1 << 40)], "fp long")
    found, _ = golay.links(nodes)
    plan["apart"] = found._jdf.queryExecution().executedPlan().toString()
    for label in ("stars", "apart"):
        assert "SortMergeJoin" in plan[label] and "Broadcast" not in plan[label], label
    assert {r.component for r in components(found, "a", "b").collect()} == {0}
