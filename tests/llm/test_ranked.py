import math
import random
import re
from collections import Counter

import helpers
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import ranked

LOWER = str.maketrans(ranked.UPPER, ranked.UPPER.lower())


def slow(docs, items, top=10):
    """Every score of every document, from the definition."""
    bags = [(i, Counter(re.findall(ranked.TERM, (t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, words = len(bags), sum(sum(b.values()) for _, b in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(re.findall(ranked.TERM, (t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        rows = []
        for i, bag in bags:
            m, score = 10 + (90 * sum(bag.values()) * n) // words, 0
            for t in terms & bag.keys():
                df = sum(t in b for _, b in bags)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:top])]
    return sorted(out, key=repr)


def table(spark, rows, key="doc_id"):
    return spark.createDataFrame(rows, f"{key} long, text string")


def test_equals_every_score(spark):
    docs = [(i, helpers.prose(i, 5 + i % 60, 300)) for i in range(400)]
    docs += [(i, t) for i, t in docs[:40]] + [(1000 + i, docs[7][1]) for i in range(30)]
    docs += [(2000 + i, t) for i, t in enumerate(helpers.ODD_TEXTS)] + [(None, "W1 w2 w3"), (5, "é É w1"), (6, "a" * 300 + "/b")]
    items = [(i, helpers.prose(5_000 + i, 12, 300)) for i in range(20)]
    items += [(50, None), (51, ""), (52, "A" * 300 + " É"), (None, "w1 W2"), (53, "w4"), (53, "w5"), (54, "neverseen"), (55, "naïve 中文 123")]
    got = ranked.search(table(spark, docs).repartition(3), table(spark, items, "item_id"))
    assert helpers.rows_of(got, "item_id", "rank", "doc_id", "score") == slow(docs, items)


def test_passes_over_blocks_of_items_add_up(spark, monkeypatch):
    docs = [(i, helpers.prose(i, 20, 200)) for i in range(100)]
    items = [(i, helpers.prose(900 + i, 8, 200)) for i in range(12)]
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 20)
    got = ranked.search(table(spark, docs), table(spark, items, "item_id"))
    assert helpers.rows_of(got, "item_id", "rank", "doc_id", "score") == slow(docs, items)


def test_clashing_columns_and_empty_tables(spark):
    docs, items = helpers.odd_docs(spark), table(spark, [(1, "word naïve a")], "item_id")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clash = items.withColumn("term", F.lit(1)).withColumn("doc_id", F.lit(2))
    assert helpers.rows_of(ranked.search(docs, clash), "item_id", "rank", "doc_id", "score") == slow(rows, [(1, "word naïve a")])
    assert ranked.search(helpers.no_docs(spark), items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 8])
def test_skipped_blocks_hold_nothing_better(monkeypatch, block):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    r = np.random.default_rng(block)
    topics = [r.choice(200, 30, replace=False) for _ in range(12)]
    rows = [np.unique(np.concatenate([r.choice(topics[i % 12], 12), r.choice(20, 3)])) for i in range(600)]
    asked = [np.unique(r.choice(topics[i % 12], 6)) for i in range(24)]
    df = np.bincount(np.concatenate(rows), minlength=200)
    flat, ends = np.concatenate(rows), np.cumsum([len(x) for x in rows])
    shares = (2_000 // (1 + df[flat])) * r.integers(1, 100, len(flat))
    piece = ranked.Piece(ranked.Items(asked, np.ones(200, np.int64), df), ends, flat, shares)
    ids = pa.array(r.permutation(600))
    for i, terms in enumerate(asked):
        best = ranked.Best(5, pa.int64())
        best.pool = ids
        piece.search(i, best)
        scores = [sum(s for t, s in zip(rows[d], shares[ends[d] - len(rows[d]) : ends[d]]) if t in terms) for d in range(600)]
        want = sorted((-int(s), ids[d].as_py()) for d, s in enumerate(scores) if s > 0)[:5]
        assert [(-a, b) for a, b in zip(*best.rows.to_pydict().values())] == want
    assert piece.skipped > piece.opened
    docs, borders, summary, columns = piece.blocks(int(asked[0][0]))
    for b in range(len(borders) - 1):  # a summary is the maximum of its documents, coordinate by coordinate
        for c, term in enumerate(columns):
            held = [shares[ends[d] - len(rows[d]) + list(rows[d]).index(term)] for d in docs[borders[b] : borders[b + 1]] if term in rows[d]]
            assert summary[b, c] == max(held, default=0)


def test_long_texts_are_cut_between_words():
    r = random.Random(3)
    text = " ".join("x" * r.randrange(1, 40) for _ in range(200_000))
    keys = ["x" * i for i in range(1, 30)]
    total, ends, number, count = ranked.TermTable(keys).vectors(pa.array([text, None, "x xx", text[:1]]))
    want = Counter(text.split())
    assert total.tolist() == [200_000, 0, 2, 1] and ends.tolist()[1:] == [ends[0], ends[0] + 2, ends[0] + 3]
    assert {keys[n]: c for n, c in zip(number[: ends[0]].tolist(), count.tolist())} == {k: want[k] for k in keys}


def test_products_beyond_64_bits():
    n, ends = np.array([10**9, 5]), np.array([1, 2])
    got = ranked.shares(n, ends, np.array([0, 0]), np.array([3, 1]), np.array([7]), 10**12, 10**15)
    m = [10 + 90 * x * 10**12 // 10**15 for x in n.tolist()]
    assert got.tolist() == [7 * (3 * 10**9 // (3000 + 8 * m[0])), 7 * (10**9 // (1000 + 8 * m[1]))]
