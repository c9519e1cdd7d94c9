import random

import helpers
import pytest

from textloom.llm import plans, tiling


def slow_coverage(item, text, least=3):
    """Greedy tiling as defined: find the longest unmarked common run, mark it, repeat."""
    a, b = [False] * len(item), [False] * len(text)
    least = min(least, len(item)) or 1
    covered = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered / len(item)
        a[i : i + n] = b[j : j + n] = [True] * n
        covered += n


def test_coverage_is_that_of_greedy_tiling():
    r = random.Random(5)
    for _ in range(300):
        item = [r.choice(b"abcd") for _ in range(r.randint(1, 14))]
        text = [r.choice(b"abcdxy") for _ in range(r.randint(0, 30))]
        item, text = ([bytes([c]) for c in x] for x in (item, text))
        assert tiling.coverage(item, text) == pytest.approx(slow_coverage(item, text))


def items(spark):
    rows = [(1, helpers.prose(1, 40)), (2, helpers.prose(2, 25)), (3, "one two three"), (4, None), (5, ""), (1, helpers.prose(1, 40))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_planted_passages(spark):
    one, two = helpers.prose(1, 40).split(), helpers.prose(2, 25).split()
    clean = helpers.prose(9, 300)
    half = clean.split()
    docs = [
        (1, clean),
        (2, " ".join(half[:100] + one + half[100:])),
        (3, " ".join(half[:50] + [w.upper() + "," for w in two])),
        (4, " ".join(one[20:] + half[:30] + one[:20])),  # reordered
        (5, " ".join(one[:20] + half)),  # half of an item
        (6, "here one two, three there"),
        (7, " ".join(half[:100] + one + half[100:])),
        (None, " ".join(two)),
    ]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], helpers.DOCS)
    got = helpers.rows_of(tiling.leaks(frame, items(spark)), "doc_id", "item_id")
    assert got == sorted([(2, 1), (3, 2), (4, 1), (6, 3), (7, 1), (None, 2)], key=repr)
    kept = tiling.without_leaks(frame, items(spark))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: tiling.words_of(r.text.lower().encode()) for r in plans.table(spark, sf, "documents").collect()}
    bench = {r.item_id: tiling.words_of(r.text.lower().encode()) for r in plans.table(spark, sf, "benchmark").collect()}
    seeds = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = {i: seeds(w) for i, w in bench.items()}
    want = [
        (d, i) for d, w in docs.items() for s in [seeds(w)] for i in bench if s & own[i] and tiling.coverage(bench[i], w) >= 0.8
    ]
    assert helpers.rows_of(plans.QUERIES["op2_decontamination"](spark, sf), "doc_id", "item_id") == sorted(want, key=repr)
    assert want


def test_odd_rows(spark):
    docs = helpers.odd_docs(spark)
    assert tiling.leaks(docs, items(spark)).count() == 0
    kept = tiling.without_leaks(docs, items(spark))
    assert kept.count() == docs.count() and kept.columns == docs.columns
    assert tiling.leaks(helpers.no_docs(spark), items(spark)).count() == 0
    assert tiling.leaks(docs, items(spark).limit(0)).count() == 0
    self_match = docs.select("doc_id", "text").filter("doc_id = 11")
    assert tiling.leaks(self_match, spark.createDataFrame([(1, "word " * 20)], "item_id long, text string")).count() == 1


def test_leaks_without_a_long_run(spark):
    one, two = helpers.prose(1, 40).split(), helpers.prose(2, 25).split()
    cut = lambda w, n: [w[i : i + n] for i in range(0, len(w), n)]
    back = lambda w, n: " ".join(" ".join(p) for p in reversed(cut(w, n)))
    clean = helpers.prose(9, 300)
    docs = [
        (1, back(one, 4)),
        (2, clean + " " + back(two[:24], 3) + " " + clean),  # 24 of 25 words
        (3, " ".join(" ".join(p[:4] + ["changed"]) for p in cut(one, 5))),  # 80 %
        (4, " ".join(" ".join(p + ["inserted"]) for p in cut(one, 4))),
        (5, " ".join(" ".join(p[:3] + ["changed"]) for p in cut(one, 4))),  # 75 %
        (6, " ".join(" ".join(p) for p in reversed(cut(one, 2)))),  # parts below a tile
        (7, clean),
        (None, back(one, 3) + " " + one[0]),
    ]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], helpers.DOCS)
    got = helpers.rows_of(tiling.leaks(frame, items(spark)), "doc_id", "item_id")
    assert got == sorted([(1, 1), (2, 2), (3, 1), (4, 1), (None, 1)], key=repr)
    kept = tiling.without_leaks(frame, items(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7]


def all_leaks(docs, bench):
    """Pairs by coverage alone, without candidates."""
    docs, bench = ([(k, tiling.words_of((t or "").lower().encode())) for k, t in x] for x in (docs, bench))
    return sorted(((d, i) for d, w in docs for i, own in bench if own and tiling.coverage(own, w) >= 0.8), key=repr)


def test_candidates_lose_no_pair(spark):
    r = random.Random(11)
    words = lambda n: " ".join(r.choice("abcdef") for _ in range(n))
    bench = [(i, words(r.randint(1, 14))) for i in range(40)]
    docs = [(i, words(r.randint(0, 40))) for i in range(150)]
    want = all_leaks(docs, bench)
    got = tiling.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert helpers.rows_of(got, "doc_id", "item_id") == want and want


def test_query_matches_coverage_of_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in plans.table(spark, sf, "documents").collect()]
    bench = [(r.item_id, r.text) for r in plans.table(spark, sf, "benchmark").collect()]
    want = all_leaks(docs, bench)
    assert helpers.rows_of(plans.QUERIES["op2_decontamination"](spark, sf), "doc_id", "item_id") == want and want
