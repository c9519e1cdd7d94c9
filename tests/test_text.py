import math
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import numbers, text, times
from textloom.operators import batches, chat, chunks, model, ranking, tokens


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_output_name_replaces_every_source_extension(spark):
    assert one(spark, text.output_name(F.lit("/a.pdf/b.pdf.pdf"))) == "b.txt.txt"


def test_html_text(spark):
    html = "<html><script>if(a<b){}</script><style>p{}</style><!-- <b>no</b> --><p>A &amp;lt; B</p>\n<p>C&nbsp;D</p>"
    assert one(spark, text.html_text(F.lit(html))) == "A &lt; B C D"


def test_split_list(spark):
    assert one(spark, text.split_list(F.lit("a,b"))) == ["a", "b"]
    assert one(spark, text.split_list(F.lit(""))) == [""]
    assert one(spark, text.split_list(F.lit(""), empty_as_null=True)) is None


def test_numbers(spark):
    assert one(spark, numbers.percent(F.lit(22931.0), F.lit(81920.0))) == 28.0
    assert one(spark, numbers.percent_floor(F.lit(22931), F.lit(81920))) == 27
    assert one(spark, numbers.perplexity_of(F.lit(2.099456310272217))) == pytest.approx(8.161731, abs=1e-5)
    for batch, accum, effective in [(19, 1, 19), (64, 1, 64), (8, 4, 32)]:
        assert one(spark, numbers.grad_accum(F.lit(batch))) == accum
        assert one(spark, numbers.effective_batch(F.lit(batch))) == effective


def test_durations_and_names(spark):
    assert one(spark, times.duration_text(F.lit(1452.9))) == "0h 24m 12s"
    assert one(spark, times.parse_duration(F.lit("0h 24m 12s"))) == 1452
    started = F.lit("2025-03-25 01:17:32").cast("timestamp_ntz")
    assert one(spark, times.run_name(F.lit(None).cast("string"), started)) == "run-20250325-011732"
    assert one(spark, times.run_name(F.lit("mine"), started)) == "mine"
    assert one(spark, times.parse_log_stamp(F.lit("no time here, just text - really"))) is None


# --- ranking ------------------------------------------------------------------------------------


def test_global_rank_equals_one_window(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("epoch"))
    ranked = ranking.global_rank(frame, ["doc_id"], within=["epoch"])
    plain = Window.partitionBy("epoch").orderBy(ranking.shuffle_hash(42, "doc_id"), "doc_id")
    want = frame.withColumn("rank", F.row_number().over(plain))
    columns = ["doc_id", "epoch", "rank"]
    assert sorted(map(tuple, ranked.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_sorted_rank_is_dense_and_ordered(spark):
    frame = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("v")).repartition(11)
    rows = ranking.sorted_rank(frame, [F.desc("v")]).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(3000))
    assert [r.v for r in rows] == sorted((r.v for r in rows), reverse=True)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_extremes_with_a_hot_group(spark, inclusive):
    """One group holds most rows and spans many blocks."""
    frame = spark.range(2000).select(
        F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(99).alias("run"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 > 0, F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"),
    )
    got = ranking.running_extremes(
        frame, "run", "seq", {"hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}, inclusive, block_rows=64
    )
    w = Window.partitionBy("run").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = frame.withColumns({"hi": F.max("v").over(w), "lo": F.min("v").over(w)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sample_is_exact_and_stable(spark):
    frame = spark.range(1000).withColumnRenamed("id", "doc_id")
    first = {r.doc_id for r in ranking.sample_n(frame, ["doc_id"], 256).collect()}
    second = {r.doc_id for r in ranking.sample_n(frame.repartition(9), ["doc_id"], 256).collect()}
    assert first == second and len(first) == 256
    assert ranking.sample_n(frame.limit(10), ["doc_id"], 256).count() == 10
    assert ranking.first_n(frame.limit(10), ["doc_id"], 256).count() == 10


# --- tokens -------------------------------------------------------------------------------------


@pytest.fixture
def vocab(spark):
    counts = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "token string, n long")
    return tokens.vocabulary(counts)


def test_vocabulary_order_and_size(spark, vocab):
    assert {r.token: r.id for r in vocab.collect()} == {"c": 4, "a": 5, "b": 6, "d": 7}
    small = tokens.vocabulary(vocab.select("token", "n"), max_size=2)
    assert {r.token: r.id for r in small.collect()} == {"c": 4, "a": 5}
    assert tokens.vocabulary(vocab.select("token", "n"), max_size=50).count() == 4


@pytest.mark.parametrize("head", [tokens.HEAD_TOKENS, 1, 0])
def test_encode(spark, vocab, head, monkeypatch):
    """Where the head ends, and the join begins, changes nothing."""
    monkeypatch.setattr(tokens, "HEAD_TOKENS", head)
    chunks = spark.createDataFrame(
        [(1, 0, "c x a"), (1, 1, ""), (2, 0, "a b c d a b"), (3, 0, "   ")], "doc_id long, chunk_no int, text string"
    )
    rows = {(r.doc_id, r.chunk_no): r for r in tokens.encode(chunks, vocab, 5).collect()}
    assert len(rows) == 4
    assert rows[1, 0].input_ids == [2, 4, 1, 5, 0]
    assert rows[1, 0].attention_mask == [1, 1, 1, 1, 0]
    assert rows[1, 0].special_tokens_mask == [1, 0, 0, 0, 1]
    assert rows[1, 1].input_ids == rows[3, 0].input_ids == [2, 0, 0, 0, 0]
    assert rows[2, 0].input_ids == [2, 5, 6, 4, 7] and rows[2, 0].attention_mask == [1] * 5
    as_eos = tokens.encode(chunks, vocab, 5, pad_is_eos=True).filter("doc_id = 1 and chunk_no = 0")
    assert as_eos.first().input_ids == [2, 4, 1, 5, 3]
    labels = as_eos.select(tokens.causal_labels(F.col("input_ids"), tokens.EOS).alias("l")).first().l
    assert labels == [2, 4, 1, 5, -100]


def test_tokenizer_hook_is_made_once_per_task(spark):
    def tokenizer():
        return lambda texts: [[len(t)] for t in texts]

    frame = spark.createDataFrame([("abc",), ("",)], "text string")
    assert sorted(r.tokens[0] for r in tokens.tokenize_with(frame, tokenizer, item="bigint").collect()) == [0, 3]


def test_truncation_report(spark):
    frame = spark.createDataFrame([(3,), (10,)], "n_tokens int")
    assert tuple(tokens.truncation_report(frame, max_length=6).first()) == (2, 1, 8, 5, round(2 / 12, 6))


def test_chat_is_one_row_per_conversation(spark):
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit(" \n"), "id", F.lit("\t")).alias("text"))
    rows = chat.chat_encode(turns).collect()
    assert len(rows) == 1 and rows[0].text.count("<|eot_id|>") == 3000
    assert rows[0].text.startswith("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n0<|eot_id|><|start_header_id|>")


# --- batches ------------------------------------------------------------------------------------


def test_epochs_cover_everything_in_new_order(spark):
    frame = spark.range(103).withColumnRenamed("id", "doc_id")
    rows = batches.epoch_batches(frame, ["doc_id"], 2, 10, accumulation=4).collect()
    for epoch in (0, 1):
        mine = sorted((r.batch_id, r.pos_in_batch, r.step, r.doc_id) for r in rows if r.epoch == epoch)
        assert sorted(m[3] for m in mine) == list(range(103))
        assert [(m[0], m[1]) for m in mine] == [(i // 10, i % 10) for i in range(103)]
        assert all(m[2] == m[0] // 4 for m in mine)
    orders = [[r.doc_id for r in sorted(rows, key=lambda r: (r.batch_id, r.pos_in_batch)) if r.epoch == e] for e in (0, 1)]
    assert orders[0] != orders[1]


def test_frontier_against_brute_force(spark):
    generator = random.Random(3)
    for _ in range(3):
        costs = [generator.randrange(1, 60) for _ in range(40)]
        budget = generator.randrange(60, 400)
        frame = spark.createDataFrame(list(enumerate(costs)), "i int, cost int")
        frontier = batches.batch_size_frontier(frame, ["i"], "cost", 1, 20, budget)
        fits = {
            b: max(sum(costs[i : i + b]) for i in range(0, 40, b)) <= budget for b in range(1, 21)
        }
        assert {r.batch_size: r.fits for r in frontier.collect()} == fits
        best = batches.largest_batch(frontier, 1, 20).first()
        assert best.largest_fit == max((b for b in fits if fits[b]), default=None)
        assert best.largest_safe == max((b for b in fits if all(fits[c] for c in range(1, b + 1))), default=None)


def test_no_size_fits(spark):
    frame = spark.createDataFrame([(1, 50)], "i int, cost int")
    best = batches.largest_batch(batches.batch_size_frontier(frame, ["i"], "cost", 1, 4, 10), 1, 4).first()
    assert tuple(best) == (None, None)


def scorer_of_masked_losses():
    def masked_losses():  # made here, so that it travels by value
        return lambda rows, labels: [float(sum(x for x in gold.tolist() if x != -100)) for gold in labels]

    return masked_losses


def test_evaluation_does_not_depend_on_the_partitioning(spark):
    """Labels are masked unevenly, so a mean per batch depends on which rows share it."""
    rows = [(i, 0, [i] * 6, [-100] * (i % 6) + [i] * (6 - i % 6)) for i in range(103)]
    frame = spark.createDataFrame(rows, "doc_id long, chunk_no int, input_ids array<int>, labels array<int>")
    want, weight = 0.0, 0
    for at in range(0, 103, 4):
        part = rows[at : at + 4]
        gold = [x for r in part for x in r[3] if x != -100]
        want, weight = want + sum(gold) / len(gold) * 6 * len(part), weight + 6 * len(part)
    for parts in (1, 3, 5):
        scores = batches.score_rows(frame.repartition(parts), scorer_of_masked_losses())
        found = batches.score_batches(scores, batches.evaluation_plan(scores)).collect()
        assert sum(r.loss * r.positions for r in found) == pytest.approx(want) and sum(r.positions for r in found) == weight


def test_a_batch_without_labels_has_no_loss(spark):
    frame = spark.createDataFrame([(1, 0, [5], [-100])], "doc_id long, chunk_no int, input_ids array<int>, labels array<int>")
    scores = batches.score_rows(frame, scorer_of_masked_losses())
    row = batches.score_batches(scores, batches.evaluation_plan(scores)).first()
    assert (row.loss, row.positions) == (None, 1)


# --- count model --------------------------------------------------------------------------------


def test_bigram_perplexity_by_hand(spark):
    train = spark.createDataFrame([(1, "en", "a b a b"), (2, "en", "a c")], "doc_id long, lang string, text string")
    test = spark.createDataFrame([(3, "en", "a b z"), (4, "en", "")], "doc_id long, lang string, text string")
    k, classes = 0.5, 4
    steps = [(2, 2), (2, 3), (0, 2)]  # (<s>,a) twice of two; (a,b) twice of three; (b,z) never of one
    steps[2] = (0, 1)
    loss = -sum(math.log((n + k) / (c + k * classes)) for n, c in steps) / 3
    rows = model.lm_perplexity(train, test, k).collect()
    assert len(rows) == 3
    for row in rows:
        assert row.tokens == 3 and row.loss == pytest.approx(loss, abs=1e-6)
    counts = {(r.context, r.token): (r.n, r.context_n) for r in model.ngram_lm(train).collect()}
    assert counts["a", "b"] == (2, 3) and counts["<s>", "a"] == (2, 2)


def test_sweep_by_hand(spark):
    """A corpus in which one token is most of the text, against direct counting."""
    rows = [(i, "train" if i % 4 else "test", "hot " * (5 + i % 3) + f"w{i % 5} z{i}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, split string, text string")
    got = {(r.order, r.vocab_size, r.k): (r.tokens, r.loss) for r in model.sweep(frame, [3, 1000], [0.5]).collect()}

    from collections import Counter

    train, test = Counter(), Counter()
    for _, split, line in rows:
        words = line.split()
        (train if split == "train" else test).update(zip(["<s>", *words], words))
    counts = Counter()
    for (_, token), n in train.items():
        counts[token] += n
    ranked = sorted(counts, key=lambda t: (-counts[t], t))
    for size in (3, 1000):
        inside = set(ranked[:size]) | {"<s>"}

        def mapped(pairs):
            out = Counter()
            for (context, token), n in pairs.items():
                out[context if context in inside else None, token if token in inside else None] += n
            return out

        n, m = mapped(train), mapped(test)
        uni, context_n = Counter(), Counter()
        for (context, token), value in n.items():
            uni[token] += value
            context_n[context] += value
        classes, total = len(uni) + 1, sum(uni.values())
        for order in (1, 2):
            loss = -sum(
                value
                * math.log(
                    (uni[token] + 0.5) / (total + 0.5 * classes)
                    if order == 1
                    else (n[context, token] + 0.5) / (context_n[context] + 0.5 * classes)
                )
                for (context, token), value in m.items()
            ) / sum(m.values())
            assert got[order, size, 0.5] == (sum(m.values()), pytest.approx(loss, abs=2e-6))


def test_functions_travel_by_value():
    """Workers of a job started elsewhere cannot import the package."""
    from pyspark import cloudpickle

    assert "textloom" in cloudpickle.list_registry_pickle_by_value()


def test_a_document_of_very_many_paragraphs_is_cut_once(spark):
    text = "\n".join(f"p{i} " + "x" * (i % 90) for i in range(20_000))
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    cut = chunks.chunk_paragraphs(df, "\n", 100)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("aggregate(") == 1
    start = time.perf_counter()
    rows = cut.orderBy("chunk_no").collect()
    assert time.perf_counter() - start < 30
    assert "\n".join(r.text for r in rows) == text and {r.doc_id for r in rows} == {1}
    assert [r.chunk_no for r in rows] == list(range(len(rows)))


def test_other_tokens_repeat_in_and_across_chunks(spark, vocab, monkeypatch):
    monkeypatch.setattr(tokens, "HEAD_TOKENS", 1)
    frame = spark.createDataFrame(
        [(1, 0, "b zz b a yy b"), (1, 1, "zz zz"), (None, 0, "b a"), (2, 0, ""), (2, 1, None)], "doc_id int, chunk_no int, text string"
    )
    ids = {r.token: r.id for r in vocab.collect()}
    for r in tokens.encode(frame, vocab, 8).join(frame, ["doc_id", "chunk_no"]).collect():
        want = [tokens.BOS] + [ids.get(t, tokens.UNK) for t in (r.text or "").split()]
        assert r.input_ids == want + [tokens.PAD] * (8 - len(want))


def test_tokenizer_batches_are_bounded_by_their_texts(spark):
    texts = ["x" * 1_000] * 2_000 + ["y" * (2 * tokens.HOOK_CHARS), "", "z"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    tokenizer = lambda: lambda batch: [[len(text), sum(map(len, batch))] for text in batch]
    got = tokens.tokenize_with(frame, tokenizer, item="bigint").orderBy("id").collect()
    assert [r.tokens[0] for r in got] == [len(text) for text in texts]
    assert max(r.tokens[1] for r in got if r.text[:1] == "x") <= tokens.HOOK_CHARS + 1_000
    assert max(r.tokens[1] for r in got) <= 3 * tokens.HOOK_CHARS
