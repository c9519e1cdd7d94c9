import helpers
import numpy as np
import pyarrow as pa

from textloom.llm import language, plans

SF = "/root/testdata/sf0.01"
OF = {
    "xx": "kala mola tula neki soru veki lamo tiko".split(),
    "yy": "zwrt brzk strn plch gdrt krsz wrzs zdrb".split(),
}


def two_languages(spark, n=300):
    r = np.random.default_rng(1)
    rows = [(i, " ".join(r.choice(OF[lang], 3 + i % 40)), lang) for i in range(n) for lang in [("xx", "yy")[i % 2]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_windows_stay_inside_words_and_texts():
    texts = ["ab cd", "", "e", "abc!", "défg"]
    body, offsets = language.utf8(pa.array(texts))
    together = list(language.subwords(body, offsets))
    for i, text in enumerate(texts):
        alone = language.subwords(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        for whole, part in zip(together, alone):
            assert whole[offsets[i] : offsets[i + 1]].tolist() == part.tolist()


def test_held_out_accuracy(spark):
    docs = plans.table(spark, SF, "documents")
    got = plans.QUERIES["op3_language"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in got if r.held_out]
    assert len(got) == docs.count() and len(test) > 200
    assert np.mean([r.lang_pred == r.lang for r in test]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01


def test_odd_rows_and_rejection(spark):
    model = language.train(two_languages(spark))
    assert model.classes == ["xx", "yy"] and model.facts["kept_out_accuracy"] > 0.98
    docs = helpers.odd_docs(spark)
    got = language.identify(docs, model)
    assert got.count() == docs.count() and set(docs.columns) - {"score", "rejected"} <= set(got.columns)
    for row in got.collect():
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and (letters or (row.rejected and row.score == 0))
    alien = spark.createDataFrame([(1, "中文文字测试内容句子", "xx")], "doc_id long, text string, lang string")
    assert language.identify(alien, model).first().score < 0.9


def test_batches_and_copies_give_equal_results(spark):
    model = language.train(two_languages(spark))
    texts = [helpers.prose(i, 50) + " kala zwrt" for i in range(20)] * 2 + [None, "", "kala " * 400_000]
    best, score = model.predict(pa.array(texts))
    for i, text in enumerate(texts):
        b, s = model.predict(pa.array([text], pa.string()))
        assert b[0] == best[i] and abs(s[0] - score[i]) < 1e-9


def test_held_out_rows_are_never_learned(spark):
    docs = two_languages(spark)
    wrong = docs.withColumn("lang", language.F.when(language.held_out("doc_id"), "zz").otherwise(language.F.col("lang")))
    assert language.train(wrong).classes == ["xx", "yy"]


def test_filter_and_empty_tables(spark):
    docs = two_languages(spark).withColumn("lang_pred", language.F.lit(1))
    kept = language.accepted(docs)
    assert kept.columns == docs.columns and kept.count() >= 295
    empty = helpers.no_docs(spark)
    assert language.accepted(empty).columns == empty.columns and language.accepted(empty).count() == 0
    assert language.accepted(helpers.odd_docs(spark).limit(0)).count() == 0


def test_few_odd_rows_do_not_set_the_threshold(spark):
    r = np.random.default_rng(3)
    odd = lambda: " ".join("".join(chr(c) for c in r.integers(0x4E00, 0x9FFF, 6)) for _ in range(3))
    rows = [(i, odd() if i % 151 == 1 else t, lang) for i, t, lang in map(tuple, two_languages(spark, 4_000).collect())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, sample_rows=420, reject_rate=0.01)
    told = language.identify(docs.filter("doc_id % 151 != 1"), model)
    assert told.filter("rejected").count() <= 0.01 * 4_000
    texts = ["это русский текст о погоде и о доме", "שלום עולם זה טקסט בעברית", "kala mola tula", "zwrt brzk strn"]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.rejected for x in language.identify(few, model).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False}, (model.threshold, model.temperature)


def test_texts_have_a_boundary_on_either_side():
    texts = ["A.", "ab", "x", "", "kala mola", "ñ", "!a"]
    body, offsets = language.utf8(pa.array(texts))
    together = list(language.subwords(body, offsets))
    for i, text in enumerate(texts):
        spaced = np.frombuffer(f"  {text}  ".encode(), np.uint8)
        for whole, alone in zip(together, language.subwords(spaced, np.array([0, len(spaced)]))):
            own = whole[offsets[i] : offsets[i + 1]]
            assert own[own >= 0].tolist() == alone[alone >= 0].tolist()
    assert all((together[0][offsets[i] : offsets[i + 1]] >= 0).any() for i, t in enumerate(texts) if t)
def slow_prediction(model, text):
    """Window after window, from the definition."""
    raw = bytes(language.NORMAL[b] for b in text.encode())
    raw, rows = b" " + raw + b" ", []
    for k, (size, factor) in enumerate(zip(language.WINDOWS, language.FACTORS)):
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            if b" " not in window[1:-1]:
                code = int.from_bytes(window, "little")
                rows.append(model.table[((code * factor) % 2**32 >> 17) + k * language.BUCKETS])
    logits = np.sum(rows, axis=0, dtype=float) / max(len(rows), 1) + model.bias
    p = np.exp(logits / model.temperature)
    return model.classes[int(np.argmax(p))], float(np.max(p) / p.sum())


def test_predictions_recomputed_slowly(spark):
    model = language.train(two_languages(spark))
    r = np.random.default_rng(3)
    texts = [" ".join(r.choice(OF[("xx", "yy")[i % 2]], 1 + i)) for i in range(30)] + ["A", "ab", "Äö kala!", "zwrt kala mola zwrt"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in language.identify(docs, model).collect():
        lang, score = slow_prediction(model, row.text)
        assert row.lang_pred == lang and abs(row.score - score) < 1e-5


def test_the_sample_is_the_smallest_hashes_of_each_label(spark, monkeypatch):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'kala' as text", "if(id % 7 = 0, 'a', 'b') as lang")
    known = docs.selectExpr("doc_id as id", "lang as label", "shiftrightunsigned(xxhash64(doc_id), 1) as at")
    got = language._smallest(known, 500)
    for label in "ab":
        every = sorted(r.at for r in known.filter(f"label = '{label}'").collect())
        some = sorted(r.at for r in got.filter(f"label = '{label}'").collect())
        assert some[:500] == every[:500] and len(some) < 1_500


def test_columns_with_helpers_names_stay_as_they_were(spark):
    names = ["_rejected_text", "_rejected_lang", "_rejected_score", "_REJECTED", "_found", "_own_text", "_lang", "_score"]
    docs = two_languages(spark).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    got = language.accepted(docs)
    assert got.columns == docs.columns and got.count() > 250 and got.exceptAll(docs).count() == 0
