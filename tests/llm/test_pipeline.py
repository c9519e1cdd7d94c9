import zlib

import corpus_pipeline
import helpers
import numpy as np
import pytest

from textloom.llm import golay, language, plans, tiling

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, folder):
    """Each stage, on what the one before kept, does what its operator's brute-force version says."""
    docs = plans.table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        before, after = docs.collect(), out.collect()
        ids = {r.doc_id for r in after}
        if name != "token_ids":
            assert out.columns == columns and set(after) <= set(before)
        if name == "language_id":
            assert len(after) > 0.99 * len(before)
        if name == "near_dedup":
            fps = {r.doc_id: golay.fingerprint(r.text.encode()) for r in before}
            bits = np.unpackbits(np.array(list(fps.values()), np.uint64).view(np.uint8).reshape(-1, 8), axis=1).astype(int)
            near = (bits[:, None] != bits[None]).sum(2) <= 4
            order = np.array(list(fps))
            label = order.copy()
            while True:
                new = np.where(near, label[None], label.max() + 1).min(1)
                if (new == label).all():
                    break
                label = new
            assert ids == {int(i) for i, c in zip(order, label) if i == c} and len(after) == len(ids)
        if name == "decontamination":
            bench = [tiling.words_of(r.text.lower().encode()) for r in plans.table(spark, SF, "benchmark").collect()]
            for row in before:
                words = tiling.words_of(row.text.lower().encode())
                if row.doc_id in ids:
                    assert all(b"\0" + b" ".join(b) not in b"\0" + b" ".join(words) for b in bench)
        if name == "mixing":
            sizes = {r.doc_id: len(r.text.split()) for r in before}
            total = sum(sizes.values())
            assert abs(sum(sizes[r.doc_id] for r in after) - total) < 0.1 * total
        if name == "token_ids":
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(plans.tokenizer_path())
            want, start = [], 0
            for row in sorted(before, key=lambda r: r.doc_id):
                codes = np.array([*library.encode(row.text, add_special_tokens=False).ids, 0], "<u4")
                want.append((row.doc_id, start, len(codes), zlib.crc32(codes.tobytes())))
                start += len(codes)
            assert sorted(map(tuple, out.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(want)
        docs = out


@pytest.mark.parametrize("make", [helpers.odd_docs, helpers.no_docs])
def test_stages_take_odd_tables(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 0
        if name != "token_ids":
            assert out.columns == docs.columns


def test_run_is_registered(spark):
    import __spark_entry__ as driver

    assert driver.queries()["pipeline"] is corpus_pipeline.run and language is not None
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_near_copies_broadcast_no_keys(spark, monkeypatch):
    """The stage sends no keys through the driver, however few Spark takes them for."""
    plan = {}

    def kept(df, label, store=golay.store):
        plan[label] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, label)

    def linked(nodes, links=golay.links):
        found, paths = links(nodes)
        plan["apart"] = found._jdf.queryExecution().executedPlan().toString()
        return found, paths

    monkeypatch.setattr(golay, "store", kept)
    monkeypatch.setattr(golay, "links", linked)
    docs = plans.table(spark, "/root/testdata/sf0.001", "documents")
    assert 0 < corpus_pipeline.near_dedup(spark, docs, SF).count() <= docs.count()
    assert all("MapInArrow" in plan[label] and "Broadcast" not in plan[label] for label in ("stars", "apart"))
