import os

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from textloom.operators import documents as docs
from textloom.operators.chunks import chunk_paragraphs, first_chunks
from textloom.operators.split import apply_split, corpus_counts, split_overlap, train_test_split
from textloom.plans import corpus as plans
from textloom.sources import cache, files, manifest


@pytest.fixture
def corpus_folder(folder):
    for i in range(10):
        with open(os.path.join(folder, f"a{i}.txt"), "w") as f:
            f.write(f"text {i}\r\nline\rend" if i else "")
    with open(os.path.join(folder, "bad.txt"), "wb") as f:
        f.write(b"abc\xff\xfe")
    with open(os.path.join(folder, "other.TXT"), "w") as f:
        f.write("no")
    os.mkdir(os.path.join(folder, "sub"))
    with open(os.path.join(folder, "sub", "deep.txt"), "w") as f:
        f.write("no")
    return folder


def test_discover_one_extension_not_recursive(spark, corpus_folder):
    found = files.discover(spark, corpus_folder, ".txt")
    # a0.txt is empty: Spark's file sources do not list files without content
    assert sorted(r.file_name for r in found.collect()) == sorted([f"a{i}.txt" for i in range(1, 10)] + ["bad.txt"])
    assert found.columns == ["path", "file_name", "length", "modificationTime"]


def test_in_folder_excludes_subfolders(spark):
    listing = spark.createDataFrame([("/c/a.txt",), ("/c/s/b.txt",), ("/c/a.TXT",)], "path string")
    kept = listing.filter(files.in_folder(F.col("path"), ".txt", "/c")).collect()
    assert [r.path for r in kept] == ["/c/a.txt"]


def test_read_texts_isolates_invalid_files(spark, corpus_folder):
    rows = {os.path.basename(r.path): r for r in files.read_texts(spark, corpus_folder).collect()}
    assert rows["bad.txt"].text is None and rows["bad.txt"].error == "invalid UTF-8"
    assert "a0.txt" not in rows and rows["a1.txt"].text == "text 1\nline\nend"


def test_extractor_failures_become_rows(spark):
    def fail():
        raise ValueError("page broke")

    def extractor(data):
        if data == b"broken":
            raise ValueError("file broke")
        return [data.decode(), fail, "", "last"]

    raw = spark.createDataFrame([(1, b"one"), (2, b"broken")], "doc_id long, content binary")
    pages = docs.extract_pages(raw, extractor, page_limit=3)
    rows = sorted(pages.collect(), key=lambda r: (r.doc_id, r.page_no or 0))
    assert [(r.doc_id, r.page_no, r.text, r.error) for r in rows] == [
        (1, 0, "one", None),
        (1, 1, None, "page broke"),
        (1, 2, "", None),
        (2, None, None, "file broke"),
    ]
    assembled = docs.assemble_documents(pages)
    assert assembled.filter("doc_id = 1").first().text == "one\n\n"


def test_extractor_is_not_read_past_the_limit(spark):
    def extractor(data):
        yield "first"
        yield "second"
        raise RuntimeError("read too far")

    raw = spark.createDataFrame([(1, b"x")], "doc_id long, content binary")
    assert [r.error for r in docs.extract_pages(raw, extractor, page_limit=2).collect()] == [None, None]


def test_limit_counts_empty_pages_and_pages_end_with_a_blank_line(spark):
    pages = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, ""), (1, 3, "d"), (2, 0, None)], "doc_id long, page_no int, text string")
    rows = {r.doc_id: (r.text, r.n_chars) for r in docs.assemble_documents(pages, limit=3).collect()}
    assert rows == {1: ("a\n\nc\n\n", 6), 2: ("", 0)}


def test_rejects_name_the_reason(spark):
    frame = spark.createDataFrame(
        [(1, "x" * 10, None), (2, "x", None), (3, None, "boom")], "doc_id long, text string, error string"
    )
    assert {r.doc_id: r.reason for r in docs.rejects(frame, 5).collect()} == {2: "too short", 3: "error"}


def test_counts_are_observed_in_passing(spark, folder):
    seen = Observation()
    frame = spark.createDataFrame([(1, "x" * 9), (2, "x")], "doc_id long, text string")
    docs.min_chars(docs.observe_kept(frame, seen, 5), 5).write.parquet(os.path.join(folder, "kept"))
    assert seen.get == {"found": 2, "kept": 1}


def test_length_is_code_points(spark):
    frame = spark.createDataFrame([("é🙂a",)], "text string")
    assert docs.min_chars(frame, 3).count() == 1 and docs.min_chars(frame, 4).count() == 0


def test_incremental_keeps_short_leftovers(spark):
    sources = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x" * 9)], "doc_id long, text string")
    done = spark.createDataFrame([(1, "y"), (9, "z")], "doc_id long, text string")
    rows = docs.incremental_ingest(sources, done, 5).collect()
    assert sorted((r.doc_id, r.text, r.origin) for r in rows) == [(1, "y", "done"), (3, "x" * 9, "new"), (9, "z", "done")]


def test_new_documents_are_appended_once(spark, folder):
    path = os.path.join(folder, "kept")
    first = spark.createDataFrame([(1, "x" * 9), (2, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in docs.append_new(first, path, 5).collect()) == [1]
    more = first.unionByName(spark.createDataFrame([(3, "y" * 9)], first.schema))
    for _ in range(2):
        assert sorted((r.doc_id, r.text) for r in docs.append_new(more, path, 5).collect()) == [(1, "x" * 9), (3, "y" * 9)]


def test_assembly_without_limit_and_of_whole_documents(spark):
    pages = spark.createDataFrame(
        [(1, i, f"p{i}", None) for i in range(40)] + [(2, 0, "a", None), (2, 1, None, "torn")], "doc_id long, page_no int, text string, error string"
    )
    whole = {r.doc_id: r.text.count("p") for r in docs.assemble_documents(pages, limit=None).collect()}
    assert whole == {1: 40, 2: 0}
    assert [r.doc_id for r in docs.assemble_documents(pages, whole_only=True).collect()] == [1]


def test_unreadable_files_carry_an_error(spark, folder):
    for name, body in (("a b%.txt", b"good\r\n"), ("bad.txt", b"\xff")):
        with open(os.path.join(folder, name), "wb") as f:
            f.write(body)
    rows = {os.path.basename(r.path): (r.text, r.error) for r in files.read_texts(spark, folder).collect()}
    assert rows == {"a b%.txt": ("good\n", None), "bad.txt": (None, "invalid UTF-8")}


def test_split_sizes_and_stability(spark):
    frame = spark.range(830).withColumnRenamed("id", "doc_id")
    once = {r.doc_id: r.split for r in train_test_split(frame).collect()}
    again = {r.doc_id: r.split for r in train_test_split(frame.repartition(7).orderBy(F.rand())).collect()}
    assert once == again
    assert sorted(list(once.values()).count(s) for s in ("train", "test")) == [83, 747]
    other = {r.doc_id: r.split for r in train_test_split(frame, seed=7).collect()}
    assert other != once


@pytest.mark.parametrize("n,ratio,train", [(0, 0.9, 0), (1, 0.9, 0), (2, 0.9, 1), (10, 0.0, 0), (10, 1.0, 10)])
def test_split_edges(spark, n, ratio, train):
    frame = spark.range(n).withColumnRenamed("id", "doc_id")
    assert train_test_split(frame, ratio=ratio).filter("split = 'train'").count() == train


def test_hot_group_of_copies_stays_on_one_side(spark):
    frame = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "same").otherwise(F.col("id").cast("string")).alias("digest"))
    split = train_test_split(frame, ["digest"], distinct_keys=True)
    assert split.filter("digest = 'same'").select("split").distinct().count() == 1
    assert split.select("digest", "split").distinct().filter("split = 'train'").count() == int(201 * 0.9)
    assert split_overlap(split, "digest").count() == 0


def test_overlap_is_reported(spark):
    frame = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train")], "digest string, split string")
    assert [tuple(r) for r in split_overlap(frame, "digest").collect()] == [("a", 1, 1)]


def test_counts(spark):
    frame = spark.createDataFrame([(600, "train"), (700, "test"), (10, None)], "n_chars long, split string")
    assert tuple(corpus_counts(frame).first()) == (3, 2, 1, 1)


def test_manifest_round_trip(spark, folder):
    named = spark.range(25).select(F.col("id").alias("doc_id"), F.concat(F.lit("d"), "id", F.lit(".txt")).alias("file_name"))
    rows = manifest.manifest_rows(named, created_at=F.lit("2024-01-01 00:00:00"))
    assert {(r.train_size, r.test_size, r.created_at) for r in rows.collect()} == {(22, 3, "2024-01-01 00:00:00")}
    path = os.path.join(folder, "m")
    manifest.write_manifest(rows, path)
    members = manifest.read_manifest(spark, path)
    want = {r.file_name: r.split for r in train_test_split(named).collect()}
    assert {r.file_name: r.split for r in members.collect()} == want and members.count() == 25
    assert apply_split(named, members, "file_name").count() == 25
    again = manifest.load_or_split(spark, named.limit(3), path)
    assert again.count() == 25  # the stored manifest wins


def test_write_documents_by_split(spark, folder):
    frame = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "doc_id long, text string, split string")
    path = os.path.join(folder, "docs")
    files.write_documents(frame, path, by_split=True)
    assert sorted(p for p in os.listdir(path) if "=" in p) == ["split=test", "split=train"]
    assert spark.read.parquet(path).count() == 2


def test_fingerprint_ignores_order_but_not_content(spark):
    def of(rows, parts=1):
        frame = spark.createDataFrame(rows, "path string, mtime long").repartition(parts)
        return cache.fingerprint(frame, cache.file_entry(F.col("path"), F.col("mtime"))).first().fingerprint

    rows = [("a", 1), ("b", 2), ("c", 3)]
    assert of(rows) == of(rows[::-1], 5)
    assert of(rows) != of([("a", 1), ("b", 2), ("c", 4)])
    assert of(rows) != of(rows + [("a", 1)])
    assert of(rows + [("a", 1), ("a", 1)]) != of(rows + [("b", 2), ("b", 2)])


def test_cached_dataset_builds_once_per_key(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    frame = spark.range(3).select(F.col("id").cast("string").alias("e"))
    key = cache.dataset_key(spark, frame, F.col("e"), limit=1, run=os.urandom(8).hex())
    assert cache.cached_dataset(spark, "stage", key, build).count() == 5
    assert cache.cached_dataset(spark, "stage", key, build).count() == 5
    assert built == [1]
    assert cache.dataset_key(spark, frame, F.col("e"), limit=2) != cache.dataset_key(spark, frame, F.col("e"), limit=3)


# --- paragraph packing --------------------------------------------------------------------------

CASES = [
    (["aaaa", "bbbb", "cc"], ["aaaa\n\nbbbb", "cc"]),
    (["a" * 15], ["a" * 15]),
    (["", "aa"], ["aa"]),
    (["aa", "", "bb"], ["aa\n\n\n\nbb"]),
    (["aa", ""], ["aa\n\n"]),
    ([""], []),
    (["a" * 15, "", "bb"], ["a" * 15, "bb"]),
    (["", "", ""], []),
    ([" "], [" "]),
    (["aaaaa", "bbbbb", "c"], ["aaaaa\n\nbbbbb", "c"]),
]


def packed(spark, texts, separator="\n\n", limit=10):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = chunk_paragraphs(frame, separator, limit).orderBy("doc_id", "chunk_no").collect()
    out = [[] for _ in texts]
    for r in rows:
        assert r.chunk_no == len(out[r.doc_id])
        out[r.doc_id].append(r.text)
    return out


def test_packing_cases(spark):
    assert packed(spark, ["\n\n".join(parts) for parts, _ in CASES]) == [want for _, want in CASES]


def test_packing_against_a_plain_model(spark):
    """Random documents over a small alphabet, all in one frame, against direct greedy packing."""
    import random

    generator = random.Random(5)
    texts = ["".join(generator.choice("aab|") for _ in range(generator.randrange(60))) for _ in range(400)]
    texts += ["|".join(generator.choice(["", "a", "abcdefghijkl"]) for _ in range(12)) for _ in range(200)]

    texts.append("|".join(generator.choice(["ab", "abcdefgh", ""]) for _ in range(9000)))  # thousands of chunks

    def direct(text):
        done, open_chunk = [], ""
        for piece in text.split("|"):
            if open_chunk == "":
                open_chunk = piece
            elif len(open_chunk) + len(piece) <= 10:
                open_chunk = open_chunk + "|" + piece
            else:
                done.append(open_chunk)
                open_chunk = piece
        return done + [open_chunk] * (open_chunk != "")

    got = packed(spark, texts, "|", 10)
    assert got == [direct(t) for t in texts]
    for text, chunks in zip(texts, got):
        if "" not in text.split("|"):
            assert "|".join(chunks) == text


def test_first_chunks_equals_prefix_of_all(spark):
    texts = ["", "\n\n", "aa", "a" * 20 + "\n\nb", "cc\n\ndd", "e" * 11]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = [tuple(r) for r in chunk_paragraphs(frame, limit=10).orderBy("doc_id", "chunk_no").collect()]
    for n in (1, 2, 3, 50):
        assert sorted(tuple(r) for r in first_chunks(frame, n, limit=10).collect()) == every[:n]


def test_stored_files_are_found_and_read(spark, folder):
    rows = [(i, f"text {i}\r\nlast ü") for i in range(1, 300)] + [(500, ""), (501, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(os.path.join(folder, "documents.parquet"))
    stored = plans.stored_files(spark, folder)
    assert len(os.listdir(stored)) <= plans.FILE_SHARDS  # not a folder per document, each of which would be a task of the listing
    found = files.discover(spark, stored, ".txt", recursive=True)
    assert found.rdd.getNumPartitions() <= 16  # not 4 MB of a task for each file
    size = lambda i, t: len((t or "").encode()) + (2 if i % 97 == 0 else 1)
    assert sorted((r.doc_id, r.length) for r in plans.discover_files(spark, folder).collect()) == [(i, size(i, t)) for i, t in rows]
    read = {r.doc_id: (r.n_chars, r.error) for r in plans.read_texts(spark, folder).collect()}
    assert read == {i: (None, "invalid UTF-8") if i % 97 == 0 else (len((t or "").replace("\r\n", "\n")) + 1, None) for i, t in rows}


def test_texts_are_read_with_one_listing(spark, corpus_folder, monkeypatch):
    made, session = [], files.small_files(spark)
    monkeypatch.setattr(files, "small_files", lambda spark: made.append(spark) or session)
    assert files.read_texts(spark, corpus_folder).count() == 10
    assert len(made) == 1
    found = files.read_files(spark, corpus_folder, ".txt").withColumn("content", F.when(~F.col("path").endswith("a3.txt"), F.col("content")))
    assert [os.path.basename(r.path) for r in files.unreadable_files(found).collect()] == ["a3.txt"]


def odd_tree(folder):
    """Files and folders with names that Spark's file sources take, escape or pass over."""
    for name in ("a.txt", "b.TXT", "my doc 5%.txt", "sub/c.txt", "sub/k=1/d+ü.txt", ".hid/e.txt", "_x/f.txt", "_k=2/g.txt", "_metadata/h.txt", "_i.txt", "_j=1.txt", ".k.txt", "l.txt._COPYING_", "deep/er/m.txt", "deep/n.md"):
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as f:
            f.write(name.encode())
    open(os.path.join(folder, "empty.txt"), "wb").close()


def test_listing_is_made_by_tasks_and_equals_that_of_sparks_source(spark, folder):
    odd_tree(folder)
    found = files.discover(spark, folder, ".txt", recursive=True)
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()  # its driver holds every entry
    own = files._spark_files(spark, folder, ".txt", True).select("path", "length", "modificationTime")
    want = sorted(own.collect())
    assert sorted(found.select(*own.columns).collect()) == want and len(want) == 8
    assert {r.file_name for r in found.collect()} >= {"my doc 5%.txt", "d+ü.txt", "m.txt"}
    flat = os.path.join(folder, "deep")
    assert [r.file_name for r in files.discover(spark, flat, ".md").collect()] == ["n.md"]
    assert files.discover(spark, flat, ".txt").collect() == []


def test_listing_falls_back_to_sparks_source(spark, folder):
    odd_tree(folder)
    for place, extension, recursive in ((f"{folder}/*/", ".txt", True), (folder, ".t?t", True), (f"{folder}/sub", ".txt", False)):
        own = files._spark_files(spark, place, extension, recursive).select("path", "length")
        assert sorted(files.discover(spark, place, extension, recursive).select("path", "length").collect()) == sorted(own.collect()) != []
        assert sorted(r.path for r in files.read_texts(spark, place, extension, recursive).collect()) == sorted(r.path for r in own.collect())
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.discover(spark, f"{folder}/none", ".txt")


def test_contents_are_read_by_tasks(spark, folder):
    odd_tree(folder)
    found = files.read_files(spark, folder, ".txt", recursive=True)
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
    own = files._spark_files(spark, folder, ".txt", True).select("path", "content")
    assert sorted(found.collect()) == sorted(own.collect())
    paths = pa.RecordBatch.from_arrays([pa.array(["a.txt", "deep", "sub/c.txt"])], names=["path"])  # a folder cannot be read
    [batch] = files._contents(f"file://{folder}", f"file:{folder}/")([paths])
    assert [r["path"] for r in batch.to_pylist()] == [f"file:{folder}/{name}" for name in ("a.txt", "deep", "sub/c.txt")]
    assert batch.column(1).to_pylist() == [b"a.txt", None, b"sub/c.txt"]


def test_unread_files_carry_an_error(spark, corpus_folder, monkeypatch):
    read = files.read_files(spark, corpus_folder, ".txt")
    lost = read.withColumn("content", F.when(~F.col("path").endswith("a3.txt"), F.col("content")))
    monkeypatch.setattr(files, "read_files", lambda *_: lost)
    rows = {os.path.basename(r.path): (r.text is None, r.error) for r in files.read_texts(spark, corpus_folder).collect()}
    assert rows["a3.txt"] == (True, "unreadable") and rows["bad.txt"] == (True, "invalid UTF-8") and rows["a1.txt"] == (False, None)
