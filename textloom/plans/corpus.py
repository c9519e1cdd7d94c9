"""Registered queries on documents: sources, filters, assembly, split, manifest, samples."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import html_text, output_name
from textloom.operators import documents as docs
from textloom.operators.chunks import chunk_paragraphs, chunk_stats, first_chunks
from textloom.operators.ranking import global_rank, sample_n, sorted_rank
from textloom.operators.split import apply_split, corpus_counts, having_result, split_overlap, train_test_split
from textloom.session import materialise, spread, work_path
from textloom.sources import cache, files, manifest, snapshots
from textloom.tables import file_listing, load, page_rows

PARAGRAPH = "\n"  # the driver documents separate paragraphs with one newline


# --- oracle building blocks ---------------------------------------------------------------------

SPLIT_SQL = """
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rank, count(*) OVER () AS n FROM base
),
members AS (SELECT *, CASE WHEN rank <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split FROM ranked)
"""

CHUNKS_SQL = """
paras AS (
  SELECT doc_id, i, p, length(p) AS l
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM base)
),
walk AS (
  SELECT doc_id, i, l AS filled, 1 AS c FROM paras WHERE i = 1
  UNION ALL
  SELECT p.doc_id, p.i,
         CASE WHEN w.filled = 0 OR w.filled + p.l > 2048 THEN p.l ELSE w.filled + 1 + p.l END,
         CASE WHEN w.filled = 0 OR w.filled + p.l > 2048 THEN w.c + 1 ELSE w.c END
  FROM walk w JOIN paras p ON p.doc_id = w.doc_id AND p.i = w.i + 1
),
packed AS (
  SELECT doc_id, c, string_agg(p, chr(10) ORDER BY i) AS text
  FROM walk JOIN paras USING (doc_id, i) GROUP BY doc_id, c
),
chunks AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c) - 1 AS INTEGER) AS chunk_no, text
  FROM packed WHERE text <> ''
)
"""

BASE_ALL = "base AS (SELECT * FROM documents)"
BASE_KEPT = "base AS (SELECT * FROM documents WHERE length(text) >= 500)"

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def kept_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(docs.min_chars(documents(spark, sf_dir), length_col="n_chars"))


def all_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_paragraphs(spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id"), PARAGRAPH)


# --- flagship -----------------------------------------------------------------------------------


@query(
    "corpus_slice",
    f"""WITH RECURSIVE {BASE_KEPT}, {SPLIT_SQL}, {CHUNKS_SQL},
per_doc AS (
  SELECT split, lang, doc_id, count(*) AS k, sum(length(c.text)) AS chars, max(length(c.text)) AS longest
  FROM chunks c JOIN members m USING (doc_id) GROUP BY ALL
)
SELECT split, lang, count(*) AS documents, CAST(sum(k) AS BIGINT) AS chunks, CAST(sum(chars) AS BIGINT) AS chars,
       max(longest) AS longest_chunk, max(k) AS max_chunks_per_doc, round(avg(k), 4) AS avg_chunks_per_doc
FROM per_doc GROUP BY split, lang""",
)
def corpus_slice(spark, sf_dir):
    """Length filter, exact split, paragraph packing and statistics by split and language."""
    members = kept_split(spark, sf_dir).select("doc_id", "lang", "split", "text")
    return chunk_stats(spread(members, "doc_id"), "split", "lang", separator=PARAGRAPH)


# --- sources ------------------------------------------------------------------------------------


FILE_SHARDS = 64  # folders that hold the folders of the documents; each is made and listed by one task


def _store_files(folder: str):
    """Writer of rows ``(shard, name, value)`` that come in the order of their names, one file per name and one line per row."""

    def write(rows: Iterator[Row]) -> None:
        system, top = FileSystem.from_uri(folder)
        for (shard, name), lines in itertools.groupby(rows, lambda row: (row.shard, row.name)):
            place = f"{top}/shard={shard}/name={name}"
            system.create_dir(place)
            with system.open_output_stream(f"{place}/part-0.txt") as out:
                for line in lines:
                    out.write(bytes(line.value or b"") + b"\n")

    return write


def stored_files(spark: SparkSession, sf_dir: str) -> str:
    """Every document as a file in a folder of its own, ``name=my doc 5%``, in one of the shards of the returned folder.

    Every 97th document gets a byte that no UTF-8 text has. Spark's own writer runs a process to set the mode of each
    local file and its driver moves each document's folder, one after the other; here every task puts its files in place.
    """
    folder = work_path(spark, "files")
    broken = F.when(F.col("doc_id") % 97 == 0, F.expr("cast(X'FF' AS string)")).otherwise("")
    text = F.concat("text", broken)
    name = F.concat(F.lit("my doc "), F.col("doc_id"), F.lit("%25"))  # escaped as Spark escapes a partition's value
    name = F.coalesce(name, F.lit("__HIVE_DEFAULT_PARTITION__"))
    shard = F.pmod(F.crc32(name.cast("binary")), F.lit(FILE_SHARDS))
    rows = documents(spark, sf_dir).select(shard.alias("shard"), name.alias("name"), text.cast("binary").alias("value"))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    rows.repartition(FILE_SHARDS, "shard").sortWithinPartitions("shard", "name").foreachPartition(_store_files(whole))
    return folder


def file_doc_id(path):
    """Document id in the path of a stored file; the folder name has its percent sign escaped once by the writer."""
    return F.regexp_extract(path, "name=my doc ([0-9]+)%25/[^/]*$", 1).cast("bigint")


@query(
    "discover_files",
    """SELECT doc_id, CAST(strlen(text) + CASE WHEN doc_id % 97 = 0 THEN 2 ELSE 1 END AS BIGINT) AS length FROM documents""",
)
def discover_files(spark, sf_dir):
    """Files found by extension below a folder; only the listing is read."""
    found = files.discover(spark, stored_files(spark, sf_dir), ".txt", recursive=True)
    return found.select(file_doc_id(F.col("path")).alias("doc_id"), "length")


@query(
    "extract_pages",
    """SELECT page_id AS doc_id, CAST(i - 1 AS INTEGER) AS page_no, length(text) AS n_chars, md5(text) AS text_md5,
       CAST(NULL AS VARCHAR) AS error
FROM (SELECT page_id, unnest(string_split(html, '<p>')) AS text,
             generate_subscripts(string_split(html, '<p>'), 1) AS i FROM pages) WHERE i <= 30""",
)
def extract_pages(spark, sf_dir):
    raw = load(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.encode("html", "UTF-8").alias("content"))
    pages = docs.extract_pages(spread(raw, "doc_id"), docs.markup_pages)
    return pages.select(
        "doc_id",
        "page_no",
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("text_md5"),
        "error",
    )


@query(
    "html_text",
    r"""WITH a AS (SELECT page_id, regexp_replace(html,
  '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(t, '<[^>]*>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM b),
d AS (SELECT page_id, trim(regexp_replace(t, '[ \t\r\n\f]+', ' ', 'g')) AS t FROM c)
SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM d""",
)
def html_text_query(spark, sf_dir):
    text = spread(load(spark, sf_dir, "pages"), "page_id").select("page_id", html_text(F.col("html")).alias("text"))
    return text.select("page_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query(
    "read_texts",
    """SELECT doc_id, CASE WHEN doc_id % 97 <> 0 THEN length(t) END AS n_chars, CASE WHEN doc_id % 97 <> 0 THEN md5(t) END AS text_md5,
       CASE WHEN doc_id % 97 = 0 THEN 'invalid UTF-8' END AS error
FROM (SELECT doc_id, replace(replace(text || chr(10), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM documents)""",
)
def read_texts(spark, sf_dir):
    """Texts read from files, one per document; every 97th is not valid."""
    read = files.read_texts(spark, stored_files(spark, sf_dir), recursive=True)
    return read.select(
        file_doc_id(F.col("path")).alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("text_md5"),
        "error",
    )


@query(
    "write_documents",
    f"""WITH {BASE_KEPT}, {SPLIT_SQL}
SELECT split, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars FROM members GROUP BY split""",
)
def write_documents(spark, sf_dir):
    path = work_path(spark, "documents")
    files.write_documents(kept_split(spark, sf_dir), path, by_split=True)
    stored = spark.read.parquet(path)
    return stored.groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"))


DONE_SQL = "done AS (SELECT DISTINCT doc_id FROM labels)"


@query(
    "incremental_ingest",
    f"""WITH {DONE_SQL}
SELECT doc_id, lang, md5(text) AS text_md5, CASE WHEN doc_id IN (SELECT doc_id FROM done) THEN 'done' ELSE 'new' END AS origin
FROM documents WHERE length(text) >= 500 OR doc_id IN (SELECT doc_id FROM done)""",
)
def incremental_ingest(spark, sf_dir):
    """Documents with a label were written before; the rest is filtered and joins them."""
    source = documents(spark, sf_dir)
    done = having_result(source, load(spark, sf_dir, "labels"), "doc_id")
    found = docs.incremental_ingest(source, done, length_col="n_chars")
    return found.select("doc_id", "lang", F.md5("text").alias("text_md5"), "origin")


@query(
    "append_new",
    f"""WITH {DONE_SQL}
SELECT doc_id, lang, md5(text) AS text_md5 FROM documents WHERE length(text) >= 500 OR doc_id IN (SELECT doc_id FROM done)""",
)
def append_new(spark, sf_dir):
    """A folder with the labelled documents, appended to twice; the second time nothing is new."""
    source, path = documents(spark, sf_dir), work_path(spark, "ingested")
    having_result(source, load(spark, sf_dir, "labels"), "doc_id").write.parquet(path)
    docs.append_new(source, path)
    return docs.append_new(source, path).select("doc_id", "lang", F.md5("text").alias("text_md5"))


MANIFEST_SQL = f"""WITH {BASE_KEPT}, {SPLIT_SQL}
SELECT 'doc_' || doc_id || '.txt' AS file_name, split, rank, CAST(floor(n * 0.9) AS BIGINT) AS train_size,
       CAST(n - floor(n * 0.9) AS BIGINT) AS test_size FROM members"""


def named_documents(spark, sf_dir):
    kept = docs.min_chars(documents(spark, sf_dir), length_col="n_chars")
    return kept.select("doc_id", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("file_name"))


@query("write_manifest", MANIFEST_SQL)
def write_manifest(spark, sf_dir):
    """The manifest as stored and read again."""
    path = work_path(spark, "manifest")
    manifest.write_manifest(manifest.manifest_rows(named_documents(spark, sf_dir)), path)
    return spark.read.schema(manifest.MANIFEST_SCHEMA).json(path).drop("created_at")


@query(
    "read_manifest",
    f"""WITH {BASE_KEPT}, {SPLIT_SQL} SELECT doc_id, 'doc_' || doc_id || '.txt' AS file_name, split FROM members""",
)
def read_manifest(spark, sf_dir):
    """Split, store the manifest, load it again and look the documents up in it."""
    named = named_documents(spark, sf_dir)
    members = manifest.load_or_split(spark, named)
    return apply_split(named, members, "file_name")


@query(
    "cached_dataset",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL}
SELECT doc_id, chunk_no, length(text) AS n_chars FROM chunks""",
)
def cached_dataset(spark, sf_dir):
    """Chunks stored under the fingerprint of their documents and parameters, read from the store."""
    source = documents(spark, sf_dir)
    entry = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text"))
    key = cache.dataset_key(spark, source, entry, separator=repr(PARAGRAPH), limit=2048)
    stored = cache.cached_dataset(spark, "chunks", key, lambda: all_chunks(spark, sf_dir))
    return stored.select("doc_id", "chunk_no", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "fingerprint",
    """WITH h AS (SELECT md5(doc_id || ':' || n_chars || ';') AS h FROM documents)
SELECT md5(concat_ws(':', count(*),
  sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)), sum(CAST('0x' || substr(h, 9, 8) AS BIGINT)),
  sum(CAST('0x' || substr(h, 17, 8) AS BIGINT)), sum(CAST('0x' || substr(h, 25, 8) AS BIGINT)))) AS fingerprint
FROM h""",
)
def fingerprint(spark, sf_dir):
    entry = cache.file_entry(F.col("doc_id").cast("string"), F.col("n_chars"))
    return cache.fingerprint(documents(spark, sf_dir), entry)


@query(
    "config_fingerprint",
    """SELECT source, lang, md5(concat_ws('_', source || '-' || lang, max(n_chars))) AS config
FROM documents GROUP BY source, lang""",
)
def config_fingerprint(spark, sf_dir):
    longest = documents(spark, sf_dir).groupBy("source", "lang").agg(F.max("n_chars").alias("max_length"))
    name = F.concat_ws("-", "source", "lang")
    return longest.select("source", "lang", cache.config_fingerprint(name, F.col("max_length")).alias("config"))


# --- projections and filters --------------------------------------------------------------------


@query(
    "output_name",
    """SELECT doc_id, replace('doc_' || doc_id || '.' || lang, '.en', '.txt') AS output_name FROM documents""",
)
def output_name_query(spark, sf_dir):
    return file_listing(spark, sf_dir).select("doc_id", output_name(F.col("path"), ".en").alias("output_name"))


@query("page_limit", "SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page_no, text FROM conversations WHERE turn < 4")
def page_limit(spark, sf_dir):
    return docs.page_limit(page_rows(spark, sf_dir), 4)


@query(
    "nonempty_pages",
    """SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page_no, text
FROM conversations WHERE text IS NOT NULL AND text <> ''""",
)
def nonempty_pages(spark, sf_dir):
    return docs.nonempty_pages(page_rows(spark, sf_dir))


@query("min_chars", "SELECT doc_id, length(text) AS n_chars FROM documents WHERE length(text) >= 500")
def min_chars(spark, sf_dir):
    return docs.min_chars(documents(spark, sf_dir)).select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "rejects",
    """SELECT doc_id, n_chars, CASE WHEN doc_id % 97 = 0 THEN 'error' ELSE 'too short' END AS reason
FROM documents WHERE length(text) < 500 OR doc_id % 97 = 0""",
)
def rejects(spark, sf_dir):
    """Every 97th document failed in extraction."""
    failed = F.when(F.col("doc_id") % 97 == 0, "unreadable")
    return docs.rejects(documents(spark, sf_dir).withColumn("error", failed)).select("doc_id", "n_chars", "reason")


@query("observe_kept", "SELECT count(*) AS found, count(*) FILTER (length(text) >= 500) AS kept FROM documents")
def observe_kept(spark, sf_dir):
    """Counts observed while the kept documents are written."""
    counted = Observation("kept")
    watched = docs.observe_kept(documents(spark, sf_dir).select("doc_id", "text"), counted)
    docs.min_chars(watched).write.parquet(work_path(spark, "observed"))
    values = F.create_map(*[x for k, v in counted.get.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    return spark.range(1).select(values["found"].alias("found"), values["kept"].alias("kept"))


@query("drop_columns", "SELECT doc_id, lang, source, n_chars FROM documents")
def drop_columns(spark, sf_dir):
    return documents(spark, sf_dir).drop("text")


# --- joins and set operations -------------------------------------------------------------------


@query("skip_done", f"WITH {DONE_SQL} SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM done)")
def skip_done(spark, sf_dir):
    return docs.skip_done(documents(spark, sf_dir).select("doc_id", "lang"), load(spark, sf_dir, "labels"))


@query(
    "apply_manifest",
    f"""WITH {BASE_KEPT}, {SPLIT_SQL} SELECT doc_id, lang, n_chars, split FROM members""",
)
def apply_manifest(spark, sf_dir):
    members = manifest.manifest_rows(named_documents(spark, sf_dir)).select("file_name", "split")
    doc_id = F.regexp_extract("file_name", "([0-9]+)", 1).cast("bigint")
    return apply_split(
        documents(spark, sf_dir).select("doc_id", "lang", "n_chars"), members.withColumn("doc_id", doc_id)
    )


@query("having_result", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def having_result_query(spark, sf_dir):
    return having_result(documents(spark, sf_dir).select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id")


@query(
    "processed_union",
    """SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE length(text) >= 500""",
)
def processed_union(spark, sf_dir):
    written = docs.min_chars(documents(spark, sf_dir), length_col="n_chars")
    return docs.processed_union(load(spark, sf_dir, "labels"), written)


@query(
    "split_disjoint",
    f"""WITH {BASE_KEPT}, {SPLIT_SQL}
SELECT md5(text) AS digest, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows
FROM members GROUP BY 1
HAVING count(*) FILTER (split = 'train') > 0 AND count(*) FILTER (split = 'test') > 0""",
)
def split_disjoint(spark, sf_dir):
    """Texts that landed on both sides of a document-level split."""
    return split_overlap(kept_split(spark, sf_dir).withColumn("digest", F.md5("text")), "digest")


@query(
    "split_by_digest",
    """WITH units AS (SELECT DISTINCT md5(text) AS digest FROM documents),
ranked AS (SELECT digest, row_number() OVER (ORDER BY md5('42:' || digest), digest) AS rank, count(*) OVER () AS n FROM units)
SELECT doc_id, CASE WHEN rank <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split
FROM documents JOIN ranked ON md5(text) = digest""",
)
def split_by_digest(spark, sf_dir):
    """The split by distinct text, which keeps copies on one side."""
    units = materialise(documents(spark, sf_dir).select("doc_id", F.md5("text").alias("digest")), "digests")
    return train_test_split(units, ["digest"], distinct_keys=True).select("doc_id", "split")


# --- aggregates, ranks, samples -----------------------------------------------------------------


@query(
    "assemble_documents",
    """WITH d AS (SELECT conv_id AS doc_id, string_agg(text || chr(10) || chr(10), '' ORDER BY turn) AS text
FROM conversations WHERE turn < 30 AND text <> '' GROUP BY conv_id)
SELECT doc_id, text, length(text) AS n_chars FROM d WHERE length(text) >= 500""",
)
def assemble_documents(spark, sf_dir):
    return docs.min_chars(docs.assemble_documents(page_rows(spark, sf_dir)), length_col="n_chars")


@query(
    "corpus_counts",
    f"""WITH {BASE_KEPT}, {SPLIT_SQL}
SELECT (SELECT count(*) FROM documents) AS found, count(*) AS processed,
       count(*) FILTER (split = 'train') AS train_size, count(*) FILTER (split = 'test') AS test_size FROM members""",
)
def corpus_counts_query(spark, sf_dir):
    sizes = documents(spark, sf_dir).select("doc_id", "n_chars")
    kept = train_test_split(docs.min_chars(sizes, length_col="n_chars"))
    short = sizes.filter(F.col("n_chars") < 500).withColumn("split", F.lit(None).cast("string"))
    return corpus_counts(kept.unionByName(short))


@query(
    "chunk_stats",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL},
per_doc AS (SELECT lang, doc_id, count(*) AS k, sum(length(c.text)) AS chars, max(length(c.text)) AS longest
  FROM chunks c JOIN documents d USING (doc_id) GROUP BY ALL)
SELECT lang, count(*) AS documents, CAST(sum(k) AS BIGINT) AS chunks, CAST(sum(chars) AS BIGINT) AS chars,
       max(longest) AS longest_chunk, max(k) AS max_chunks_per_doc, round(avg(k), 4) AS avg_chunks_per_doc
FROM per_doc GROUP BY lang""",
)
def chunk_stats_query(spark, sf_dir):
    source = spread(documents(spark, sf_dir).select("doc_id", "lang", "text"), "doc_id")
    return chunk_stats(source, "lang", separator=PARAGRAPH)


@query(
    "chunk_paragraphs",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL} SELECT doc_id, chunk_no, text FROM chunks""",
)
def chunk_paragraphs_query(spark, sf_dir):
    return all_chunks(spark, sf_dir)


@query(
    "global_rank",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rank FROM documents",
)
def global_rank_query(spark, sf_dir):
    return global_rank(documents(spark, sf_dir).select("doc_id"), ["doc_id"])


@query("train_test_split", f"WITH {BASE_KEPT}, {SPLIT_SQL} SELECT doc_id, split FROM members")
def train_test_split_query(spark, sf_dir):
    return kept_split(spark, sf_dir).select("doc_id", "split")


@query(
    "sample_n",
    "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 256",
)
def sample_n_query(spark, sf_dir):
    return sample_n(documents(spark, sf_dir).select("doc_id", "lang"), ["doc_id"])


@query(
    "first_n",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL}
SELECT doc_id, chunk_no, text FROM chunks ORDER BY doc_id, chunk_no LIMIT 256""",
)
def first_n_query(spark, sf_dir):
    return first_chunks(documents(spark, sf_dir).select("doc_id", "text"), 256, PARAGRAPH)


@query(
    "sorted_paths",
    """SELECT path, row_number() OVER (ORDER BY path) AS position
FROM (SELECT '/corpus/' || source || '/doc_' || doc_id || '.' || lang AS path FROM documents)""",
)
def sorted_paths(spark, sf_dir):
    """Paths in order, with their place in it."""
    placed = sorted_rank(file_listing(spark, sf_dir).select("path"), [F.col("path")])
    return placed.select("path", (F.col("rank") + 1).alias("position"))


@query(
    "snapshot_diff",
    """WITH old AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 50 <> 1),
new AS (SELECT doc_id, CASE WHEN doc_id % 50 = 2 THEN md5(text || '!') ELSE md5(text) END AS h FROM documents WHERE doc_id % 50 <> 3)
SELECT doc_id, CASE WHEN old.h IS NULL THEN 'new' WHEN new.h IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM old FULL JOIN new USING (doc_id) WHERE old.h IS DISTINCT FROM new.h""",
)
def snapshot_diff(spark, sf_dir):
    """Two snapshots of all documents; some are new, some gone and some changed in the second."""
    out = work_path(spark, "snapshots")
    docs, slot = documents(spark, sf_dir), F.col("doc_id") % 50
    text = F.when(slot == 2, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    for name, rows in (("old", docs.filter(slot != 1)), ("new", docs.filter(slot != 3).withColumn("text", text))):
        snapshots.write_snapshot(rows.withColumn("digest", F.md5("text")), ["doc_id"], "digest", f"{out}/{name}")
    return snapshots.snapshot_diff(spark, f"{out}/old", f"{out}/new", ["doc_id"])
