"""Registered queries on rows and batches of encoded chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import batches, packing, parallel_chunks, trainer
from textloom.operators.tokens import MAX_LENGTH
from textloom.plans.corpus import BASE_ALL, CHUNKS_SQL, PARAGRAPH, documents
from textloom.plans.text import ENCODE_SQL, encoded
from textloom.session import materialise

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str):
    def register(run):
        QUERIES[name], ORACLES[name] = run, oracle
        return run

    return register


@query(
    "pack_sequences",
    f"""WITH RECURSIVE {BASE_ALL}, {ENCODE_SQL},
total AS (SELECT CAST(sum(filled) AS BIGINT) AS tokens, greatest(CAST(ceil(sum(filled) / 512.0) AS BIGINT), count(*) FILTER (filled > 256)) AS least_rows FROM encoded)
SELECT doc_id, chunk_no, CAST(filled AS INTEGER) AS n_ids, md5(array_to_string(input_ids[1:filled], ' ')) AS ids_md5,
       tokens, least_rows, TRUE AS rows_fit, TRUE AS rows_near_least
FROM encoded, total""",
)
def pack_sequences(spark, sf_dir):
    """Every chunk as its row gives it back, with the sums over all rows.

    No packing has fewer rows than the ids fill, or than there are chunks of over half a row; this one has hardly more.
    """
    packed = materialise(packing.pack_sequences(encoded(spark, sf_dir)), "packed")
    held = F.aggregate("segments", F.lit(0), lambda a, s: a + s["length"])
    over_half = F.sum(F.size(F.filter("segments", lambda s: s["length"] > MAX_LENGTH // 2)))
    sums = packed.agg(
        F.sum(held).alias("tokens"),
        F.greatest(F.ceil(F.sum(held) / MAX_LENGTH), over_half).alias("least_rows"),
        ((F.max(held) <= MAX_LENGTH) & (F.max(F.size("input_ids")) == MAX_LENGTH)).alias("rows_fit"),
        F.count(F.lit(1)).alias("rows"),
    )
    near = F.col("rows") <= F.col("least_rows") * 1.01 + 1
    sums = sums.select("tokens", "least_rows", "rows_fit", near.alias("rows_near_least"))
    chunks = packing.unpack_sequences(packed).select(
        "doc_id", "chunk_no", F.size("ids").alias("n_ids"), F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_md5")
    )
    return chunks.crossJoin(F.broadcast(sums))  # one row


@query(
    "collate_batches",
    f"""WITH RECURSIVE {BASE_ALL}, {ENCODE_SQL},
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1 AS place FROM encoded),
wide AS (SELECT *, place // 4 AS batch_id, max(filled) OVER (PARTITION BY place // 4) AS width FROM placed),
lines AS (SELECT batch_id, width, place, filled, input_ids[1:width] AS ids,
                 list_transform(range(width), lambda i: CASE WHEN i < filled THEN 1 ELSE 0 END) AS mask,
                 list_transform(range(width), lambda i: CASE WHEN i < filled THEN input_ids[i + 1] ELSE -100 END) AS labels FROM wide)
SELECT batch_id, CAST(count(*) AS INTEGER) AS rows, CAST(max(width) AS INTEGER) AS width,
       md5(string_agg(array_to_string(ids, ' '), ' ' ORDER BY place)) AS ids_md5,
       md5(string_agg(array_to_string(mask, ' '), ' ' ORDER BY place)) AS mask_md5,
       md5(string_agg(array_to_string(labels, ' '), ' ' ORDER BY place)) AS labels_md5
FROM lines GROUP BY batch_id""",
)
def collate_batches(spark, sf_dir):
    rows = materialise(encoded(spark, sf_dir), "encoded")
    plan = batches.epoch_batches(rows.select("doc_id", "chunk_no"), ["doc_id", "chunk_no"], 1, 4)
    collated = packing.collate_batches(rows.join(plan, ["doc_id", "chunk_no"]))
    digest = lambda name: F.md5(F.array_join(F.col(name).cast("array<string>"), " "))
    return collated.select(
        "batch_id",
        "rows",
        "width",
        digest("input_ids").alias("ids_md5"),
        digest("attention_mask").alias("mask_md5"),
        digest("labels").alias("labels_md5"),
    )


@query(
    "parallel_pack",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL}
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, length(text) AS chars, md5(text) AS text_md5 FROM chunks""",
)
def parallel_pack(spark, sf_dir):
    """Chunks of all documents, packed by blocks of 64 paragraphs that know nothing of those before them."""
    source = documents(spark, sf_dir).select("doc_id", "text")
    found = parallel_chunks.parallel_pack(source, ["doc_id"], PARAGRAPH, block=64, group=4)
    return found.select("doc_id", "chunk_no", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


GRID = {"slow": {"rate": 0.05}, "fast": {"rate": 0.5}, "held": {"rate": 0.5, "penalty": 0.2}, "tight": {"rate": 0.2, "penalty": 0.01}}
GRID_SQL = ", ".join(f"('{run}', {a['rate']}::DOUBLE, {a.get('penalty', 0.0)}::DOUBLE)" for run, a in GRID.items())


@query(
    "grid_trainer",
    f"""WITH RECURSIVE d AS (
  SELECT ln(1 + length(text)) / 10 AS x, (length(text) - length(replace(text, chr(10), ''))) / 10.0::DOUBLE AS y, doc_id % 5 = 0 AS test FROM documents
), s AS (SELECT count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM d WHERE NOT test),
grid(run, rate, penalty) AS (VALUES {GRID_SQL}),
w AS (
  SELECT 0 AS step, run, rate, penalty, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM grid
  UNION ALL
  SELECT step + 1, run, rate, penalty, a - rate * ((n * a + sx * b - sy) / n + penalty * a), b - rate * ((sx * a + sxx * b - sxy) / n + penalty * b)
  FROM w, s WHERE step < 10
), l AS (
  SELECT run, any_value(a) AS a, any_value(b) AS b, count(*) AS test_rows, sum((a + b * x - y) * (a + b * x - y)) / 2 / count(*) AS test_loss
  FROM w, d WHERE step = 10 AND test GROUP BY run
)
SELECT CAST(row_number() OVER (ORDER BY test_loss, run) AS INTEGER) AS position, run, round(a, 6) AS intercept, round(b, 6) AS slope,
       n AS train_rows, test_rows, round(test_loss, 6) AS test_loss FROM l, s""",
)
def grid_trainer(spark, sf_dir):
    """Lines of a document by its length: four configurations of one linear model, trained together."""
    text = F.col("text")
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))) / 10.0
    rows = documents(spark, sf_dir).select(
        (F.log(1 + F.length(text)) / 10).alias("x"), lines.alias("y"), (F.col("doc_id") % 5 == 0).alias("test")
    )
    found = trainer.train_grid(rows, GRID, ["x"], "y", "test", steps=10)
    return found.select(
        "position",
        "run",
        F.round(F.col("parameters")[0], 6).alias("intercept"),
        F.round(F.col("parameters")[1], 6).alias("slope"),
        "train_rows",
        "test_rows",
        F.round("test_loss", 6).alias("test_loss"),
    )
