"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Each source has a target number of words: its share of all words by weight, but at most ``MOST`` times the words it
has; what a source cannot give is shared again by weight until no source is above. A document's expected number of
copies is target over size of its source. Inside a source the documents stand in a fixed order, their expected copies
are summed up, one random offset is added, and a document is emitted once for every whole number its interval crosses. The
order goes by size first, so documents of every size are taken evenly and the words come near the target.

Scale: the running sum of an equal expected number is rank times that number, and ranks come from two levels: a
document's place inside its bucket, and the documents in earlier buckets of the source. A bucket is a class of sizes and one of 256
hash values, so a source that holds most rows is spread over many tasks; only ids and sizes are shuffled. The table
of sources, one row each, is the only one that meets in one task.

Results for odd input: a null or empty text has size 0; it is emitted like any other and takes no words. A null source is a source of its own,
last in order. A source without words has target 0. Repeated rows are rows of their own. Reruns agree, for everything
random is a hash. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import free_name, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 17


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    With sources in order of what they can give per weight, the capped ones come first; after how many of them the
    rest can all take their share of what is left is one comparison per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    total = F.sum("source_size").over(Window.partitionBy())
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    # the level if all sources before this one are capped and it is not
    level = (total - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / F.sum("w").over(rest)
    rows = rows.withColumn("level", level).withColumn("free", F.col("level") <= F.col("most") / F.col("w"))
    final = F.min(F.when(F.col("free"), F.struct(F.col("most") / F.col("w"), "level"))).over(Window.partitionBy())
    share = F.col("w") * final["level"]
    return rows.select("source", "source_size", F.coalesce(F.least("most", share), F.col("most")).alias("target"))


def _tie(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def copies(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    extra: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, *extra)``, one row per row of the table."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        *extra,
    ).withColumn("tie", _tie("doc_id", seed))
    rows = rows.withColumn("kind", F.floor(F.sqrt(F.col("size").cast("double")))).withColumn(
        "slot", F.substring("tie", 1, 2)
    )
    buckets = rows.groupBy("source", "kind", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    )
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    running = Window.partitionBy("source").orderBy("kind", "slot")
    before = buckets.select(
        "source", "kind", "slot", (F.sum("n").over(running) - F.col("n")).alias("before")
    ).join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    before = before.select(
        F.col("source").alias("s"), F.col("kind").alias("k"), F.col("slot").alias("h"), "before", "source_size", "target"
    )
    inside = Window.partitionBy("source", "kind", "slot").orderBy("size", "tie", F.col("doc_id").asc_nulls_last())
    placed = rows.withColumn("pos", F.row_number().over(inside)).join(
        before, F.col("source").eqNullSafe(F.col("s")) & (F.col("kind") == F.col("k")) & (F.col("slot") == F.col("h"))
    )
    draw = F.md5(F.concat(F.lit(f"{seed}:offset:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))))
    offset = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / float(1 << 32)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("before") + F.col("pos")
    crossed = F.floor(offset + rank * rate) - F.floor(offset + (rank - 1) * rate)
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", F.least(crossed, F.lit(most)).cast("long").alias("copies"), *extra
    )


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Rows that share an id and a size are told apart by their order only, so of them the first ones are emitted.
    """
    key, of, turn, n, size, own_size, own_turn, copy = (
        free_name(docs, name) for name in ("key", "of", "turn", "n", "size", "own_size", "own_turn", "copy")
    )
    taken = copies(docs, text, doc_id, source).filter("copies > 0")
    who = Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))
    taken = taken.withColumn(turn, F.row_number().over(who)).select(
        F.col("doc_id").alias(key), F.col("source").alias(of), F.col("size").alias(size), turn, F.col("copies").alias(n)
    )
    mine = Window.partitionBy(doc_id, source, own_size).orderBy(F.col(text))
    rows = docs.withColumn(own_size, word_count(F.col(text))).withColumn(own_turn, F.row_number().over(mine))
    same = (
        F.col(doc_id).eqNullSafe(F.col(key))
        & F.col(source).eqNullSafe(F.col(of))
        & (F.col(own_size) == F.col(size))
        & (F.col(own_turn) == F.col(turn))
    )
    joined = rows.join(taken, same)
    again = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return joined.withColumn(copy, again).select(*docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS tie FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             source_size * 3.0::DOUBLE AS most FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
),
f AS (SELECT min_by(level, most / w) FILTER (level <= most / w) AS level FROM l),
t AS (SELECT l.source, l.source_size, coalesce(least(l.most, l.w * f.level), l.most) AS target FROM l, f),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY floor(sqrt(d.size::DOUBLE)), substr(d.tie, 1, 2), d.size, d.tie, d.doc_id NULLS LAST) AS pos,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}:offset:' || coalesce('=' || d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS o
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(o + pos * rate) - floor(o + (pos - 1) * rate), 3) * size)::BIGINT AS taken
FROM r
"""
