"""Sharding by a permutation-filled lookup table; DataFrame functions only.

Each shard has a preference order over the slots of a table of prime size, given by an offset and a step from hashes
of its name; the shards take turns, each claiming the first slot of its order that is still free, until the table is
full. Every shard then holds the same number of slots but for one, and when a shard joins or leaves few slots change hands. A
row's slot is the hash of its key modulo the table size; a broadcast join with the table, whose size is the
parameter ``TABLE``, places it in constant time and without a shuffle.

Results for odd input: a null key is placed by the text instead, so that such rows spread; equal keys share a shard. Empty tables
give an empty result. The other columns are not read by ``place`` and stay as they are in ``write_shards``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import free_name

TABLE = 65_537  # a prime well above the number of shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
FILES = 8  # tasks that write one shard


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE) -> list[int]:
    """Number of the shard of each slot; ``size`` is prime, so every step visits all slots."""
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= size:
        raise ValueError("shards need distinct names, at most one per slot")
    place = [_hash(f"offset {s}") % size for s in shards]
    step = [_hash(f"step {s}") % (size - 1) + 1 for s in shards]
    table, left = [-1] * size, size
    while left:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % size
            table[place[k]] = k
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, otherwise: Column, size: int = TABLE) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), otherwise, F.lit(""))), F.lit(size)).cast("int")


def _table(df: DataFrame, shards: Sequence[str], size: int, slot: str, shard: str) -> DataFrame:
    """The lookup table as rows ``(slot, shard)``: the parameter ``size`` bounds what is broadcast."""
    numbers = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    rows = df.sparkSession.range(1).select(F.posexplode(numbers).alias(slot, "_n"))
    return rows.select(slot, F.get(names, F.col("_n").cast("int")).alias(shard))


def place(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: Sequence[str] = SHARDS, size: int = TABLE
) -> DataFrame:
    """``(doc_id, slot, shard)``, one row per row of the table."""
    rows = docs.select(F.col(key).alias("doc_id"), slot_of(F.col(key), F.col(text), size).alias("slot"))
    return rows.join(F.broadcast(_table(docs, shards, size, "slot", "shard")), "slot").select("doc_id", "slot", "shard")


def write_shards(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    shards: Sequence[str] = SHARDS,
    size: int = TABLE,
    column: str = "shard",
) -> None:
    """Write the table as one folder per shard; each shard is dealt to ``FILES`` tasks by a hash of the slot."""
    slot = free_name(docs, "slot")
    placed = docs.drop(column).withColumn(slot, slot_of(F.col(key), F.col(text), size))
    placed = placed.join(F.broadcast(_table(docs, shards, size, slot, column)), slot)
    part = F.pmod(F.hash(slot), F.lit(FILES))
    dealt = placed.withColumn(slot, part).repartition(len(shards) * FILES, column, slot)
    dealt.drop(slot).write.partitionBy(column).parquet(path)
