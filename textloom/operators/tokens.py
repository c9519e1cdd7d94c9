"""Tokens, vocabulary and fixed-length encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.numbers import bounded_runs
from textloom.operators.ranking import sorted_rank
from textloom.session import materialise

# Reserved ids, the first free id, the ignored label, and the sequence length.
PAD, UNK, BOS, EOS = 0, 1, 2, 3
FIRST_ID = 4
IGNORED_LABEL = -100
MAX_LENGTH = 512

# A run of letters and digits, or a run of other visible characters.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r\f\x0b]+"

# The head of a vocabulary that every task holds: its most frequent tokens, at most 65,536 strings of at most 64
# characters. All other tokens, longer or rarer, are joined; where the head ends changes no id.
HEAD_TOKENS = 65_536
HEAD_CHARS = 64

# Characters of texts whose tokens a task of a user tokenizer holds at once, besides one longer text.
HOOK_CHARS = 1 << 19


def tokenize(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def tokenize_with(
    df: DataFrame, tokenizer: Callable[[], Callable[[list[str]], list]], text_col: str = "text", item: str = "string"
) -> DataFrame:
    """Add ``tokens`` from a user tokenizer; ``tokenizer()`` is called once per task, its result once per batch.

    A batch is cut where its texts reach ``HOOK_CHARS`` characters, as the tokens of all its rows can be many times their texts.
    """

    @F.pandas_udf(f"array<{item}>")
    def split_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode_batch = tokenizer()
        for batch in batches:
            texts = batch.tolist()
            for start, end in bounded_runs([len(t) if isinstance(t, str) else 0 for t in texts], HOOK_CHARS):
                yield pd.Series(encode_batch(texts[start:end]))

    return df.withColumn("tokens", split_batches(F.col(text_col)))


def token_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.select(F.explode(tokenize(F.col(text_col))).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")
    )


def frequent(counts: DataFrame, size: int) -> DataFrame:
    """Tokens that can be among the ``size`` most frequent, and at most a power of two of their counts below.

    The bound comes from the number of tokens per bit length of the count, which is at most 64 rows.
    """
    histogram = counts.groupBy(F.length(F.bin("n")).alias("_bits")).agg(F.count(F.lit(1)).alias("_tokens"))
    down = Window.orderBy(F.desc("_bits")).rowsBetween(Window.unboundedPreceding, -1)
    bits = (
        histogram.withColumn("_above", F.coalesce(F.sum("_tokens").over(down), F.lit(0)))
        .filter(F.col("_above") < size)
        .agg(F.min("_bits"))
        .scalar()
    )
    return counts.filter(F.length(F.bin("n")) >= bits)


def vocabulary(counts: DataFrame, max_size: int | None = None) -> DataFrame:
    """``(token, n, id)``: ids from ``FIRST_ID`` by falling count, then token; at most ``max_size`` of them.

    The ``max_size`` most frequent tokens are the caller's choice; without it every token has an id.
    """
    if max_size is not None:
        counts = frequent(counts, max_size)
    ranked = sorted_rank(counts, [F.desc("n"), F.col("token")])
    if max_size is not None:
        ranked = ranked.filter(F.col("rank") < max_size)
    return ranked.select("token", "n", (F.col("rank") + FIRST_ID).cast("int").alias("id"))


def vocab_lookup(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``id`` to rows with ``token``; unknown tokens get the reserved id.

    The join is left to AQE, which broadcasts by measured size and splits the partitions of frequent tokens.
    """
    joined = tokens.join(vocab.select("token", "id"), "token", "left")
    return joined.withColumn("id", F.coalesce("id", F.lit(UNK)))


def encode(
    chunks: DataFrame,
    vocab: DataFrame,
    max_length: int = MAX_LENGTH,
    keys: Sequence[str] = ("doc_id", "chunk_no"),
    pad_is_eos: bool = False,
) -> DataFrame:
    """Begin marker, ids cut to ``max_length``, padding, attention mask and special-token mask.

    ``keys`` identify a chunk. Tokens of the vocabulary's head are looked up inside the tasks, whole Arrow batches at
    once; only the other tokens of a chunk become rows and are joined with the vocabulary.
    """
    keys = list(keys)
    pad = EOS if pad_is_eos else PAD
    cut = chunks.select(*keys, F.slice(tokenize(F.col("text")), 1, max_length - 1).alias("_tokens"))
    ids = _with_ids(cut, vocab.select("token", "id"), keys)
    filled = F.size("_ids") + 1
    rest = F.lit(max_length) - filled
    return ids.select(
        *keys,
        F.concat(F.array(F.lit(BOS)), "_ids", F.array_repeat(F.lit(pad), rest)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), filled), F.array_repeat(F.lit(0), rest)).alias("attention_mask"),
        F.concat(
            F.array(F.lit(1)), F.array_repeat(F.lit(0), filled - 1), F.array_repeat(F.lit(1), rest)
        ).alias("special_tokens_mask"),
    )


def _head_lookup(cut: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Replace ``_tokens`` with ``_ids`` and ``_others``, the chunk's different tokens outside the head.

    A position of the k-th other token (from 1) has -k as its id.
    """
    head = known.filter((F.col("id") < FIRST_ID + HEAD_TOKENS) & (F.length("token") <= HEAD_CHARS)).toArrow()
    shared = cut.sparkSession.sparkContext.broadcast((head["token"].combine_chunks(), head["id"].combine_chunks()))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids = shared.value
        for batch in batches:
            lists = batch.column("_tokens")
            flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            found = ids.take(pc.index_in(flat, value_set=tokens.cast(flat.type)))
            holes = np.flatnonzero(pc.is_null(found).to_numpy(zero_copy_only=False))
            rare = flat.take(pa.array(holes)).dictionary_encode()
            size = max(len(rare.dictionary), 1)
            chunk = np.searchsorted(ends, holes, side="right") - 1
            own, back = np.unique(chunk * size + rare.indices.to_numpy(), return_inverse=True)
            first = np.searchsorted(own, np.arange(len(batch) + 1) * size)
            places = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).copy()
            places[holes] = first[chunk] - back - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(key) for key in keys],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), rare.dictionary.take(pa.array(own % size)).cast(pa.string())),
                ],
                names=[*keys, "_ids", "_others"],
            )

    types = dict(cut.dtypes)
    schema = ", ".join([f"`{key}` {types[key]}" for key in keys] + ["_ids array<int>", "_others array<string>"])
    return cut.withColumn("_tokens", F.coalesce("_tokens", F.array())).mapInArrow(look_up, schema)


def _with_ids(cut: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Ids of the tokens of each chunk.

    The looked-up chunks are written once. Only their different other tokens become rows, narrow ones, that are joined with
    the vocabulary and gathered by chunk; a chunk's array of ids is shuffled once, to meet them. AQE splits both joins
    where a token or the chunks of an id are frequent.
    """
    looked = materialise(_head_lookup(cut, known, keys), "looked-up")
    rows = looked.select(*keys, F.posexplode("_others").alias("_k", "token"))
    found = rows.join(known, "token", "left").select(*keys, F.struct("_k", F.coalesce("id", F.lit(UNK)).alias("id")).alias("_o"))
    # a chunk has at most max_length tokens here
    gathered = found.groupBy(*[F.col(key).alias(f"_of_{key}") for key in keys]).agg(
        F.sort_array(F.collect_list("_o"))["id"].alias("_found")
    )
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    return looked.join(gathered, same, "left").select(*keys, F.transform("_ids", lambda x: F.when(x < 0, F.get("_found", -x - 1)).otherwise(x)).alias("_ids"))


def causal_labels(input_ids: Column, pad: int = PAD) -> Column:
    """Labels of next-token training: the ids, padding ignored."""
    return F.transform(input_ids, lambda x: F.when(x == pad, F.lit(IGNORED_LABEL)).otherwise(x))


def truncation_report(lengths: DataFrame, *by: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """What fitting ``n_tokens`` per chunk into ``max_length`` costs: truncated chunks, lost tokens, padding."""
    room = max_length - 1
    kept = F.least(F.col("n_tokens"), F.lit(room))
    return lengths.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.col("n_tokens") > room).alias("truncated"),
        F.sum(kept).cast("bigint").alias("tokens_kept"),
        F.sum(F.col("n_tokens") - kept).cast("bigint").alias("tokens_lost"),
        F.round(F.sum(F.lit(room) - kept) / (F.count(F.lit(1)) * max_length), 6).alias("padding_ratio"),
    )
