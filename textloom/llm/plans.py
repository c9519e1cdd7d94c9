"""Registered queries of this subpackage, with production parameters on whole tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    chat_parts,
    crf,
    golay,
    importance,
    language,
    mixing,
    orc_tokens,
    permutation,
    ranked,
    shallot,
    tiles,
    tiling,
    toxicity,
)

QUERIES = {}
ORACLES = {
    "op8_mixing": mixing.ORACLE,
    "op10_chat_parts": chat_parts.ORACLE,
    "op11_ranked": ranked.ORACLE,
    "op12_shallot": shallot.ORACLE,
}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps: good text of the labels is the target."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), good)
    return found.filter("kept")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_golay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = golay.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_vector_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.place(table(spark, sf_dir, "documents"))


@query
def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.extract_main(table(spark, sf_dir, "pages"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.tokenized(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op10_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_parts.chat_digest(turns.unionByName(chat_parts.marked_conversation(spark)))


@query
def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the vectors after ten rounds from eight starts."""
    return shallot.cluster(table(spark, sf_dir, "embeddings"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
