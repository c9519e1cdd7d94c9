"""From raw documents to token ids: language, near copies, benchmark leaks, mixing, output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import golay, language, mixing, orc_tokens, tiling
from textloom.llm.plans import table, tokenizer_path
from textloom.session import work_path

#: The language classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells; it learns from the labelled rows of what it is given."""
    return language.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return golay.first_of_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files, described by what is read back."""
    return orc_tokens.tokenized(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
