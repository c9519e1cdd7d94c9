"""Count-based language model: a stand-in scorer whose perplexities compare runs of this library only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialise
from textloom.operators.tokens import FIRST_ID, tokenize, vocabulary

# The context before the first token, and its place and that of unknown tokens in a sweep.
START = "<s>"
START_PLACE = -1
UNKNOWN_PLACE = 0


def bigrams(documents: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """One row per token with the token before it: ``(*keep, context, token)``."""
    tokens = documents.select(*keep, tokenize(F.col(text_col)).alias("_tokens"))
    before = F.concat(F.array(F.lit(START)), F.slice("_tokens", 1, F.greatest(F.size("_tokens") - 1, F.lit(0))))
    pairs = tokens.select(*keep, F.explode(F.arrays_zip(before.alias("context"), F.col("_tokens").alias("token"))).alias("_p"))
    return pairs.select(*keep, "_p.context", "_p.token").filter("token is not null")


def bigram_counts(documents: DataFrame) -> DataFrame:
    """``(context, token, n)``, stored once: a model is read several times, the texts only for this.

    Joins on stored counts are planned from their real size. Hot contexts have many tokens; in a sort-merge
    join AQE splits their partitions.
    """
    counts = bigrams(documents).groupBy("context", "token").agg(F.count(F.lit(1)).alias("n"))
    return materialise(counts, "bigrams")


def ngram_lm(documents: DataFrame) -> DataFrame:
    """Bigram counts with the count of their context: ``(context, token, n, context_n)``."""
    counts = bigram_counts(documents)
    contexts = counts.groupBy("context").agg(F.sum("n").alias("context_n"))
    return counts.join(contexts, "context").select("context", "token", "n", "context_n")


def log_probability(n: Column, context_n: Column, k: Column, classes: Column) -> Column:
    """Add-k estimate; counts are 0 where the model has none."""
    return F.log((F.coalesce(n, F.lit(0)) + k) / (F.coalesce(context_n, F.lit(0)) + k * classes))


def lm_perplexity(train: DataFrame, test: DataFrame, k: float, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """Perplexity of the test documents under bigram counts of the train documents.

    Rows ``(group, key, tokens, loss, perplexity)``: per document, per group (key null) and in total
    (both null). Each text is tokenised once. The log probability is computed once per distinct test
    bigram and joined back; one side of each join is unique on its key, and AQE splits the partitions of
    frequent bigrams, which occur in most documents.
    """
    counts = bigram_counts(train)
    contexts = counts.groupBy("context").agg(F.sum("n").alias("context_n"))
    classes = counts.select("token").distinct().agg(F.count(F.lit(1)) + 1).scalar()
    seen = materialise(
        bigrams(test, key, group).groupBy(key, group, "context", "token").agg(F.count(F.lit(1)).alias("m")), "seen"
    )
    distinct = seen.select("context", "token").distinct()
    known = distinct.join(counts, ["context", "token"], "left")
    scored = known.join(contexts, "context", "left").select(
        "context", "token", log_probability(F.col("n"), F.col("context_n"), F.lit(k), classes).alias("_log_p")
    )
    documents = (
        seen.join(scored, ["context", "token"])
        .groupBy(group, key)
        .agg(F.sum("m").alias("_m"), F.sum(F.col("m") * F.col("_log_p")).alias("_ll"))
    )
    loss = -F.sum("_ll") / F.sum("_m")
    return documents.rollup(group, key).agg(
        F.sum("_m").alias("tokens"), F.round(loss, 6).alias("loss"), F.round(F.exp(loss), 3).alias("perplexity")
    )


def sweep(
    documents: DataFrame, vocab_sizes: Sequence[int], ks: Sequence[float], text_col: str = "text"
) -> DataFrame:
    """Every configuration (order 1 and 2, vocabulary size, k) on the same split, with its loss.

    The corpus is counted once: one row per bigram with its train and test count. Configurations only
    re-aggregate these counts, over token places instead of texts. Tokens outside a vocabulary are one class.
    """
    pairs = materialise(
        bigrams(documents, "split", text_col=text_col)
        .groupBy("context", "token")
        .agg(F.count_if(F.col("split") == "train").alias("n"), F.count_if(F.col("split") == "test").alias("m")),
        "pairs",
    )
    counts = pairs.groupBy("token").agg(F.sum("n").alias("n")).filter("n > 0")
    vocab = vocabulary(counts, max(vocab_sizes))
    place = F.col("id") - FIRST_ID + 1
    token_places = vocab.select("token", place.alias("token_place"))
    context_places = vocab.select(F.col("token").alias("context"), place.alias("context_place"))
    start = F.when(F.col("context") == START, F.lit(START_PLACE))
    placed = (
        pairs.join(token_places, "token", "left")
        .join(context_places, "context", "left")
        .select("token_place", F.coalesce(start, "context_place").alias("context_place"), "n", "m")
    )
    sized = placed.withColumn("vocab_size", F.explode(F.array(*[F.lit(v) for v in vocab_sizes])))

    def inside(place: str) -> Column:
        return F.when(F.col(place) <= F.col("vocab_size"), F.col(place)).otherwise(UNKNOWN_PLACE)

    mapped = materialise(
        sized.groupBy("vocab_size", inside("context_place").alias("context"), inside("token_place").alias("token")).agg(
            F.sum("n").alias("n"), F.sum("m").alias("m")
        ),
        "mapped",
    )
    tokens = mapped.groupBy("vocab_size", "token").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    sizes = tokens.groupBy("vocab_size").agg(
        F.sum("n").alias("context_n"), (F.count_if(F.col("n") > 0) + 1).alias("classes")
    )
    contexts = mapped.groupBy("vocab_size", "context").agg(F.sum("n").alias("context_n"))
    unigram = tokens.join(F.broadcast(sizes), "vocab_size").withColumn("order", F.lit(1))
    bigram = (
        mapped.join(contexts, ["vocab_size", "context"])
        .join(F.broadcast(sizes.select("vocab_size", "classes")), "vocab_size")  # one row per size
        .withColumn("order", F.lit(2))
    )
    columns = ["order", "vocab_size", "n", "m", "context_n", "classes"]
    counted = unigram.select(*columns).unionByName(bigram.select(*columns)).filter("m > 0")
    graded = counted.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
    log_p = log_probability(F.col("n"), F.col("context_n"), F.col("k"), F.col("classes"))
    loss = -F.sum(F.col("m") * log_p) / F.sum("m")
    return graded.groupBy("order", "vocab_size", "k").agg(
        F.sum("m").alias("tokens"), F.round(loss, 6).alias("loss"), F.round(F.exp(loss), 3).alias("perplexity")
    )
