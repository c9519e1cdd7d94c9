"""Registered queries on text: functions, tokens, encoding, batches, language model, sweep."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from textloom.functions import text as tf
from textloom.operators import batches, chat, model, tokens
from textloom.operators import documents as docs
from textloom.operators.runs import perplexity
from textloom.operators.split import train_test_split
from textloom.plans.corpus import BASE_ALL, BASE_KEPT, CHUNKS_SQL, PARAGRAPH, SPLIT_SQL, all_chunks, documents
from textloom.session import materialise, spread
from textloom.tables import load

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


PATTERN_SQL = r"'[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r\f\x0b]+'"

VOCAB_SQL = f"""
toks AS (SELECT unnest(regexp_extract_all(text, {PATTERN_SQL})) AS token FROM documents),
counts AS (SELECT token, count(*) AS n FROM toks GROUP BY token),
vocab AS (SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id FROM counts)
"""

ENCODE_SQL = f"""
{CHUNKS_SQL}, {VOCAB_SQL},
pieces AS (
  SELECT doc_id, chunk_no, unnest(regexp_extract_all(text, {PATTERN_SQL})) AS token,
         generate_subscripts(regexp_extract_all(text, {PATTERN_SQL}), 1) AS pos FROM chunks
),
looked AS (SELECT doc_id, chunk_no, pos, coalesce(b.id, 1) AS id FROM pieces LEFT JOIN vocab b USING (token) WHERE pos <= 511),
ids AS (
  SELECT c.doc_id, c.chunk_no, coalesce(list(l.id ORDER BY l.pos) FILTER (l.id IS NOT NULL), []) AS ids
  FROM chunks c LEFT JOIN looked l USING (doc_id, chunk_no) GROUP BY ALL
),
encoded AS (
  SELECT doc_id, chunk_no, len(ids) + 1 AS filled,
         list_concat([2], ids, list_transform(range(511 - len(ids)), lambda x: 0)) AS input_ids
  FROM ids
)
"""


# --- scalar functions ---------------------------------------------------------------------------


@query(
    "str_functions",
    """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS paragraphs, length(text) AS chars,
       '/corpus/' || source || '/doc_' || doc_id || '.txt' AS path, 'doc_' || doc_id || '.txt' AS name,
       md5(replace(text, chr(10), ' ')) AS flat_md5
FROM documents""",
)
def str_functions(spark, sf_dir):
    path = tf.join_path(
        F.concat(F.lit("/corpus/"), F.col("source")), F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))
    )
    return documents(spark, sf_dir).select(
        "doc_id",
        F.size(tf.paragraphs(F.col("text"), PARAGRAPH)).alias("paragraphs"),
        F.length("text").cast("bigint").alias("chars"),
        path.alias("path"),
        tf.base_name(path).alias("name"),
        F.md5(F.replace(F.col("text"), F.lit(PARAGRAPH), F.lit(" "))).alias("flat_md5"),
    )


@query(
    "split_list",
    """SELECT doc_id, len(string_split(text, ',')) AS parts,
       md5(array_to_string(string_split(text, ','), '|')) AS parts_md5,
       CASE WHEN source <> '' THEN array_to_string(string_split(source || ',' || lang, ','), '|') END AS tags
FROM documents""",
)
def split_list(spark, sf_dir):
    parts = tf.split_list(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id",
        F.size(parts).cast("bigint").alias("parts"),
        F.md5(F.array_join(parts, "|")).alias("parts_md5"),
        F.array_join(tf.split_list(F.concat_ws(",", "source", "lang"), empty_as_null=True), "|").alias("tags"),
    )


@query("digest", "SELECT doc_id, md5(text) AS digest FROM documents")
def digest(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tf.digest(F.col("text")).alias("digest"))


# --- tokens and encoding ------------------------------------------------------------------------


@query(
    "tokenize",
    f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, regexp_extract_all(text, {PATTERN_SQL}) AS t FROM documents)""",
)
def tokenize(spark, sf_dir):
    source = spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    cut = source.select("doc_id", tokens.tokenize(F.col("text")).alias("t"))
    return cut.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


def whitespace_tokenizer():
    """Example of a user tokenizer for the batched hook."""
    return lambda texts: [text.split(" ") for text in texts]


@query(
    "tokenize_hook",
    "SELECT doc_id, len(string_split(text, ' ')) AS n_tokens FROM documents",
)
def tokenize_hook(spark, sf_dir):
    source = spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return tokens.tokenize_with(source, whitespace_tokenizer).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens")
    )


def corpus_counts(spark, sf_dir):
    return tokens.token_counts(spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id"))


@query("vocab", f"WITH {VOCAB_SQL} SELECT token, n, id FROM vocab")
def vocab(spark, sf_dir):
    return tokens.vocabulary(corpus_counts(spark, sf_dir))


@query(
    "vocab_lookup",
    f"""WITH {VOCAB_SQL}, top AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 AS id FROM counts
        QUALIFY row_number() OVER (ORDER BY n DESC, token) <= 1000),
words AS (SELECT conv_id, unnest(regexp_extract_all(text, {PATTERN_SQL})) AS token FROM conversations)
SELECT conv_id, count(*) AS tokens, count(*) FILTER (id IS NULL) AS unknown, CAST(sum(coalesce(id, 1)) AS BIGINT) AS id_sum
FROM words LEFT JOIN top USING (token) GROUP BY conv_id""",
)
def vocab_lookup(spark, sf_dir):
    """Conversation tokens against the 1,000 most frequent document tokens."""
    known = tokens.vocabulary(corpus_counts(spark, sf_dir), 1000)
    words = load(spark, sf_dir, "conversations").select(
        "conv_id", F.explode(tokens.tokenize(F.col("text"))).alias("token")
    )
    found = tokens.vocab_lookup(words, known)
    return found.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(F.col("id") == tokens.UNK).alias("unknown"),
        F.sum("id").alias("id_sum"),
    )


def encoded(spark, sf_dir):
    known = tokens.vocabulary(corpus_counts(spark, sf_dir))
    return tokens.encode(all_chunks(spark, sf_dir), known)


@query(
    "encode",
    f"""WITH RECURSIVE {BASE_ALL}, {ENCODE_SQL}
SELECT doc_id, chunk_no, md5(array_to_string(input_ids, ' ')) AS ids_md5,
       CAST(filled AS BIGINT) AS attended, CAST(1 + 512 - filled AS BIGINT) AS special, len(input_ids) AS length
FROM encoded""",
)
def encode(spark, sf_dir):
    def total(name):
        return F.aggregate(name, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return encoded(spark, sf_dir).select(
        "doc_id",
        "chunk_no",
        F.md5(F.array_join(F.col("input_ids").cast("array<string>"), " ")).alias("ids_md5"),
        total("attention_mask").alias("attended"),
        total("special_tokens_mask").alias("special"),
        F.size("input_ids").cast("bigint").alias("length"),
    )


@query(
    "causal_labels",
    f"""WITH RECURSIVE {BASE_ALL}, {ENCODE_SQL}
SELECT doc_id, chunk_no,
       md5(array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ' ')) AS labels_md5
FROM encoded""",
)
def causal_labels(spark, sf_dir):
    labels = tokens.causal_labels(F.col("input_ids"))
    return encoded(spark, sf_dir).select(
        "doc_id", "chunk_no", F.md5(F.array_join(labels.cast("array<string>"), " ")).alias("labels_md5")
    )


@query(
    "truncation_report",
    f"""WITH RECURSIVE {BASE_ALL}, {CHUNKS_SQL},
sized AS (SELECT lang, len(regexp_extract_all(c.text, {PATTERN_SQL})) AS n FROM chunks c JOIN documents d USING (doc_id))
SELECT lang, count(*) AS chunks, count(*) FILTER (n > 511) AS truncated,
       CAST(sum(least(n, 511)) AS BIGINT) AS tokens_kept, CAST(sum(n - least(n, 511)) AS BIGINT) AS tokens_lost,
       round(sum(511 - least(n, 511)) / (count(*) * 512), 6) AS padding_ratio
FROM sized GROUP BY lang""",
)
def truncation_report(spark, sf_dir):
    from textloom.operators.chunks import chunk_paragraphs

    source = spread(documents(spark, sf_dir).select("doc_id", "lang", "text"), "doc_id")
    lengths = chunk_paragraphs(source, PARAGRAPH).select("lang", F.size(tokens.tokenize(F.col("text"))).alias("n_tokens"))
    return tokens.truncation_report(lengths, "lang")


@query(
    "chat_encode",
    """SELECT conv_id, '<|begin_of_text|>' || string_agg(
  '<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) ||
  trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) || '<|eot_id|>', '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
)
def chat_encode(spark, sf_dir):
    return chat.chat_encode(load(spark, sf_dir, "conversations"))


# --- batches ------------------------------------------------------------------------------------


@query(
    "epoch_batches",
    f"""WITH RECURSIVE {BASE_KEPT}, {SPLIT_SQL}, epochs AS (SELECT unnest([0, 1, 2]) AS epoch),
placed AS (SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || doc_id), doc_id) - 1 AS p
  FROM members, epochs WHERE split = 'train')
SELECT CAST(epoch AS INTEGER) AS epoch, p // 16 AS batch_id, CAST(p % 16 AS INTEGER) AS pos_in_batch, p // 16 // 2 AS step, doc_id
FROM placed""",
)
def epoch_batches(spark, sf_dir):
    kept = docs.min_chars(documents(spark, sf_dir).select("doc_id", "n_chars"), length_col="n_chars")
    train = train_test_split(kept).filter(F.col("split") == "train")
    return batches.epoch_batches(train, ["doc_id"], epochs=3, batch_size=16, accumulation=2)


FRONTIER_SQL = f"""
{CHUNKS_SQL},
costs AS (SELECT row_number() OVER (ORDER BY doc_id, chunk_no) AS rn,
                 least(len(regexp_extract_all(text, {PATTERN_SQL})) + 1, 512) AS cost FROM chunks),
sizes AS (SELECT CAST(unnest(range(1, 65)) AS INTEGER) AS batch_size),
totals AS (SELECT batch_size, (rn - 1) // batch_size AS b, sum(cost) AS total FROM costs, sizes GROUP BY ALL),
frontier AS (SELECT batch_size, CAST(max(total) AS BIGINT) AS worst_cost, max(total) <= 12000 AS fits FROM totals GROUP BY 1)
"""


def frontier(spark, sf_dir):
    cost = F.least(F.size(tokens.tokenize(F.col("text"))) + 1, F.lit(tokens.MAX_LENGTH))
    return batches.batch_size_frontier(
        all_chunks(spark, sf_dir).select("doc_id", "chunk_no", cost.alias("cost")), ["doc_id", "chunk_no"], "cost", 1, 64, 12000
    )


@query(
    "batch_size_frontier",
    f"WITH RECURSIVE {BASE_ALL}, {FRONTIER_SQL} SELECT batch_size, worst_cost, fits FROM frontier",
)
def batch_size_frontier(spark, sf_dir):
    return frontier(spark, sf_dir)


@query(
    "largest_batch",
    f"""WITH RECURSIVE {BASE_ALL}, {FRONTIER_SQL}
SELECT max(batch_size) FILTER (fits) AS largest_fit,
       (SELECT max(f.batch_size) FROM frontier f WHERE NOT EXISTS (
          SELECT 1 FROM frontier g WHERE g.batch_size <= f.batch_size AND NOT g.fits)) AS largest_safe FROM frontier""",
)
def largest_batch(spark, sf_dir):
    return batches.largest_batch(frontier(spark, sf_dir), 1, 64)


def log_id_losses():
    """Example scorer: the loss of a labelled position is ln(1 + label)."""
    return lambda rows, labels: [np.log1p(gold[gold != tokens.IGNORED_LABEL]).sum() for gold in labels]


def stored_scores(spark, sf_dir):
    """Chunks encoded and scored once; the narrow scores are stored, for plan and result read them."""
    rows = encoded(spark, sf_dir).withColumn("labels", tokens.causal_labels(F.col("input_ids")))
    return materialise(batches.score_rows(rows, log_id_losses), "scores")


SCORED_SQL = f"""
{ENCODE_SQL},
rows AS (SELECT doc_id, chunk_no, len(input_ids) AS positions,
                list_transform(list_filter(input_ids, lambda x: x <> 0), lambda x: ln(1 + x)) AS losses FROM encoded),
scored AS (SELECT doc_id, chunk_no, positions, len(losses) AS labelled, list_sum(losses) AS loss_sum FROM rows)
"""


@query(
    "score_batches",
    f"""WITH RECURSIVE {BASE_ALL}, {SCORED_SQL},
placed AS (SELECT *, (row_number() OVER (ORDER BY md5('42:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1) // 4 AS batch_id FROM scored)
SELECT batch_id, round(sum(loss_sum) / sum(labelled), 6) AS loss, CAST(sum(positions) AS BIGINT) AS positions FROM placed GROUP BY batch_id""",
)
def score_batches(spark, sf_dir):
    scores = stored_scores(spark, sf_dir)
    plan = batches.epoch_batches(scores.select("doc_id", "chunk_no"), ["doc_id", "chunk_no"], 1, 4)
    return batches.score_batches(scores, plan).select("batch_id", F.round("loss", 6).alias("loss"), "positions")


@query(
    "evaluate_perplexity",
    f"""WITH RECURSIVE {BASE_ALL}, {SCORED_SQL},
placed AS (SELECT *, (row_number() OVER (ORDER BY doc_id, chunk_no) - 1) // 4 AS batch_id FROM scored),
per_batch AS (SELECT sum(loss_sum) / sum(labelled) AS loss, sum(positions) AS positions FROM placed GROUP BY batch_id)
SELECT round(exp(sum(loss * positions) / sum(positions)), 6) AS perplexity, CAST(sum(positions) AS BIGINT) AS weight FROM per_batch""",
)
def evaluate_perplexity(spark, sf_dir):
    """Batches of four in dataset order, the mean loss of each over its labelled positions, weighted by positions."""
    scores = stored_scores(spark, sf_dir)
    scored = batches.score_batches(scores, batches.evaluation_plan(scores))
    return perplexity(scored, weight="positions")


# --- language model -----------------------------------------------------------------------------

MODEL_SQL = rf"""
{SPLIT_SQL},
tok AS (SELECT doc_id, lang, split, unnest(t) AS token, unnest(list_concat(['<s>'], t[:-2])) AS context
  FROM (SELECT doc_id, lang, split, regexp_extract_all(text, {PATTERN_SQL}) AS t FROM members) WHERE len(t) > 0)
"""


def kept_members(spark, sf_dir):
    kept = docs.min_chars(documents(spark, sf_dir), length_col="n_chars")
    return spread(train_test_split(kept).select("doc_id", "lang", "split", "text"), "doc_id")


@query(
    "ngram_lm",
    f"""WITH {BASE_KEPT}, {MODEL_SQL}
SELECT context, token, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY context) AS BIGINT) AS context_n
FROM tok WHERE split = 'train' GROUP BY context, token""",
)
def ngram_lm(spark, sf_dir):
    return model.ngram_lm(kept_members(spark, sf_dir).filter(F.col("split") == "train"))


@query(
    "lm_perplexity",
    f"""WITH {BASE_KEPT}, {MODEL_SQL},
train AS (SELECT context, token, count(*) AS n FROM tok WHERE split = 'train' GROUP BY ALL),
ctx AS (SELECT context, sum(n) AS cn FROM train GROUP BY context),
v AS (SELECT count(DISTINCT token) + 1 AS v FROM train),
scored AS (
  SELECT t.doc_id, t.lang, ln((coalesce(n, 0) + 0.1::DOUBLE) / (coalesce(cn, 0) + 0.1::DOUBLE * v)) AS lp
  FROM tok t LEFT JOIN train USING (context, token) LEFT JOIN ctx USING (context), v WHERE t.split = 'test'
)
SELECT lang, doc_id, count(*) AS tokens, round(-sum(lp) / count(*), 6) AS loss, round(exp(-sum(lp) / count(*)), 3) AS perplexity
FROM scored GROUP BY GROUPING SETS ((lang, doc_id), (lang), ())""",
)
def lm_perplexity(spark, sf_dir):
    members = kept_members(spark, sf_dir)
    return model.lm_perplexity(
        members.filter(F.col("split") == "train"), members.filter(F.col("split") == "test"), k=0.1
    )


@query(
    "sweep",
    f"""WITH {BASE_KEPT}, {MODEL_SQL},
counts AS (SELECT token, count(*) AS n FROM tok WHERE split = 'train' GROUP BY token),
ranks AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS place FROM counts),
sizes AS (SELECT unnest([1000, 10000]) AS vocab_size),
mapped AS (
  SELECT vocab_size, split,
         CASE WHEN t.context = '<s>' OR c.place <= vocab_size THEN t.context ELSE '<unk>' END AS context,
         CASE WHEN r.place <= vocab_size THEN t.token ELSE '<unk>' END AS token
  FROM tok t LEFT JOIN ranks r ON r.token = t.token LEFT JOIN ranks c ON c.token = t.context, sizes
),
pairs AS (SELECT vocab_size, context, token, count(*) FILTER (split = 'train') AS n, count(*) FILTER (split = 'test') AS m
  FROM mapped GROUP BY ALL),
uni AS (SELECT vocab_size, token, sum(n) AS n, sum(m) AS m FROM pairs GROUP BY ALL),
tot AS (SELECT vocab_size, sum(n) AS cn, count(*) FILTER (n > 0) + 1 AS v FROM uni GROUP BY ALL),
ctx AS (SELECT vocab_size, context, sum(n) AS cn FROM pairs GROUP BY ALL),
graded AS (
  SELECT 1 AS "order", vocab_size, n, m, cn, v FROM uni JOIN tot USING (vocab_size)
  UNION ALL
  SELECT 2, p.vocab_size, n, m, x.cn, v FROM pairs p JOIN ctx x USING (vocab_size, context) JOIN tot t ON t.vocab_size = p.vocab_size
),
ks AS (SELECT CAST(unnest([0.1, 1.0]) AS DOUBLE) AS k)
SELECT "order", vocab_size, k, CAST(sum(m) AS BIGINT) AS tokens, round(-sum(m * ln((n + k) / (cn + k * v))) / sum(m), 6) AS loss,
       round(exp(-sum(m * ln((n + k) / (cn + k * v))) / sum(m)), 3) AS perplexity
FROM graded, ks WHERE m > 0 GROUP BY "order", vocab_size, k""",
)
def sweep(spark, sf_dir):
    """Eight configurations on one split, counted once."""
    return model.sweep(kept_members(spark, sf_dir), [1000, 10000], [0.1, 1.0])
