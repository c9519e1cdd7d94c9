"""Chat formatting with typed content parts; DataFrame functions only.

A turn's content is a list of parts ``struct<type, text, ref, tokens>``. A visitor goes over the parts in order: a
text part gives its text, an image, audio or document part (any other type counts as an attachment) a numbered placeholder,
its reference, and the number of tokens it expands to: the part's own, or the default of its type. Parts are kept apart by a mark,
so a turn of one text has none.

Template: ``<s>`` turns ``</s>``, a turn being ``<|turn|>`` role ``<|text|>`` content ``<|end|>``. Control strings
inside roles and texts get a backslash after their first character; one that has backslashes there already
gets one more, so taking one away from each restores every text exactly. The loss mask is a list of
``(start, length)`` in code points of the formatted text: the contents of assistant turns. Read back, each piece
between marks is unescaped by itself.

Scale: positions are running sums in a window over the conversation, which the aggregate after it shares; a
conversation is one output row, as long as its turns are. Nothing else is gathered.

Results for odd input: turns stand by number, then role, then content; null numbers come first. Null texts, roles and parts are empty. Repeated
rows are turns of their own. A null conversation id is one conversation. Turns without parts have empty content. Empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import store

BEGIN, FINISH = "<s>", "</s>"
TURN, TEXT, END, PART = "<|turn|>", "<|text|>", "<|end|>", "<|part|>"
#: First character, rest of every control string.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|[a-z]+(?::[0-9]+)?\|>)"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|\|[a-z]+(?::[0-9]+)?\|>)"
TURNS = r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>"
#: Tokens an attachment expands to when the part does not say.
TOKENS = {"image": 256, "audio": 750, "document": 1_024}
OTHER_TOKENS = 64
ATTACHMENT = r"<\|(?:image|audio|document|attachment):[0-9]+\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def is_text(part: Column) -> Column:
    return part["type"].eqNullSafe("text") | part["type"].isNull()


def kind_of(part: Column) -> Column:
    return F.when(part["type"].isin(*TOKENS), part["type"]).otherwise("attachment")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    nothing = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            nothing.cast("string").alias("ref"),
            nothing.cast("int").alias("tokens"),
        )
    )


def visit(parts: Column) -> tuple[Column, Column]:
    """Content of a turn, and its attachments ``array<struct<number, type, ref, tokens>>`` in order."""
    parts = F.coalesce(F.filter(parts, lambda p: p.isNotNull()), F.array().cast("array<struct<type:string,text:string,ref:string,tokens:int>>"))

    def number(i: Column) -> Column:
        return F.size(F.filter(F.slice(parts, 1, i + 1), lambda p: ~is_text(p)))

    def piece(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<|"), kind_of(p), F.lit(":"), number(i).cast("string"), F.lit("|>"))
        return F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark)

    def record(p: Column, i: Column) -> Column:
        default = F.coalesce(F.create_map(*[F.lit(x) for kv in TOKENS.items() for x in kv])[p["type"]], F.lit(OTHER_TOKENS))
        return F.struct(
            (i + 1).alias("number"), p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["tokens"], default).alias("tokens")
        )

    attachments = F.transform(F.filter(parts, lambda p: ~is_text(p)), record)
    return F.array_join(F.transform(parts, piece), PART), attachments


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """``(conv_id, formatted, loss_spans, attachments, attachment_tokens)``, one row per conversation."""
    content, attachments = visit(F.col(parts))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        content.alias("content"),
        attachments.alias("attachments"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = rows.withColumn("head", F.char_length(head)).withColumn("body", F.concat(head, "content", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    before = F.coalesce(F.sum(F.char_length("body")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + len(BEGIN) + F.col("head")
    span = F.struct(start.alias("start"), F.char_length("content").cast("long").alias("length"))
    placed = rows.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("n"),
            "body",
            F.when(F.col("role").isin(*trained), span).alias("span"),
            "attachments",
        ).alias("t"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    linked = F.flatten(
        F.transform("t", lambda t: F.transform(t["attachments"], lambda a: F.struct(t["n"].alias("turn_no"), a["number"].alias("number"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    )
    return whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("t", lambda t: t["body"]), ""), F.lit(FINISH)).alias("formatted"),
        F.filter(F.transform("t", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        linked.alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def plain(content: Column) -> Column:
    """Text of a content: the unescaped pieces of its parts, placeholders as they stand."""
    pieces = F.split(content, r"<\|part\|>", -1)
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(f"^{ATTACHMENT}$"), p).otherwise(unescape(p))), "")


def read_chats(chats: DataFrame) -> DataFrame:
    """Turns back from formatted texts: ``(conv_id, turns array<struct<role, text>>, loss_text)``."""
    roles = F.regexp_extract_all("formatted", F.lit(TURNS), F.lit(1))
    texts = F.regexp_extract_all("formatted", F.lit(TURNS), F.lit(2))
    masked = F.transform(
        "loss_spans", lambda s: plain(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    turns = F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), plain(t).alias("text")))
    return chats.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def chat_digest(turns: DataFrame) -> DataFrame:
    """Format ``(conv_id, turn, role, text)``, write the chats, and describe what is read back from them."""
    rows = turns.withColumn("_parts", text_part(F.col("text")))
    chats, _ = store(format_chats(rows, parts="_parts"), "chats")
    back = read_chats(chats)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def marked_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1: control strings in a user and an assistant turn."""
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|[a-z]+(?::[0-9]+)?\|>)', '\1\\\2\3', 'g') AS escaped FROM t),
g AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         (sum(length(role) + length(escaped) + 23) + 7)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""
