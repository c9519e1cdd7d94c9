"""Turn rows to role-delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The markers of the chat format.
BEGIN_OF_TEXT = "<|begin_of_text|>"
START_HEADER = "<|start_header_id|>"
END_HEADER = "<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
BLANKS = " \t\n\r\f\x0b"


def chat_encode(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, text)`` of rows ``(key, turn, role, text)`` with turns numbered from 0, one row per conversation."""
    header = F.concat(F.lit(START_HEADER), F.col("role"), F.lit(END_HEADER + "\n\n"))
    body = F.concat(header, F.trim(F.col("text"), F.lit(BLANKS)), F.lit(END_OF_TURN))
    begin = F.when(F.col("turn") == 0, F.lit(BEGIN_OF_TEXT)).otherwise("")
    rendered = turns.select(key, F.struct("turn", F.concat(begin, body).alias("text")).alias("_turn"))
    return rendered.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("_turn"))["text"], "").alias("text"))
