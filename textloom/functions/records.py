"""Column functions on structured text and metric maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mark a failure as out of memory.
OOM_TEXTS = ["CUDA out of memory", "not enough memory"]


def classify_error(message: Column) -> Column:
    """``success`` without a message, ``oom`` for memory failures, else ``fail``."""
    oom = message.contains(OOM_TEXTS[0])
    for text in OOM_TEXTS[1:]:
        oom = oom | message.contains(text)
    return F.when(message.isNull() | (message == ""), "success").when(oom, "oom").otherwise("fail")


def prefix_metrics(metrics: Column, namespace: str) -> Column:
    """Map keys as ``namespace/key``."""
    return F.transform_keys(metrics, lambda k, _: F.concat(F.lit(namespace + "/"), k))


def kv_field(body: Column, key: str) -> Column:
    """Text after ``key: `` on its own line of a ``key: value`` text; null when there is none."""
    value = F.regexp_extract(body, "(?:^|\n)" + key + ": *([^\n]*)", 1)
    return F.when(value != "", value)


def kv_arguments(body: Column) -> Column:
    """Map of the indented ``name: value`` lines below ``Arguments:``; of a repeated name the last line counts."""
    block = F.substring_index(body, "Arguments:\n", -1)
    lines = F.filter(F.split(block, "\n"), lambda line: line.startswith("  ") & line.contains(":"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.trim(F.substring_index(line, ":", 1)).alias("key"),
            F.trim(F.regexp_replace(line, "^[^:]*:", "")).alias("value"),
        ),
    )

    def repeated(pair: Column, i: Column) -> Column:
        later = F.slice(pairs, i + 2, F.size(pairs))
        return F.exists(later, lambda p: p["key"] == pair["key"])

    return F.map_from_entries(F.filter(pairs, lambda pair, i: ~repeated(pair, i)))


def single_quoted_metrics(text: Column) -> Column:
    """Map of a printed dictionary such as ``{'eval_loss': 2.1, 'epoch': 1.0}``."""
    return F.from_json(F.regexp_extract(text, "\\{.*\\}", 0), "map<string,double>", {"allowSingleQuotes": "true"})
