"""Column functions on times, durations and run names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of manifests and statistics, of file names, and of default run names.
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FILE_STAMP_FORMAT = "yyyyMMdd_HHmmss"
RUN_STAMP_FORMAT = "yyyyMMdd-HHmmss"
# A log line is "yyyy-MM-dd HH:mm:ss,SSS - LEVEL - message".
LOG_SEPARATOR = " - "
LOG_STAMP_CHARS = 23


def stamp(ts: Column, fmt: str = STAMP_FORMAT) -> Column:
    return F.date_format(ts, fmt)


def log_stamp(ts: Column) -> Column:
    """Time as a log line prints it."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss,SSS")


def parse_log_stamp(line: Column) -> Column:
    """Time at the start of a log line, null when the line has none."""
    shaped = (F.substring(line, 20, 1) == ",") & (
        F.substring(line, LOG_STAMP_CHARS + 1, len(LOG_SEPARATOR)) == LOG_SEPARATOR
    )
    text = F.concat(F.substring(line, 1, 19), F.lit("."), F.substring(line, 21, 3))
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def duration_text(seconds: Column) -> Column:
    """``0h 24m 12s``: whole hours, minutes and seconds, fractions dropped."""
    whole = F.floor(seconds)
    return F.concat(
        F.floor(whole / 3600).cast("string"),
        F.lit("h "),
        F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("string"),
        F.lit("m "),
        F.pmod(whole, F.lit(60)).cast("string"),
        F.lit("s"),
    )


def parse_duration(text: Column) -> Column:
    pattern = "([0-9]+)h ([0-9]+)m ([0-9]+)s"
    part = [F.regexp_extract(text, pattern, i).try_cast("bigint") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]


def run_name(name: Column, started: Column, prefix: str = "run-") -> Column:
    """Given name, or the prefix with the start time."""
    return F.coalesce(F.when(name != "", name), F.concat(F.lit(prefix), F.date_format(started, RUN_STAMP_FORMAT)))
