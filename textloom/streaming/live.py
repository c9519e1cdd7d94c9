"""Status of runs kept by a stream, with timers: a run that falls silent ends without a new line."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

OUTPUT = "run string, status string, has_pid boolean, has_stats boolean, last_ts timestamp"
STATE = "has_pid boolean, has_stats boolean, last_ms long, timer_ms long"


class RunWatch(StatefulProcessor):
    """State of one run: what is known of it, its newest line and the timer at which it counts as silent.

    Status follows the batch rules with the watermark as the time: no marker is Unknown, a line within the quiet time
    is Running, statistics are Completed, else Failed.
    """

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        has_pid, has_stats, last, timer = self.known.get() if self.known.exists() else (False, False, 0, 0)
        for frame in rows:
            has_pid = has_pid or bool(frame["has_pid"].fillna(False).any())
            has_stats = has_stats or bool(frame["has_stats"].fillna(False).any())
            last = max(last, int(frame["last_ms"].max()))
        due = last + self.quiet_ms + 1
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.known.update((has_pid, has_stats, last, due))
        yield self._row(key, has_pid, has_stats, last, due > timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        has_pid, has_stats, last, _ = self.known.get()
        self.known.update((has_pid, has_stats, last, 0))
        yield self._row(key, has_pid, has_stats, last, False)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, has_pid: bool, has_stats: bool, last: int, alive: bool) -> pd.DataFrame:
        status = "Unknown" if not has_pid else "Running" if alive else "Completed" if has_stats else "Failed"
        return pd.DataFrame(
            {"run": [key[0]], "status": [status], "has_pid": [has_pid], "has_stats": [has_stats], "last_ts": pd.to_datetime([last], unit="ms")}
        )


def live_status(lines: DataFrame, quiet_seconds: int, delay: str, has_pid: Column, has_stats: Column) -> DataFrame:
    """Runs whose status may have changed, ``(run, status, has_pid, has_stats, last_ts)``, in update mode.

    ``lines`` is a stream with ``run`` and ``ts``; ``has_pid`` and ``has_stats`` tell whether a row is, or shows, the run's
    marker or its statistics. Rows of a run come in Arrow batches, so a run may have any number in a trigger. The watermark is the newest ``ts`` less ``delay``; rows
    behind it are dropped. The session needs the RocksDB state store and the UTC time zone.
    """
    facts = lines.select("run", "ts", F.unix_millis("ts").alias("last_ms"), has_pid.alias("has_pid"), has_stats.alias("has_stats"))
    return (
        facts.withWatermark("ts", delay)
        .groupBy("run")
        .transformWithStateInPandas(RunWatch(quiet_seconds * 1_000), OUTPUT, "Update", "EventTime")
    )
