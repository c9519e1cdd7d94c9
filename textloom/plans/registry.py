"""All registered queries and oracles."""

from __future__ import annotations

from textloom.plans import corpus, rows, runs, streams, text

GROUPS = [corpus, text, rows, runs, streams]


def queries() -> dict:
    return {name: run for group in GROUPS for name, run in group.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
