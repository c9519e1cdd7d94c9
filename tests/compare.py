"""Side-by-side run of registered queries on Spark and their oracles on DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Spark type -> DuckDB type a matching oracle column has
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(rows, order):
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def mismatch(spark, con, sf_dir: str, run, sql: str | None) -> str | None:
    """None when both sides agree, else a short description."""
    frame = run(spark, sf_dir)
    names = frame.columns
    rows = [tuple(r) for r in frame.collect()]
    if sql is None:
        return None if rows else "no rows"
    result = con.execute(sql)
    oracle_names = [d[0] for d in result.description]
    oracle_types = dict(zip(oracle_names, [str(d[1]) for d in result.description]))
    oracle = result.fetchall()
    if sorted(names) != sorted(oracle_names):
        return f"columns {sorted(names)} vs {sorted(oracle_names)}"
    for name, kind in frame.dtypes:
        if TYPES.get(kind, kind) != oracle_types[name]:
            return f"type of {name}: {kind} vs {oracle_types[name]}"
    if len(rows) != len(oracle):
        return f"{len(rows)} rows vs {len(oracle)}"
    if not rows:
        return "no rows"
    left = _rows(rows, [names.index(n) for n in sorted(names)])
    right = _rows(oracle, [oracle_names.index(n) for n in sorted(names)])
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(names)}: {str(a)[:600]} vs {str(b)[:600]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from textloom.plans import registry
    from textloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell")
    session = build_session(master="local[8]")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    oracles = registry.oracles()
    for key, run in registry.queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            problem = mismatch(session, database, folder, run, oracles.get(key))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - start:.1f}s {problem or ''}", flush=True)
