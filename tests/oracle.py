"""Run registered queries and compare them with their SQL in DuckDB.

ORACLE_CONF may add settings, such as spark.sql.autoBroadcastJoinThreshold=-1 to force shuffled joins.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(_cell(row[n]) for n in order) for row in rows)


FAMILY = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(frame, connection, sql: str) -> str | None:
    """None when rows, columns and types agree, else what differs."""
    found = frame.collect()
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    for name, kind in frame.dtypes:
        if FAMILY.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    mine, theirs = normal(found, frame.columns), normal(expected, columns)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{sorted(columns)}: {a} != {b}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from tidemark.plans import ORACLES, QUERIES
    from tidemark.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{
        **dict(pair.split("=", 1) for pair in os.environ.get("ORACLE_CONF", "").split(",") if pair),
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            sql = ORACLES.get(name)
            problem = compare(frame, connection, sql) if sql else f"no SQL, {len(frame.collect())} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        if problem and not problem.startswith("no SQL"):
            bad += 1
        print(f"{'ok  ' if problem is None else 'DIFF'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
