"""Compare a Spark result with the reference SQL engine's, ignoring row and column order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime.datetime) and value.time() == datetime.time(0):
        return value.date()
    return value


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in rows)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when names, types and values agree."""
    found = [tuple(r) for r in df.collect()]
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    ours, theirs = _bag(df.columns, found), _bag(columns, expected)
    if ours != theirs:
        problems.append(f"only in Spark {list((ours - theirs).items())[:2]}")
        problems.append(f"only in SQL {list((theirs - ours).items())[:2]}")
    return problems
