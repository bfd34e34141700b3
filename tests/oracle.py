"""Run a registered query and its oracle, and compare their rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def rows_of(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def mismatch(connection, frame, sql: str) -> str | None:
    got_names, got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    want_names, want = rows_of([column[0] for column in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        return (
            f"{got.total()} rows against {want.total()}; "
            f"only ours {list((got - want).items())[:3]}; only theirs {list((want - got).items())[:3]}"
        )
    if not got:
        return "no rows"
    return None
