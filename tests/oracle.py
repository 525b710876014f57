"""Compare a registered query with its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = [tuple(_plain(row[k]) for k in order) for row in data]
    return sorted(plain, key=repr)


def compare(con, df, sql):
    """Number of rows; raises when names or rows differ."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(expected_columns), (df.columns, expected_columns)
    expected = rows(expected_columns, result.fetchall())
    actual = rows(df.columns, [tuple(row) for row in df.collect()])
    if actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
        raise AssertionError(f"{len(actual)} rows, expected {len(expected)}; first: {pairs[:1]}")
    return len(actual)
