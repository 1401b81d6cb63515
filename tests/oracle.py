"""Compare a checked query with its SQL: rows, column types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=lambda r: [str(v) for v in r])


def compare(df, con, sql) -> list[str]:
    """Differences, none when equal."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    names = sorted(types)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} instead of {names}"]
    problems = [
        f"{name}: {kind} instead of {types[name]}"
        for name, kind in df.dtypes
        if TYPES.get(kind, kind) != types[name]
    ]
    order = [list(types).index(n) for n in names]
    got = _sorted(df.select(*[f"`{n}`" for n in names]).toLocalIterator())
    want = _sorted(tuple(r[i] for i in order) for r in expected)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows instead of {len(want)}")
    elif got != want:
        at = next(i for i, (a, b) in enumerate(zip(got, want)) if a != b)
        problems.append(f"row {got[at]} instead of {want[at]}")
    return problems
