"""Rows of a Spark result against rows of DuckDB, order aside."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    value = lambda x: round(x, 6) if isinstance(x, float) else x
    return names, sorted((tuple(map(value, r)) for r in zip(*[table[n].to_pylist() for n in names], strict=True)), key=repr)


def duck(con: duckdb.DuckDBPyConnection, sql: str):
    return con.sql(sql).to_arrow_table()


def same(df, con, sql: str) -> int:
    """Assert equal rows and columns; the number of rows."""
    names, got = rows(df.toArrow())
    other, want = rows(duck(con, sql))
    assert names == other
    assert len(got) == len(want)
    assert got == want
    return len(got)
