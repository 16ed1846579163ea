"""Compare a Spark result with a DuckDB result, independent of row order."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if columns and rows agree, else what differs."""
    result = con.execute(sql)
    names = sorted(c[0] for c in result.description)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} vs {names}"
    order = [[c[0] for c in result.description].index(n) for n in names]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=key)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}: {a} vs {b}"
    return ""
