"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math

import duckdb

from airsight.catalog.adapters import TABLES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def differences(df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    names, kinds = [d[0] for d in cur.description], {d[0]: str(d[1]) for d in cur.description}
    theirs = _rows(names, cur.fetchall())
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            out.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(mine) != len(theirs):
        out.append(f"{len(mine)} rows against {len(theirs)}")
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if differing:
        out.append(f"{len(differing)} rows differ ({sorted(names)}): {differing[:2]}")
    if not mine:
        out.append("no rows")
    return out
