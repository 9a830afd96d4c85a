"""Compare a Spark result with the same query in DuckDB: column names, types, rows, values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "float": "FLOAT", "timestamp": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return db


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return 0.0 if v == 0 and isinstance(v, float) else v


def compare(df, db, sql: str) -> list[str]:
    """Differences, empty when equal."""
    problems = []
    result = db.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    want_names = [d[0] for d in result.description]
    got_types = dict(df.dtypes)
    if sorted(want_names) != sorted(df.columns):
        return [f"columns {sorted(set(want_names) ^ set(df.columns))}"]
    for c, t in got_types.items():
        if TYPES.get(t, t) != described[c]:
            problems.append(f"type of {c}: {t} / {described[c]}")
    names = sorted(want_names)
    want = Counter(tuple(_cell(row[want_names.index(c)]) for c in names) for row in result.fetchall())
    got = Counter(tuple(_cell(r[c]) for c in names) for r in df.collect())
    if sum(want.values()) != sum(got.values()):
        problems.append(f"rows {sum(got.values())} / {sum(want.values())}")
    if want != got:
        extra, missing = got - want, want - got
        problems.append(f"{sum(extra.values())} rows differ {names}: {list(extra)[:2]} / {list(missing)[:2]}")
    if not want:
        problems.append("empty result")
    return problems
