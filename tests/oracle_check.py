"""Compare a query with its SQL oracle, row by row, types included."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type -> DuckDB types that hold the same values.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
    "date": {"DATE"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(row):
    return tuple(
        "NaN" if isinstance(v, float) and math.isnan(v) else (v.isoformat() if hasattr(v, "isoformat") else v)
        for v in row
    )


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, con, sql):
    """A list of what differs; empty if the results are equal as bags of rows."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return [f"columns {names} != {sorted(relation.columns)}"]
    found = []
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if kinds[name] not in SAME_TYPE.get(kind, {kind.upper()}):
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    ours = sorted((_plain(r) for r in df.select(*names).collect()), key=_sort_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = relation.select(quoted).fetchall()
    theirs = sorted((_plain(r) for r in theirs), key=_sort_key)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)} rows")
    if not theirs:
        found.append("no rows to compare")
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if pairs:
        a, b = pairs[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        found.append(f"{len(pairs)} rows differ, first in {cells[:4]}")
    return found
