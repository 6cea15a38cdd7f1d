"""Compare a Spark result with the same query in DuckDB, as multisets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df, con, sql: str) -> list[str]:
    expected = con.sql(sql)
    names, found = sorted(expected.columns), sorted(df.columns)
    if names != found:
        return [f"columns {found} instead of {names}"]
    types = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    }
    wanted = {n: types.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    got = dict(df.dtypes)
    problems = [f"type of {n}: {got[n]} instead of {wanted[n]}" for n in names if wanted[n] != got[n]]
    order = [expected.columns.index(n) for n in names]
    theirs = Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    ours = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if sum(ours.values()) != sum(theirs.values()):
        problems.append(f"{sum(ours.values())} rows instead of {sum(theirs.values())}")
    extra, missing = ours - theirs, theirs - ours
    if extra or missing:
        problems.append(f"unexpected {list(extra)[:2]}, missing {list(missing)[:2]} ({len(extra)} differ)")
    return problems
