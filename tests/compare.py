"""Run a registered query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = [str(d[1]) for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(r[i] for i in order) for r in cur.fetchall())
    return [names[i] for i in order], [types[i] for i in order], rows


SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def spark_rows(df):
    names = sorted(df.columns)
    types = [SAME.get(t, t.upper()) for t in (dict(df.dtypes)[n] for n in names)]
    return names, types, Counter(tuple(r) for r in df.select(names).collect())


def differences(df, con, sql: str) -> list[str]:
    names, types, rows = spark_rows(df)
    other_names, other_types, other = sql_rows(con, sql)
    out = []
    if names != other_names:
        return [f"columns {names} against {other_names}"]
    if types != other_types:
        out.append(f"types {dict(zip(names, zip(types, other_types)))}")
    if rows != other:
        out.append(
            f"rows {rows.total()} against {other.total()}; only here {list((rows - other))[:3]}; only SQL {list((other - rows))[:3]}"
        )
    return out
