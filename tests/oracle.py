"""Compare a registered query with its SQL, order-insensitively and by column name."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return repr(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return repr([plain(v) for v in value])
    return repr(value)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def spark_result(df):
    names = sorted(df.columns)
    rows = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    return names, [KINDS.get(dict(df.dtypes)[n], dict(df.dtypes)[n]) for n in names], rows


def sql_result(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    return [names[i] for i in order], [kinds[names[i]] for i in order], rows


def difference(df, con, sql) -> str | None:
    names, kinds, rows = spark_result(df)
    other_names, other_kinds, other_rows = sql_result(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if kinds != other_kinds:
        return f"types {list(zip(names, kinds))} != {other_kinds}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)}"
    for ours, theirs in zip(rows, other_rows):
        if ours != theirs:
            return f"{names}: {ours} != {theirs}"[:3000]
    return None
