"""Compares a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def sql_rows(sql: str, folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return names, types, cursor.fetchall()


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
             "double": "DOUBLE"}


def assert_same(df, sql: str, folder: str):
    names, types, expected = sql_rows(sql, folder)
    assert sorted(df.columns) == sorted(names)
    for field in df.schema:
        assert SAME_TYPE[field.dataType.simpleString()] == types[field.name], field
    got = ordered(df.columns, [tuple(row) for row in df.collect()])
    want = ordered(names, expected)
    assert sum(got.values()) == sum(want.values())
    missing, extra = want - got, got - want
    assert not missing and not extra, (list(missing)[:3], list(extra)[:3])
    return sum(got.values())
