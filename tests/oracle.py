"""Compare a query with its SQL in DuckDB."""

import math
import os

import duckdb


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def assert_same(spark, folder, query, sql):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    df = query(spark, folder)
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want, got = _rows(found.fetchall(), columns), _rows(df.collect(), df.columns)
    assert len(want) == len(got)
    assert want == got
