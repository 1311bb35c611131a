"""Comparison of a query with its SQL on DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of_sql(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def sorted_rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([_plain(r[k]) for k in order]) for r in rows)


def same(df, sql: str, sf_dir: str) -> None:
    columns, wanted = rows_of_sql(sql, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, wanted)
