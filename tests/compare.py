"""Queries against their SQL, and rows as sets."""

import math

import duckdb
import pytest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings doi_counts jobs job_lines sft_examples sft_tokens eval_items mix_targets".split()
ROOT = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 7)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return plain(v.item()) if hasattr(v, "item") else v


def rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(plain(x) for x in r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())


def sql_rows(sql, root=ROOT):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return sorted(rel.columns), sorted(repr(tuple(plain(r[i]) for i in order)) for r in rel.fetchall())


def check(spark, query, sql):
    import os

    if not os.path.isdir(ROOT):
        pytest.skip("no test tables")
    df = query(spark, ROOT)
    columns, expected = sql_rows(sql)
    assert sorted(df.columns) == columns
    assert rows(df) == expected
