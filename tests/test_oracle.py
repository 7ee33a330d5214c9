"""Every query against its SQL in DuckDB, over the smallest driver tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return v
    if isinstance(v, int | float):
        return round(float(v), 6)
    return str(v)[:19] if hasattr(v, "isoformat") and len(str(v)) > 10 and not str(v).endswith("00:00:00") else str(v)[:10] if hasattr(v, "isoformat") else v


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf, duck, name):
    ours = entry.queries()[name](spark, sf).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, sf, name):
    entry.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()


def test_entry(spark, sf):
    assert entry.entry(spark).columns[0] == "day"
    assert set(entry.oracle_sql()) <= set(entry.queries())
