from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from tallyweave.plans import catalog

DATA = "/root/testdata/sf0.001"


def canonical(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return "-"
        return f"{float(v):.9g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(tuple(plain(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = catalog.QUERIES[name](spark, DATA).toPandas()
    theirs = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
