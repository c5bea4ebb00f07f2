"""Every registered query with an equivalent in SQL, against DuckDB on the smallest tables; the others must return rows."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from quadrangle.plans import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def cell(x) -> str:
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    if isinstance(x, (int, float, np.number)):
        return f"{float(x):.5f}".replace("-0.00000", "0.00000")
    return x.strftime("%Y-%m-%d %H:%M:%S") if hasattr(x, "strftime") else str(x)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_same_with_other_partitions(spark):
    once = rows(QUERIES["dataset_student_terms"](spark, FOLDER).toPandas())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert rows(QUERIES["dataset_student_terms"](spark, FOLDER).toPandas()) == once
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
