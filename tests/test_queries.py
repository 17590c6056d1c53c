"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from quayload.plans.checks import CHECKS
from quayload.spec import TableSpec
from quayload.staging import read_staged, stage_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return collections.Counter(repr([row[i] for i in order]) for row in rows)


def test_every_query_has_sql():
    assert CHECKS.keys() <= entry_points.queries().keys()
    assert CHECKS.keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("key", CHECKS)
def test_query_agrees_with_sql(spark, duck, key):
    df = entry_points.queries()[key](spark, SF_DIR)
    expected = duck.execute(entry_points.oracle_sql()[key])
    columns = [item[0] for item in expected.description]
    rows = expected.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, map(tuple, df.collect())) == normal(columns, rows)
    assert rows


@pytest.mark.parametrize("name", TABLES)
def test_every_table_survives_staging(spark, tmp_path, name):
    df = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    spec = TableSpec("given", name)
    staged = stage_table(df, spec, str(tmp_path))
    back = read_staged(spark, spec, str(tmp_path))
    assert back.schema == df.schema and staged.rows == df.count()
    assert not df.exceptAll(back).take(1) and not back.exceptAll(df).take(1)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150
    assert df.where("lat IS NOT NULL").count() > 0
    assert df.where("lat IS NULL").count() > 0
