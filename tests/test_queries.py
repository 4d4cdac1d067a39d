"""Every registered query against its SQL text on the benchmark tables."""

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as driver  # noqa: E402
from showcase.registry import QUERIES, SQL  # noqa: E402

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="benchmark tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = driver.queries()[name](spark, DATA)
    ours = table(found.columns, found.collect())
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = table(names, result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1]) > 0
    assert ours[1] == theirs[1]


def test_entry(spark):
    found = driver.entry(spark)
    assert found.count() == 6 and "p_value" in found.columns
