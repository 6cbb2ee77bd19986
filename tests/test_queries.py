"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tastewell.plans import oracle
from tests.conftest import SF

TABLES = ["customer", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) and not math.isnan(value) else value


def _sorted(rows, columns, order):
    place = [columns.index(c) for c in order]
    return sorted([tuple(_plain(r[i]) for i in place) for r in rows], key=repr)


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_against_sql(spark, sql, name):
    df = contract.queries()[name](spark, SF)
    result = sql.sql(contract.oracle_sql()[name])
    order = sorted(df.columns)
    assert sorted(result.columns) == order
    assert _sorted(df.collect(), df.columns, order) == _sorted(result.fetchall(), list(result.columns), order)


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["userId", "rank", "movieId", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["user_history_numbered", "user_profile", "cbf_topk", "hybrid_lists"])
def test_partition_count_does_not_matter(spark, rows, name):
    query = contract.queries()[name]
    many = rows(query(spark, SF))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows(query(spark, SF)) == many
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
