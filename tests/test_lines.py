"""Queries that need ratings, tags and means join the lines with their orders once."""

import datetime as dt

import pytest

from tastewell import fixtures as fx
from tastewell.plans import queries


@pytest.fixture
def folder(spark, tmp_path):
    orders = [(o, None if o == 9 else o % 4, dt.date(1997, 1, 1 + o % 20), None if o == 5 else ["1-URGENT", "5-LOW", "4-NOT SPECIFIED"][o % 3]) for o in range(60)]
    lines = [(o, p, 1 + (o + p) % 7, float(1 + (7 * o + 3 * p) % 50), "RNA"[(o + p) % 3]) for o in range(60) for p in range(o % 5, 12, 3)]
    parts = [(p, ["red bolt", "hot ring", "large pin"][p % 3], "LARGE") for p in range(11)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines + lines[:9], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_joined_lines_hold_the_same_ratings_and_tags(spark, rows, folder):
    lines = queries.rated_lines(spark, folder)
    assert rows(lines.drop("tag")) == rows(fx.ratings_raw(spark, folder))
    assert rows(fx.tags_of(lines)) == rows(fx.tags(spark, folder))
    als, cbf, _ = queries.surrogate_pair(lines)
    assert rows(als) == rows(queries.surrogate_als(spark, folder))
    assert rows(cbf) == rows(queries.surrogate_cbf(spark, folder))
    assert als.count() and cbf.count()


@pytest.mark.parametrize("query", ["recs_search", "recs_listing", "recs_for_user", "community_vs_predicted", "stored_recommendations", "hybrid_lists"])
def test_lines_are_joined_once(spark, folder, monkeypatch, query):
    joined = []
    join = fx._lines_with_orders
    monkeypatch.setattr(fx, "_lines_with_orders", lambda *a: joined.append(a) or join(*a))
    getattr(queries, query)(spark, folder)
    assert len(joined) == 1


def test_an_order_is_read_once_and_the_train_set_written(spark, folder, monkeypatch):
    plan = fx.rated_lines(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("Join Inner") :]
    assert "AS ts" in before and "AS word" in before
    names = []
    monkeypatch.setattr(queries, "written", lambda df, name, w=queries.written: names.append(name) or w(df, name))
    queries.hybrid_lists(spark, folder)
    assert "train" in names
