"""Indexed searches against scans: literal texts, expressions, those without pieces, and invalid ones."""

import random

import pytest

from tastewell.operators.reports import search_listing
from tastewell.operators.search_index import needed_pieces, search_stored, store_listing

WORDS = ["red bolt", "blue ring", "Red Ring", "nut", "BOLT (x)", "été", "a.b", "100%", "İron", "aaa", ""]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(4)
    lines = [(u * 37, rng.randint(0, 9), " | ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4))) if rng.random() < 0.95 else None) for u in range(400)]
    lines += [(10**6, 1, "a very rare title (4.5★)")]
    listing = spark.createDataFrame(lines, "userId long, total long, details string")
    root = str(tmp_path_factory.mktemp("index"))
    store_listing(listing, root, rows_per_page=20)
    return listing, root


QUERIES = [
    "RED (bolt|ring)", "(red|blue) (bolt|ring)", "bol?t", "(bolt){2}", "(nut)+", "(nut)*", "a{3}", "a{2,}b?", "[rb]e?d bolt", "[a[b]]lue", "rare|nothing here", "red|x?",
    "ét", "été", "370", "^37$", "7$", ".", "", "(", "a{", "a{b", r"a\.b", r"\Qa.b\E", "(?i)NUT", "rare title", "a.b", "bolt (x)", "[^x]+", "b(o|u)(l|e)", "red bolt | nut", "I", "iron",
]


@pytest.mark.parametrize("query", QUERIES)
def test_index_equals_scan(spark, rows, stored, query):
    listing, root = stored
    for literal in (False, True):
        want = rows(search_listing(listing, query, literal).select("userId", "total", "details"))
        assert rows(search_stored(spark, root, query, literal).select("userId", "total", "details")) == want


def test_pieces():
    assert needed_pieces("abcd").pieces == {"abc", "bcd"}
    assert needed_pieces("ab(cd)?e").empty()
    assert needed_pieces("Red (bolt|ring)").all_pieces() == {"red", "ed ", "bol", "olt", "rin", "ing"}
    assert needed_pieces("x(yes|no)").empty()
    assert needed_pieces("a[b&&[c]]def").empty()


def test_few_files_are_read(spark, stored):
    _, root = stored
    every = spark.read.parquet(f"{root}/pages")
    found = search_stored(spark, root, "rare title")
    assert found.count() == 1
    assert found.select("details").first()[0].startswith("a very rare")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(page" in plan and every.select("page").distinct().count() > 15
