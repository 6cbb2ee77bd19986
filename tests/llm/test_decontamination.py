"""Hits against a scan of all windows."""

import re

import pytest

from tastewell.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "the quick brown fox jumps over the lazy dog near a quiet river bank today"
ITEMS = [(1, PASSAGE), (10, "Short ITEM, here"), (2, PASSAGE + " again"), (3, None), (4, ""), (5, "ÉTÉ été"), (6, "the the the the the the the the the the the"), (None, PASSAGE), (7, "?!")]
DOCS = [
    (1, f"before {PASSAGE.upper()} after"),
    (2, "a short item here and a short-item here"),
    (3, PASSAGE[: len(PASSAGE) // 2]),
    (4, None),
    (5, ""),
    (6, "the " * 25),
    (7, f"x {PASSAGE} y {PASSAGE} again z"),
    (7, f"x {PASSAGE} y {PASSAGE} again z"),
    (8, "ÉTÉ été. été ÉTÉ"),
    (None, PASSAGE.replace(" ", "--")),
    (9, "clean words " * 2000),
    (10, "... !!! ..."),
    (11, "ten: the quick brown fox jumps over the lazy dog near"),
]


def _words(text):
    return WORD.findall((text or "").encode().lower().decode())


def _expected(text):
    words, hit, items = _words(text), set(), set()
    for item, item_text in ITEMS:
        own = _words(item_text)
        for s in range(max(1, len(own) - 9)) if own else ():
            window = own[s : s + 10]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit |= set(range(p, p + len(window)))
                    if item is not None:
                        items.add(str(item))
    return len(words), len(hit), sorted(items)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_contamination(spark, broadcast_rows):
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in DOCS], "doc_id long, text string, row int, words string").repartition(3)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, window int")
    got = decontamination.contamination(docs, items, broadcast_rows=broadcast_rows).collect()
    found = sorted((str(r["row"]["id"]), r["n_words"], r["n_hit"], r["item_list"], r["n_items"], r["contaminated"]) for r in got)
    expected = []
    for i, t in DOCS:
        n, hit, ids = _expected(t)
        expected.append((str(i), n, hit, ids, len(ids), hit > 0))
    assert found == sorted(expected)


def test_kept_rows(spark):
    names = "doc_id long, text string, row int, __row int, __key int, __doc int, `a.b` int"
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in DOCS], names)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontamination.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, t in DOCS if not _expected(t)[1])
    assert decontamination.decontaminated(docs.limit(0), items).collect() == []
    assert decontamination.decontaminated(docs, items.limit(0)).count() == len(DOCS)


def test_window_of_an_item_with_null_id_alone(spark):
    alone = "a passage of its own that no other item of the benchmark has in it"
    docs = spark.createDataFrame([(1, f"x {alone} y"), (2, "clean"), (None, alone)], "doc_id long, text string")
    items = spark.createDataFrame([(None, alone), (3, PASSAGE)], "item_id long, text string")
    got = decontamination.contamination(docs, items).collect()
    found = {r["row"]["id"]: (r["n_words"], r["n_hit"], r["n_items"], r["item_list"], r["contaminated"]) for r in got}
    assert found == {1: (17, 15, 0, [], True), 2: (1, 0, 0, [], False), None: (15, 15, 0, [], True)}
    assert [r["doc_id"] for r in decontamination.decontaminated(docs, items).collect()] == [2]
