"""Groups against all pairs of a few fingerprints."""

import random

import numpy as np
import pytest

from tastewell.llm import simhash
from tastewell.llm.components import components


def _groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bits", [64, 40])
def test_links_connect_all_pairs_within_the_radius(spark, bits):
    rng = random.Random(bits)
    marks = set()
    for _ in range(40):
        mark = rng.getrandbits(bits)
        for _ in range(rng.randint(1, 5)):
            marks.add(mark)
            for _ in range(rng.randint(1, 4)):
                mark ^= 1 << rng.randrange(bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    edges = simhash.links(spark.createDataFrame([(m,) for m in signed], "mark long"), bits)
    got = _groups(signed, [(r["a"], r["b"]) for r in edges.collect()])
    pairs = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3]
    assert got == _groups(signed, pairs)
    assert len(pairs) > 50


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] + [(300, 300 + i) for i in range(50)]
    got = components(spark.createDataFrame(edges + edges[:5], "a long, b long")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == _groups(nodes, [(a, b) for a, b in edges if a != b])
    assert len(got) == len(nodes)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_of_documents(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(9, long), (4, long + " more"), (5, "other words here now"), (7, None), (6, ""), (None, long), (5, "other words here now"), (None, None), (8, "one")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, mark string, fingerprint int")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicate_groups(docs).collect()), key=str)
    assert got == sorted([(9, 4), (4, 4), (5, 5), (7, 6), (6, 6), (None, 4), (5, 5), (None, 6), (8, 8)], key=str)
    assert simhash.near_duplicate_groups(docs.limit(0)).collect() == []


def test_fingerprint_of_few_words():
    assert simhash.fingerprint([], 3) == 0
    import xxhash

    assert simhash.fingerprint([b"a", b"b"], 3) == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("most", [1000, 0])
def test_deduplicated(spark, most):
    rng = np.random.default_rng(3)
    base = [" ".join(f"t{rng.integers(5000)}" for _ in range(120)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(10):  # near copies: one word of 120 replaced; five shingles of 116 change
        words = base[i].split()
        words[60] = "changed"
        rows.append((100 + i, " ".join(words)))
    for i in range(10, 15):  # half of the text is new: no near copies
        rows.append((200 + i, " ".join(base[i].split()[:60] + [f"n{rng.integers(5000)}" for _ in range(60)])))
    rows += [(300, base[20].upper()), (0, base[0]), (None, base[21]), (None, "alone"), (400, None), (401, "")]
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, id string, n int")
    kept = simhash.deduplicated(docs, most=most)
    assert kept.columns == docs.columns
    expected = [*range(30), *(200 + i for i in range(10, 15)), 400]
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == expected
    assert ids.count(None) == 1
    assert simhash.deduplicated(docs.limit(0)).collect() == []


def _alike(a, b, shingle=5):
    one, two = ({tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} for w in (a.split(), b.split()))
    return len(one & two) >= 0.8 * len(one | two)


def test_deduplicated_finds_appended_cut_and_inserted_passages(spark):
    rng = np.random.default_rng(5)
    new = lambda n: [f"t{w}" for w in rng.integers(20000, size=n)]
    rows, copies = [], 0
    for i in range(90):
        words = new(int(rng.integers(100, 400)))
        part, at = len(words) // 7, int(rng.integers(len(words)))
        other = [words + new(part), words[part:], words[:at] + new(part) + words[at:]][i % 3]
        rows += [(i, " ".join(words)), (1000 + i, " ".join(other))]
        copies += _alike(*(t for _, t in rows[-2:]))
    assert copies >= 85
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.deduplicated(docs).count() == len(rows) - copies


def test_deduplicated_compares_members_of_foreign_hubs(spark):
    # Equal word sets in another order: one fingerprint for all texts, though only two and two are alike.
    rng = np.random.default_rng(6)
    words = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(40):
        order = list(rng.permutation(words))
        rows += [(i, " ".join(order)), (1000 + i, " ".join(order[3:] + order[:3]))]
        assert _alike(*(t for _, t in rows[-2:]))
    # A long passage in all texts, near copies two by two.
    shared = [f"s{i}" for i in range(160)]
    for i in range(100, 160):
        own = [f"o{w}" for w in rng.integers(10**6, size=50)]
        rows += [(i, " ".join(shared + own)), (1000 + i, " ".join(shared + [*own[:25], "changed", *own[26:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in simhash.deduplicated(docs).collect())
    assert kept == [*range(40), *range(100, 160)]


def test_the_sample_sets_the_order_of_shingles_and_not_what_is_kept(spark, monkeypatch):
    rng = np.random.default_rng(9)
    shared, rows = [f"s{i}" for i in range(60)], []
    for i in range(50):
        words = shared + [f"t{w}" for w in rng.integers(20000, size=int(rng.integers(60, 200)))]
        at, part = int(rng.integers(len(words))), int(rng.integers(2, len(words) // 5))
        rows += [(i, " ".join(words)), (1000 + i, " ".join(words[:at] + [f"n{w}" for w in rng.integers(20000, size=part)] + words[at:]))]
    group = {i: i for i, _ in rows}
    for i, (a, one) in enumerate(rows):
        for b, two in rows[i + 1 :]:
            if _alike(one, two):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    expected = sorted({g for g in group.values()})
    assert 50 < len(expected) < 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shingles = np.unique(np.concatenate([simhash._shingled(t.encode().split(), 5) for _, t in rows]))
    sampled = simhash._common_shingles
    # The order that eight sampled texts give, none, and any at all.
    orders = [sampled, lambda *_: np.zeros(0, np.uint64), lambda *_: rng.permutation(shingles)]
    monkeypatch.setattr(simhash, "SAMPLED_TEXTS", 8)
    for order in orders:
        monkeypatch.setattr(simhash, "_common_shingles", order)
        assert sorted(r["doc_id"] for r in simhash.deduplicated(docs).collect()) == expected


def test_parities_never_rule_out_texts_alike():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    for _ in range(200):
        common = rng.integers(0, 2**63, int(rng.integers(1, 900)), dtype=np.uint64)
        one, two = (np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, len(common) // 4 + 1)), dtype=np.uint64)])) for _ in range(2))
        apart = len(np.setxor1d(one, two))
        folds = np.array([simhash._folded(simhash._parities(x)) for x in (one, two)])
        assert np.bitwise_count((folds[0] ^ folds[1]).view(np.uint64)).sum() <= apart
        alike = len(np.intersect1d(one, two)) >= 0.8 * len(np.union1d(one, two)) - 1e-9
        batch = pa.RecordBatch.from_arrays(
            [pa.array([1]), pa.array([2]), pa.array([len(one)]), pa.array([len(two)]), *(pa.array([simhash._parities(x)], pa.binary()) for x in (one, two))],
            names=["a", "b", "size_a", "size_b", "parities_a", "parities_b"],
        )
        kept = list(simhash._likely(0.8)(iter([batch])))
        assert kept or not alike
