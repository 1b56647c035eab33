"""The n-gram Jaccard join."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F
from samples import ODD, prose

from reliq.llm import jaccard, text
from reliq.llm.components import components


def copies():
    rng = random.Random(4)
    rows = []
    for base in range(12):
        words = prose(base, rng.choice([3, 6, 9, 14, 40, 120])).split()
        for copy in range(rng.randrange(1, 7)):
            own = list(words)
            for _ in range(rng.randrange(0, 1 + len(own) // 18)):
                own[rng.randrange(len(own))] = f"changed{base}"
            if rng.random() < 0.3:
                own += prose(base + 50, len(own) // 6).split()
            rows.append((1000 + len(rows) * 7 % 101 + 200 * base, " ".join(own)))
    return list(dict(rows).items())


def test_components_equal_brute_force(make):
    rows = [*copies(), *[(row[0], row[1]) for row in ODD[:4]]]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(make(rows)).collect()}
    want = brute.components(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 5


def test_every_boundary_between_small_and_large_finds_all_links():
    rng = random.Random(9)
    weights = np.zeros(jaccard.BUCKETS, np.int64)
    pool = np.array([rng.getrandbits(63) for _ in range(90)], np.uint64)
    weights[jaccard.bucket_of(pool[:10])] = 50
    for _ in range(400):
        a = np.sort(rng.sample(list(pool), rng.randrange(2, 60)))
        b = np.unique(np.concatenate([np.array(rng.sample(list(a), len(a) - rng.randrange(0, 1 + len(a) // 5)), np.uint64), np.array(rng.sample(list(pool), rng.randrange(0, 5)), np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 75 * (len(a) + len(b) - shared):
            continue
        for small in (2, 8, 20, 64):
            met = np.intersect1d(jaccard.signatures(a, weights, small), jaccard.signatures(b, weights, small))
            assert len(met) or np.array_equal(a, b)


def test_blocks_find_the_components_of_all_pairs():
    rng = random.Random(2)
    for _ in range(20):
        base = np.array([rng.getrandbits(40) for _ in range(80)], np.uint64)
        sets = []
        for _ in range(25):
            kept = np.array(rng.sample(list(base), rng.randrange(40, 80)), np.uint64)
            sets.append(np.unique(np.concatenate([kept, np.array([rng.getrandbits(40) for _ in range(rng.randrange(15))], np.uint64)])))

        def group(links):
            root = list(range(len(sets)))
            for a, b in links:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
            return root

        every = [
            (i, j)
            for i in range(len(sets))
            for j in range(i)
            if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - n)
        ]
        assert group(jaccard.block_links(sets)) == group(every)


def test_large_cells_are_split_into_blocks(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    words = prose(1, 60).split()
    rows = [(i, " ".join([*words[:i], f"w{i}", *words[i + 1 :]])) for i in range(2, 14)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(make(rows)).collect()}
    assert got == brute.components(rows)


def test_strays_of_a_large_cell_meet_all_its_members(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(8)
    rows = []
    for i in range(40):
        words = prose(1, 44).split()
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"w{i}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(make(rows)).collect()}
    want = brute.components(rows)
    assert got == want and 1 < len({c for _, c in want.values()}) < 30


def test_near_copies_of_one_text_are_a_row_each(make):
    """20,000 sets that all are like the smallest: no member is repeated for a block."""
    words = prose(1, 200).split()
    rows = [(i, " ".join([*words[: i % 200], f"w{i}", *words[i % 200 + 1 :]])) for i in range(20_000)]
    docs = make(rows)
    sized, heavy, ids = jaccard.sized_sets(docs)
    found = text.stored(jaccard.cells(docs, sized, heavy, 16.0, ids), "members")
    largest = found.agg({"members": "max"}).head()[0]
    assert largest > 10 * jaccard.BLOCK and ids == frozenset()
    got = text.stored(jaccard.links(docs, sized, found), "class-links")
    assert got.count() <= found.count()
    assert components(got).select("component").distinct().count() == 1


def test_sets_that_share_a_class_id_take_other_bits(make, monkeypatch):
    one, two = (np.array([k], np.uint64) for k in (1, 2))
    low, high = jaccard.both_classes(one)
    assert low != high and max(low, high) < 1 << 63
    assert jaccard.class_of(one) == low and jaccard.class_of(one, frozenset([low])) == high
    assert jaccard.class_of(two, frozenset([low])) == jaccard.class_of(two)
    # All classes by their other bits give the same links.
    docs = make([(i, f"{prose(1, 40)} w{i // 2}") for i in range(8)])
    sized, heavy, _ = jaccard.sized_sets(docs)
    ids = frozenset(r["class"] for r in sized.collect())
    moved = {c: jaccard.class_of(jaccard.shingle_set(f"{prose(1, 40)} w{k}"), ids) for k in range(4) for c in [jaccard.class_of(jaccard.shingle_set(f"{prose(1, 40)} w{k}"))]}
    sized = sized.withColumn("class", F.create_map(*[F.lit(n) for pair in moved.items() for n in pair])[F.col("class")])
    found = text.stored(jaccard.cells(docs, sized, heavy, 1.0, ids), "members")
    ends = {end for r in jaccard.links(docs, sized, found, ids).collect() for end in r}
    assert ends == set(moved.values())


def test_text_ids(spark, make):
    rows = [(5, prose(1, 50)), (3, prose(1, 50)), (9, prose(2, 50))]
    docs = make(rows).selectExpr("concat('id', doc_id) as doc_id", "text")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert got == {"id5": "id3", "id3": "id3", "id9": "id9"}


def test_rows_of_one_id_are_judged_by_their_texts(make):
    rows = [(5, prose(1, 50)), (5, prose(2, 50)), (3, prose(1, 50)), (None, prose(2, 50)), (None, prose(3, 50)), (None, prose(3, 50)), (6, None), (6, None)]
    kept = sorted(((str(r["doc_id"]), r["text"] or "") for r in jaccard.one_of_each(make(rows)).collect()))
    assert kept == sorted([("3", prose(1, 50)), ("5", prose(2, 50)), ("None", prose(3, 50)), ("6", ""), ("6", "")])


def test_components_of_a_long_path(spark):
    path = spark.range(60).selectExpr("id + 1 as a", "id as b").union(spark.createDataFrame([(100, 101), (101, 100)], "a long, b long"))
    got = {r["node"]: r["component"] for r in components(path).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(path.filter("a < 0")).collect() == []


def test_one_document_of_each_group_stays(make, empty, clashing):
    rows = [(5, prose(1, 50)), (3, prose(1, 50)), (9, prose(2, 50)), (9, prose(2, 50)), *ODD]
    kept = jaccard.one_of_each(make(rows))
    ids = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect())
    assert ids == [-1, 3, 9, 100, 101, 102, 103, 105, 106, 107]
    assert jaccard.one_of_each(empty).collect() == []
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(clashing).collect()) == [1, 2]
