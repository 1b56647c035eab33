"""Benchmark decontamination."""

import brute
from samples import ODD, prose

from reliq.llm import contamination

ITEM = prose(40, 25)
ITEMS = [
    (1, ITEM),
    (2, "Just four Words, here"),
    (3, ""),
    (4, None),
    (5, " ".join(ITEM.split()[8:20])),
    (None, prose(41, 15)),
    (6, "the the the the the the the the the the the"),
    (7, "Solo"),
    (1, prose(42, 12)),
]
DOCS = [
    (1, f"{prose(1, 30)} {ITEM} {prose(2, 30)}"),
    (2, f"{prose(3, 30)} {' '.join(ITEM.split()[:9])} {prose(4, 30)}"),
    (3, ITEM.upper().replace(" ", " -- ")),
    (4, "it was just four; words here and JUST FOUR WORDS HERE again"),
    (5, "the " * 30),
    (6, f"{ITEM} {ITEM}"),
    (7, f"{ITEM} {ITEM}"),
    (8, f"solo {prose(41, 15)}"),
    (9, "the the the"),
    (10, prose(42, 12) + " solo"),
]


def judged(docs, items):
    return sorted(
        (str(r["row"]["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in contamination.contamination(docs, items).collect()
    )


def expected(rows):
    return sorted((str(row[0]), *brute.contamination(row[1], ITEMS)) for row in rows)


def items_of(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_matches_equal_brute_force(spark, make):
    rows = [*DOCS, *ODD]
    assert judged(make(rows), items_of(spark)) == expected(rows)


def test_the_way_without_broadcasts_gives_the_same(spark, make, monkeypatch):
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    assert judged(make(DOCS), items_of(spark)) == expected(DOCS)


def test_empty_tables_and_clashing_names(spark, make, empty, clashing):
    assert contamination.contamination(empty, items_of(spark)).collect() == []
    assert {r["n_hit"] for r in contamination.contamination(make(DOCS), items_of(spark, [])).collect()} == {0}
    assert contamination.contamination(clashing, items_of(spark)).select("row.*").columns == clashing.columns


MOVED = ITEM.split()
NEAR = [
    (20, f"{prose(5, 30)} {' '.join(reversed(MOVED[:10]))} {prose(6, 30)}"),
    (21, f"{prose(5, 30)} {' x '.join(' '.join(MOVED[i:i + 2]) for i in range(0, 10, 2))} {prose(6, 30)}"),
    (22, f"{prose(5, 30)} {' x y '.join(MOVED[:10])} {prose(6, 30)}"),
    (23, "here, words four just"),
    (24, "just four x x x x x words here just"),
    (25, "just four x x x x x x words here"),
    (26, "the the the the x the the the the the the the the"),
    (27, "the the the the the the the the the the"),
    (28, "the " * 12 + "x " * 7),
    (29, f"{' '.join(MOVED[15:25])}"),
    (30, f"{prose(41, 15).replace(' ', ' x ', 4)} solo"),
]


def test_proximity_equals_brute_force(spark, make, empty):
    rows = [*DOCS, *ODD, *NEAR]
    for slack in (0, contamination.SLACK):
        got = contamination.contamination(make(rows), items_of(spark), slack=slack).collect()
        assert sorted((str(r["row"]["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["near"]) for r in got) == sorted(
            (str(row[0]), *brute.contamination(row[1], ITEMS), brute.near_items(row[1], ITEMS, slack)) for row in rows
        )
        assert all(set(r["items"]) <= set(r["near"]) for r in got)
    for docs, items in ((empty, ITEMS), (make(DOCS), [])):
        assert not any(r["near"] for r in contamination.contamination(docs, items_of(spark, items), slack=5).collect())


def test_proximity_counts_words_that_a_window_needs_twice(spark, make):
    tests = contamination.windows(items_of(spark, [(9, "silver horses silver villages")]))
    docs = make([(1, "villages had horses and silver"), (2, "silver villages had horses and silver"), (3, "silver " * 30 + "villages")])
    assert contamination.phrase_matches(docs, tests).count() == 0
    found = contamination.proximity_matches(docs, tests, slack=6).select("h1").collect()
    assert [r[0] for r in found] == [r[0] for r in docs.filter("doc_id = 2").selectExpr("xxhash64(text)").collect()]
