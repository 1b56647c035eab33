"""The conversation trie against plain Python, with small components so that cuts are made."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reliq.llm import ranks, text, trie

TURNS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, words in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", words or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    return made


def brute(rows):
    made = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    want = {}
    for node in sorted(members, key=len, reverse=True):
        below = [want[child] for child in children[node]]
        n, ends = len(members[node]), [c for c in members[node] if made[c] == node]
        want[node] = (
            members[node][0],
            len(node),
            members[node[:-1]][0] if node else None,
            n,
            len(below),
            sum(b[5] for b in below) or 1,
            sum(b[6] for b in below) + ((n - 1) * len(node[-1][1].encode()) if node else 0),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(want.values(), key=str)


def talks(seed, convs, longest, words):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]) if words > 2 else "user", f"turn é {rng.randrange(words)}")
        for c in range(convs)
        for t in range(rng.randrange(1, longest))
    ]


CASES = {
    "bushy": talks(1, 60, 9, 3),
    "shared": talks(2, 80, 14, 1),
    "long": [(c, t, "user", "same" if t < 40 + c else f"own {c}") for c in (0, 3, 5, 10) for t in range(60 + c)],
    "odd": [
        (7, 1, None, None), (7, None, "user", "null turn first"), (7, None, "user", "null turn first"), (7, 2, "user", ""),
        (None, 1, "user", "of no conversation"), (-3, 1, "user", "negative"), (-5, 1, "user", "base"), (11, 1, "user", "short"),
        (12, 5, "user", "x" * 100_000), (12, 4, "user", "ü"), (13, 4, "a", "bc"), (14, 4, "ab", "c"),
    ],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("most", [1, 6, trie.COMPONENT])
def test_the_trie_equals_plain_python(spark, case, most):
    if case != "odd" and most == 1:
        most = 3
    rows = CASES[case]
    if case == "odd":
        # Python rounds towards minus infinity, SQL towards zero; the query does as SQL does.
        rows = [row for row in rows if row[0] != -3]
    got = trie.prefix_trie(spark.createDataFrame(rows, TURNS), most)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_no_conversations_have_no_nodes(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_columns_with_names_of_the_operator_are_left_alone(spark):
    rows = CASES["bushy"][:40]
    names = "conv depth rep place size part seq h1 h2 n_bytes top_rep total salt h".split()
    plain = spark.createDataFrame(rows, TURNS)
    clashing = plain.selectExpr("*", *[f"'x' as {name}" for name in names])
    assert sorted(map(tuple, trie.prefix_trie(clashing).collect()), key=str) == brute(rows)


def test_sums_by_centroids_equal_plain_sums():
    rng = random.Random(4)
    for n in (1, 2, 50, 400):
        for reach in (1, 3, n):
            parents = [-1, *[rng.randrange(max(0, i - reach), i) for i in range(1, n)]]
            values = [[rng.randrange(9) for _ in range(n)] for _ in range(2)]
            sums = [[0] * n, [5] * n]
            trie.subtree_sums(parents, values, sums)
            want = [list(column) for column in values]
            for column in want:
                for v in range(n - 1, 0, -1):
                    column[parents[v]] += column[v]
            assert sums == [want[0], [x + 5 for x in want[1]]]


def test_ranks_do_not_depend_on_where_ranges_end(spark):
    rows = [("hot", i % 7, i) for i in range(500)] + [(f"g{i % 3}", i, i) for i in range(40)]
    kept = text.stored(spark.createDataFrame(rows, "g string, x long, y long").repartition(5), "rank-test")
    got = ranks.ranked(kept, "g", ["x", "y"], "rank-sorted").select("g", "x", "y", "place", "size", "part").collect()
    assert len({r["part"] for r in got if r["g"] == "hot"}) > 1
    for group in {"hot", "g0", "g1", "g2"}:
        want = sorted((x, y) for g, x, y in rows if g == group)
        assert sorted((r["place"], (r["x"], r["y"]), r["size"]) for r in got if r["g"] == group) == [
            (i, row, len(want)) for i, row in enumerate(want)
        ]
