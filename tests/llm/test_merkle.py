"""The Merkle manifest against plain Python, with superblocks of 8 and 64 leaves."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from samples import ODD

from reliq.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = [None if v is None else str(v) for v in (row[0], row[3], row[2], row[4], row[1])]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def reduce_up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = reduce_up([leaf(r) for r in groups[lang]])
    top = reduce_up([trees[lang][-1][0] for lang in langs])
    want = []
    for at, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            around = [*siblings(trees[lang], i), *siblings(top, at)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf((row[0], lower(row[1]), *row[2:])) if changed else leaf(row)
            for before, after in around:
                node = h(*before, node, *after)
            root = top[-1][0]
            proof = h(*[x for before, after in around for x in (*before, *after)])
            want.append((row[0], leaf(row), trees[lang][-1][0], root, proof, node, node == root))
    return sorted(want, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def many():
    sizes = {"en": 70, None: 1, "de": 8, "": 9, "é": 65, "fr": 64, "zz": 520, **{f"l{i:02}": 1 + i % 2 for i in range(9)}}
    return [(1000 * k + i, f"Text {i} of É {lang}", lang, None if i % 4 else "s", i) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_the_manifest_equals_plain_python(spark, make, levels):
    rows = many()
    assert rows_of(merkle.manifest(make(rows), levels)) == brute(rows)


def test_odd_rows(make):
    rows = [row if len(row) == 5 else (*row, "en", "s", len(row[1] or "")) for row in ODD]
    rows += [(1, "Twice", "en", None, None), (1, "Twice", "en", None, None), (None, None, None, None, None), (2**62 + 1, "BIG", "en", "s", 3)]
    assert rows_of(merkle.manifest(make(rows), 1)) == brute(rows)


def test_one_row_is_its_own_root(make):
    rows = [(5, "Alone", "en", "s", 5)]
    assert rows_of(merkle.manifest(make(rows))) == brute(rows)


def test_no_rows(empty):
    assert merkle.manifest(empty).collect() == []


def test_columns_with_names_of_the_operator(make):
    rows = many()[:30]
    names = "tree place size digest altered block part seq leaf root path salt key subroot".split()
    assert rows_of(merkle.manifest(make(rows).selectExpr("*", *[f"'x' as {name}" for name in names]))) == brute(rows)
