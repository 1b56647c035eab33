"""Quality rules and line dedup."""

import brute
import pytest
from samples import ODD, prose

from reliq.llm import lines, quality

JUNK = [
    (1, "a b c " * 40),
    (2, prose(3, 70) + "\n" + "#$% " * 30),
    (3, "\n".join(["same old line here"] * 20)),
    (4, prose(5, 400)),
    (5, "LOUD WORDS " * 3 + prose(6, 60).upper()),
    (6, "a b a b a " + prose(8, 50) + " b a b"),
    (7, "x y z\nx y z\n \n \nx y z"),
]


def test_measurements_equal_brute_force(make):
    rows = [*JUNK, *ODD]
    got = quality.ledger(make(rows)).collect()
    assert len(got) == len(rows)
    for have in got:
        text = next(row[1] for row in rows if row[0] == have["row"]["doc_id"])
        want = brute.ledger(text)
        base = want.pop("base_failed")
        assert {name: have[name] for name in want} == want
        assert bool(have["bits"] & quality.mask_of(quality.BASE_RULES)) == base


def test_policies_and_ablations_read_bits_only(make):
    judged = quality.ledger(make(JUNK))
    bits = {row["row"]["doc_id"]: row["bits"] for row in judged.collect()}
    assert bits[4] == 0 and bits[2] & quality.mask_of(["many_symbols"]) and bits[5] & quality.mask_of(["upper_case"])
    assert {row["doc_id"] for row in quality.apply_policy(make(JUNK)).collect()} == {i for i, b in bits.items() if not b}
    for policy, rules in quality.POLICIES.items():
        mask = quality.mask_of(rules)
        for row in quality.ablations(judged, policy).collect():
            bit = quality.mask_of([row["rule"]])
            assert row["judged_rows"] == len(JUNK)
            assert row["failed"] == sum(bool(b & bit) for b in bits.values())
            assert row["alone"] == sum(b & mask == bit for b in bits.values())


def test_policies_and_ablations_read_the_written_ledger(make):
    judged = quality.written_ledger(make(JUNK))
    plan = quality.ablations(judged)._jdf.queryExecution().executedPlan().toString()
    # Of the ledger's columns only the bits, and none of the text.
    assert "ReadSchema: struct<bits:bigint>" in plan and "xxhash64" not in plan and "split(" not in plan
    bits = {row["row"]["doc_id"]: row["bits"] for row in judged.collect()}
    sole = {row["id"]: row["sole"] for row in judged.select(judged["row.doc_id"].alias("id"), quality.sole_rule().alias("sole")).collect()}
    assert sole == {i: quality.RULES[b.bit_length() - 1] if b and b & (b - 1) == 0 else None for i, b in bits.items()}
    for version, rules in quality.POLICIES.items():
        kept = {row["doc_id"] for row in quality.apply_policy(make(JUNK), version).collect()}
        assert kept == {i for i, b in bits.items() if not b & quality.mask_of(rules)}


def test_empty_and_clashing_tables(empty, clashing):
    assert quality.apply_policy(empty).collect() == []
    assert quality.apply_policy(clashing).columns == clashing.columns
    assert lines.drop_repeated_lines(empty).collect() == []
    kept = lines.drop_repeated_lines(clashing)
    assert sorted(row["n_dropped"] for row in kept.collect()) == [0, 0, 0]


SHARED = "  This line is in MANY documents "
LINES = [
    (1, f"own line of the first one\n{SHARED}\nshort\nshort"),
    (2, f"{SHARED.strip()}\n{SHARED}\nshort\n\n"),
    (3, f"short\n{SHARED.lower()}\t"),
    (4, "only twice in the corpus\nshort"),
    (5, "only twice in the corpus\nnineteen code point"),
    (6, "nineteen code point\nñandú ñandú ñandú ñandú"),
    (7, "nineteen code point\nÑandú ñandú ñandú ñandú\nñandú ñandú ñandú ñandú"),
    (8, "ñandú ñandú ñandú ñandú"),
]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup_equals_brute_force(make, batches):
    rows = [*LINES, *ODD]
    got = lines.drop_repeated_lines(make(rows), batches).collect()
    have = sorted((str(r["row"]["doc_id"]), r["n_lines"], r["n_dropped"], r["kept"]) for r in got)
    assert have == sorted((str(row[0]), *want) for row, want in zip(rows, brute.line_dedup(rows)))


def test_every_key_lies_in_one_run_and_later_batches_update_it(make):
    docs = make(LINES)
    spark = docs.sparkSession
    runs = lines.Runs(spark, 2)
    keys = lines.repeated_keys(docs, runs, 5)
    assert {level: len(numbers) for level, numbers in runs.levels.items() if numbers} == {0: 1, 2: 1}
    assert keys.count() == 2
    totals = {(r["h1"], r["h2"]): (r["docs"], r["top"]) for r in runs.totals().collect()}
    digest = lines.line_digest(docs, 1).collect()
    assert totals == {(r["h1"], r["h2"]): (r["docs"], r["top"]) for r in digest}
    assert sum(runs.held(run).count() for run in runs.runs()) == len(digest)
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_batches_without_their_anti_join_give_other_rows(make, monkeypatch):
    """The outcome comes from the runs: keys that enter a second run are counted there from the start."""
    rows = [(i, f"the same long line in every row\n{prose(i, 30)}") for i in range(1, 13)]
    want = [r["n_dropped"] for r in lines.drop_repeated_lines(make(rows)).orderBy("row.doc_id").collect()]
    assert want == [1] * 11 + [0]
    monkeypatch.setattr(lines.Runs, "held", lambda self, run: self.spark.table(self.table(run)).select(*lines.KEY).limit(0))
    runs = lines.Runs(make(rows).sparkSession)
    lines.repeated_keys(make(rows), runs)
    totals = runs.totals()
    assert totals.count() > totals.select(*lines.KEY).distinct().count()
    runs.drop()


def test_a_dropped_run_leaves_no_tables(make):
    docs = make(LINES)
    lines.drop_repeated_lines(docs).collect()
    assert not [t for t in docs.sparkSession.catalog.listTables() if t.name.startswith("line_runs_")]


def test_keys_beyond_the_broadcast_bound_give_the_same(make, monkeypatch):
    docs = make(LINES)
    before = sorted(lines.drop_repeated_lines(docs).select("row.doc_id", "kept").collect())
    monkeypatch.setattr(lines, "BROADCAST_KEYS", 0)
    assert sorted(lines.drop_repeated_lines(docs).select("row.doc_id", "kept").collect()) == before
