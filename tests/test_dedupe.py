import random
from collections import defaultdict

from helpers import rows
from pyspark.sql import functions as F

from reliq.operators.dedupe import first_per_key, insert_ignore, mark_firsts
from reliq.operators.skew import Hot, hot_keys, is_one_of, salted_join


def test_first_per_key_follows_the_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "w")], "k string, n int, v string")
    kept = first_per_key(df, "k", [F.col("n"), F.col("v")])
    assert rows(kept) == [("a", 1, "y"), ("b", 5, "w")]


def test_insert_ignore_keeps_the_target(spark):
    target = spark.createDataFrame([("a", 1)], "k string, n int")
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, n int")
    assert rows(insert_ignore(target, incoming, "k", [F.col("n")])) == [("b", 2)]


def test_only_new_keys_enter_a_stored_table(spark, tmp_path):
    from reliq.sinks.keyed import KeyedTable

    target = KeyedTable(spark, "keyed_test", str(tmp_path / "keyed"), "k", 4)
    first = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 4)], "k string, n int")
    assert target.insert_new(first, [F.col("n")]) == 3
    second = spark.createDataFrame([("a", 9), ("b", 3), ("c", 2), ("c", 1)], "k string, n int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = target.missing(second, [F.col("n")])
        text = new._sc._jvm.PythonSQLUtils.explainString(new._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The stored side is read in its buckets: the one exchange is that of the incoming rows.
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert text.count("Exchange") == 1 and "WindowGroupLimit" in text[text.index("Exchange") :]
    assert target.insert_new(second, [F.col("n")]) == 1
    assert target.insert_new(second, [F.col("n")]) == 0
    assert rows(target.read()) == sorted([("a", 0), ("b", 1), ("c", 1), (None, 4)], key=repr)
    spark.sql("drop table keyed_test")


def copies(seed: int, n: int = 600):
    """Rows of which a third share one id, another part has no id, and many are identical."""
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        key = rng.choice(["hot"] * 4 + [None] * 2 + [f"k{rng.randrange(60)}"] * 6)
        made.append((key, rng.randrange(6), rng.choice("xy"), rng.random() < 0.5))
    return made


def by_hand(made):
    groups = defaultdict(list)
    for row in made:
        groups[row[0]].append(row)
    firsts, valid = [], []
    for key, members in groups.items():
        ordered = sorted(members, key=lambda r: (r[1], r[2], r[3]))
        firsts.append(ordered[0])
        good = [r for r in ordered if r[3]]
        valid.extend(good[:1])
    later = list(made)
    for row in firsts:
        later.remove(row)
    return sorted(firsts, key=repr), sorted(valid, key=repr), sorted(later, key=repr)


def test_mark_firsts_agrees_with_a_plain_loop_with_and_without_hot_keys(spark):
    for seed in (1, 2):
        made = copies(seed)
        firsts, valid, later = by_hand(made)
        df = spark.createDataFrame(made, "k string, n int, v string, ok boolean").repartition(7)
        df = df.withColumn("_lane", F.spark_partition_id())
        order = [F.col("n"), F.col("v"), F.col("ok")]
        for hot in (Hot(), Hot(("hot", None), 3), Hot(("hot", "k1", "k2", "absent"), 3)):
            marked = mark_firsts(df, "k", order, "ok", hot)
            assert rows(marked.filter("is_first"), "k", "n", "v", "ok") == firsts
            assert rows(marked.filter("is_first_valid"), "k", "n", "v", "ok") == valid
            assert rows(marked.filter("not is_first"), "k", "n", "v", "ok") == later


def test_hot_keys_finds_frequent_values_and_null(spark):
    made = [("a", "x")] * 50 + [(None, "x")] * 40 + [(f"k{i}", f"y{i}") for i in range(30)]
    df = spark.createDataFrame(made, "k string, j string")
    found = hot_keys(df, "k", "j", min_rows=20, fraction=1.0)
    assert set(found["k"].values) == {"a", None}
    assert found["j"].values == ("x",)
    assert found["j"].pieces == 5
    assert hot_keys(df, "k", min_rows=1000, fraction=1.0) == {}


def test_is_one_of_finds_null_and_is_never_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    found = df.select("k", is_one_of(F.col("k"), ["a", None]).alias("hit"))
    assert rows(found) == [("a", True), ("b", False), (None, True)]


def test_salted_join_equals_the_plain_join(spark):
    left = spark.createDataFrame(
        [("hot", i) for i in range(40)] + [(None, i) for i in range(20)] + [("a", 1), ("gone", 2)], "k string, n int"
    ).repartition(6)
    right = spark.createDataFrame([("hot", "H"), ("a", "A"), ("b", "B")], "k string, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = salted_join(left, right, "k", how)
        salted = salted_join(left, right, "k", how, Hot(("hot", "gone", None), 4))
        assert salted.columns == plain.columns
        assert rows(salted) == rows(plain)
