"""Quality rules as a ledger: every rule is evaluated once, policies only read its bits.

A ledger row holds the measurements of a document and one failure bit per rule. The ledger is
written; a policy is a set of rules with a version, and applying it, or asking what a rule alone
rejects, is integer arithmetic on the stored bits and never touches the texts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.llm.text import UPPER, WHITE, split_words, stored, whole_text, without

SYMBOLS = "#*$%&|<>"

#: Rules in the order of their bits; a rule never changes its place.
RULES = ["few_words", "repeated_words", "many_symbols", "duplicate_lines", "word_length", "upper_case"]
BASE_RULES = ["few_words", "repeated_words"]
#: Policies by version; a published version is never edited.
POLICIES = {1: BASE_RULES, 2: RULES}
NEWEST_POLICY = 2


def _failures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n,
        "many_symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 2 * F.col("n_dup_lines") > F.col("n_word_lines"),
        "word_length": (n > 0) & ((F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        "upper_case": 10 * F.col("n_upper") > 3 * F.col("word_chars"),
    }


def mask_of(rules: list[str]) -> int:
    return sum(1 << RULES.index(rule) for rule in rules)


def _windows(words: str) -> Column:
    """The hashes of all three-word windows, in order."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(starts, lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)))


def _placed(windows: Column) -> Column:
    """Windows with their places, ordered by hash; empty if no window occurs twice."""
    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.sort_array(F.when(repeated, placed).otherwise(F.slice(placed, 1, 0)))


def _repeated_words(placed: str) -> Column:
    """Words covered by windows that occur twice.

    Equal windows are neighbours in ``placed``, a column; the places of those, ordered, cover
    three words each less their overlap.
    """

    def twice(x: Column, i: Column) -> Column:
        return (x["h"] == F.get(placed, i - 1)["h"]) | (x["h"] == F.get(placed, i + 1)["h"])

    places = F.sort_array(F.transform(F.filter(placed, twice), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + 3 - F.greatest(a["end"] - i, F.lit(0))).alias("n")),
    )
    return covered["n"]


def ledger(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per document: its ``row`` (the columns of ``docs``, or those of ``carry``),
    measurements and failure ``bits``.

    A null text counts as empty: it has no words and fails ``few_words``. Repeated rows are
    judged one by one. Equal windows are found by a 64-bit hash within a document.
    """
    text, carried = whole_text(docs), carry or docs.columns
    bare = F.col("text")
    read = docs.select(F.struct(*[docs[name] for name in carried]).alias("row"), text.alias("text"))
    split = read.select(
        "row",
        "text",
        split_words(bare).alias("words"),
        F.filter(F.split(bare, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("lines"),
    )
    length = F.length("text")
    measured = split.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(without(bare, WHITE)).cast("bigint").alias("word_chars"),
        (length - F.length(without(bare, SYMBOLS))).cast("bigint").alias("n_symbols"),
        (length - F.length(without(bare, UPPER))).cast("bigint").alias("n_upper"),
        F.size("lines").cast("bigint").alias("n_word_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _windows("words").alias("windows"),
    )
    ordered = measured.withColumn("placed", _placed(F.col("windows"))).drop("windows")
    counted = ordered.withColumn("n_repeat_words", _repeated_words("placed")).drop("placed")
    failures = _failures()
    bits = sum((F.when(failures[rule], 1 << i).otherwise(0) for i, rule in enumerate(RULES)), F.lit(0))
    return counted.withColumn("bits", bits.cast("bigint"))


def written_ledger(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The ledger of ``docs`` as a table in the shared folder, for any number of policies."""
    return stored(ledger(docs, carry), "ledger")


def _bits(rules: list[str]) -> Column:
    """The failure bits of some rules in a ledger row."""
    return F.col("bits").bitwiseAND(F.lit(mask_of(rules)).cast("bigint"))


def failed(policy: int = NEWEST_POLICY) -> Column:
    """Whether a ledger row breaks a rule of the policy."""
    return _bits(POLICIES[policy]) != 0


def sole_rule(policy: int = NEWEST_POLICY) -> Column:
    """The rule that alone rejects a ledger row under the policy; null if none or several do."""
    alone = [F.when(_bits(POLICIES[policy]) == mask_of([rule]), F.lit(rule)) for rule in POLICIES[policy]]
    return F.coalesce(*alone)


def apply_policy(docs: DataFrame, policy: int = NEWEST_POLICY) -> DataFrame:
    """The documents that break no rule of the policy, with their columns.

    Null and empty texts have no words and go; repeated rows stay or go together. The ledger is not
    written here: its rows would carry every text once more.
    """
    # A filter on plain columns would be moved below the ledger, with all measurements written out
    # again in every rule that uses them; below a row's place it cannot go.
    judged = ledger(docs).withColumn("place", F.monotonically_increasing_id())
    return judged.filter(~failed(policy) & (F.col("place") >= 0)).select("row.*")


def ablations(judged: DataFrame, policy: int = NEWEST_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those only it rejects.

    One pass over the bits of a ledger; ``judged_rows`` is the size of the ledger.
    """
    sums = [F.count("*").alias("judged_rows")]
    for rule in POLICIES[policy]:
        sums.append(F.count_if(_bits([rule]) != 0).alias(f"{rule}_failed"))
        sums.append(F.count_if(_bits(POLICIES[policy]) == mask_of([rule])).alias(f"{rule}_alone"))
    totals = judged.agg(*sums)
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"{rule}_failed").alias("failed"), F.col(f"{rule}_alone").alias("alone"))
        for rule in POLICIES[policy]
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r"), "judged_rows").select("r.*", "judged_rows")
