import random
from collections import Counter
from decimal import Decimal

import pytest
from helpers import accounts_frame, landed, rows, transaction

from reliq.operators import quarantine, staging
from reliq.operators.skew import Hot

LOADED_AND_REASON = ("transaction_id", "merchant", "outcome")


def classify(spark, made, accounts=("a1",), **options):
    raw = landed(spark, "transactions", made)
    return quarantine.classify_transactions(raw, accounts_frame(spark, *accounts), **options)


def test_overlap_of_loaded_and_duplicate(spark):
    made = [
        transaction(amount="-5", merchant="first", arrival=0),
        transaction(amount="7", merchant="second", arrival=1),
    ]
    assert rows(classify(spark, made), *LOADED_AND_REASON) == [
        ("t1", "first", "negative_amount"),
        ("t1", "second", "duplicate_transaction_id"),
        ("t1", "second", "loaded"),
    ]


def test_a_row_can_have_three_reasons(spark):
    made = [transaction(merchant="m1"), transaction(account="gone", amount="0", merchant="m2", arrival=1)]
    assert rows(classify(spark, made).filter("merchant = 'm2'"), "outcome") == [
        ("duplicate_transaction_id",),
        ("negative_amount",),
        ("orphan_account",),
    ]


def test_sub_cent_amount_is_neither_fact_nor_reject_but_takes_its_slot(spark):
    made = [transaction(amount="0.004", arrival=0), transaction(amount="9", arrival=1)]
    classified = classify(spark, made)
    staged = quarantine.loaded_rows(classified)
    assert rows(staged, "amount") == [(Decimal("0.00"),)]
    assert staging.stg_transactions(staged).count() == 0
    assert rows(quarantine.rejected_rows(classified), "amount", "reject_reason") == [
        ("9", "duplicate_transaction_id")
    ]


def test_zero_null_and_orphan_rows(spark):
    made = [
        transaction(id="zero", amount="0"),
        transaction(id="no-amount", amount=None),
        transaction(id=None, merchant="m1", arrival=0),
        transaction(id=None, merchant="m2", arrival=1),
        transaction(id="no-account", account=None),
    ]
    assert rows(classify(spark, made), *LOADED_AND_REASON) == [
        ("no-account", "shop", "orphan_account"),
        ("zero", "shop", "negative_amount"),
        (None, "m2", "duplicate_transaction_id"),
    ]
    tagged = classify(spark, made, tag_missing=True)
    assert ("no-amount", "shop", "missing_amount") in rows(tagged, *LOADED_AND_REASON)
    assert (None, "m1", "missing_transaction_id") in rows(tagged, *LOADED_AND_REASON)


def test_malformed_values_abort_a_strict_load_and_are_tagged_in_a_lenient_one(spark):
    made = [transaction(id="bad", amount="abc"), transaction(id="late", date="soon"), transaction()]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        classify(spark, made).collect()
    lenient = classify(spark, made, strict=False)
    assert rows(lenient, "transaction_id", "outcome") == [
        ("bad", "malformed_amount"),
        ("late", "malformed_date"),
        ("t1", "loaded"),
    ]
    staged = staging.stage_transactions(
        landed(spark, "transactions", made), accounts_frame(spark, "a1"), strict=False
    )
    assert rows(staged, "transaction_id") == [("t1",)]


def test_a_strict_load_refuses_missing_required_values(spark):
    staged = staging.stage_transactions(
        landed(spark, "transactions", [transaction(status=None)]), accounts_frame(spark, "a1")
    )
    with pytest.raises(Exception, match="required column status"):
        staged.collect()


def test_rejected_customers_cascade_to_orphans(spark):
    customers = staging.stage_customers(
        landed(
            spark,
            "customers",
            [("c1", "Ann", "a@x", "EE", "2024-01-01"), ("c2", None, "b@x", "LV", "2024-01-01"), ("", "Eve", "", "", "2024-01-01")],
        )
    )
    assert rows(customers, "customer_id") == [("c1",)]
    accounts = staging.stage_accounts(
        landed(
            spark,
            "accounts",
            [("a1", "c1", "checking", "EUR", "2024-01-02"), ("a2", "c2", "savings", "EUR", "2024-01-02"), (None, "c1", "x", "EUR", "2024-01-02")],
        ),
        customers,
    )
    assert rows(accounts, "account_id") == [("a1",)]
    raw = landed(spark, "transactions", [transaction(), transaction(id="t2", account="a2")])
    assert rows(quarantine.quarantine_transactions(raw, accounts), "transaction_id", "reject_reason") == [
        ("t2", "orphan_account")
    ]


def random_transactions(seed: int, n: int = 500) -> list[tuple]:
    rng = random.Random(seed)
    return [
        transaction(
            id=rng.choice(["hot"] * 3 + [None] + [f"t{rng.randrange(80)}"] * 5),
            account=rng.choice(["a1", "a2", "gone", "gone", None]),
            amount=rng.choice(["-1.5", "0", "0.004", "3.10", "3.1", "12", None]),
            merchant=rng.choice(["m1", "m2"]),
            arrival=rng.randrange(3),
        )
        for _ in range(n)
    ]


def outcomes_by_hand(made: list[tuple], accounts: set[str]) -> Counter:
    def null_first(value):
        return (value is not None, value)

    def order(row):
        amount = None if row[3] is None else Decimal(row[3])
        return (row[7], null_first(row[1]), row[2], null_first(amount), row[4], row[5], row[6], null_first(row[3]))

    found, seen, taken = Counter(), set(), set()
    for row in sorted(made, key=order):
        id, account, amount = row[0], row[1], None if row[3] is None else Decimal(row[3])
        if amount is not None and amount <= 0:
            found[row[:7], "negative_amount"] += 1
        if account not in accounts:
            found[row[:7], "orphan_account"] += 1
        if id in seen:
            found[row[:7], "duplicate_transaction_id"] += 1
        seen.add(id)
        if id is not None and amount is not None and amount > 0 and account in accounts and id not in taken:
            taken.add(id)
            found[row[:7], "loaded"] += 1
    return found


@pytest.mark.parametrize(
    "hot", [{}, {"transaction_id": Hot(("hot", None), 3), "account_id": Hot(("gone", "a1", None), 4)}]
)
def test_classifier_agrees_with_a_plain_loop(spark, hot):
    made = random_transactions(7)
    raw = landed(spark, "transactions", made).repartition(6)
    accounts = accounts_frame(spark, "a1", "a2", "a3")
    classified = quarantine.classify_transactions(raw, accounts, hot=hot)
    got = Counter((tuple(r)[:7], r["outcome"]) for r in classified.collect())
    assert got == outcomes_by_hand(made, {"a1", "a2", "a3"})


def test_branches_counts_and_staging_agree_with_the_classifier(spark):
    made = random_transactions(8)
    raw, accounts = landed(spark, "transactions", made), accounts_frame(spark, "a1", "a2")
    classified = quarantine.classify_transactions(raw, accounts)
    rejected = quarantine.rejected_rows(classified)
    branches = (
        quarantine.negative_amounts(raw)
        .unionByName(quarantine.orphan_transactions(raw, accounts))
        .unionByName(quarantine.duplicate_transactions(raw))
    )
    assert rows(branches) == rows(rejected)
    assert rows(quarantine.count_by_reason(raw, accounts)) == rows(rejected.groupBy("reject_reason").count())
    assert rows(staging.stage_transactions(raw, accounts)) == rows(quarantine.loaded_rows(classified))
    carried = staging.stage_transactions(raw, accounts, carry=["customer_country"])
    assert rows(carried.drop("customer_country")) == rows(quarantine.loaded_rows(classified))


def test_an_empty_input_is_empty(spark):
    raw, accounts = landed(spark, "transactions", []), accounts_frame(spark, "a1")
    assert quarantine.classify_transactions(raw, accounts).count() == 0
    assert quarantine.count_by_reason(raw, accounts).count() == 0
