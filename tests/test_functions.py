import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reliq.functions.casts import as_date, coerced_number, exact_amount, money, required
from reliq.functions.dates import padded_day_name, padded_month_name, seconds_between, weekday_from_sunday
from reliq.functions.numbers import four_digits, guarded_rate, mean_money, millionth, rate


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column).head()[0]


def test_money_rounds_halves_away_from_zero(spark):
    assert one(spark, money(exact_amount(F.lit("2.005")))) == Decimal("2.01")
    assert one(spark, money(exact_amount(F.lit(" -2.005 ")))) == Decimal("-2.01")
    assert one(spark, money(exact_amount(F.lit("0.004")))) == Decimal("0.00")


def test_strict_cast_raises_and_lenient_cast_gives_null(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, exact_amount(F.lit("abc")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, as_date(F.lit("2024-13-01")))
    assert one(spark, exact_amount(F.lit("abc"), strict=False)) is None
    assert one(spark, as_date(F.lit("soon"), strict=False)) is None


def test_coerced_number(spark):
    assert one(spark, coerced_number(F.lit("12.5"))) == 12.5
    assert one(spark, coerced_number(F.lit("n/a"))) is None
    assert one(spark, coerced_number(F.lit("NaN"))) is None


def test_required_raises_on_null(spark):
    with pytest.raises(Exception, match="required column status"):
        one(spark, required(F.lit(None).cast("string"), "status"))
    assert one(spark, required(F.lit("x"), "status")) == "x"


def test_calendar_names_are_padded_and_weeks_start_on_sunday(spark):
    sunday = F.lit("2024-09-01").cast("date")
    assert one(spark, weekday_from_sunday(sunday)) == 0
    assert one(spark, weekday_from_sunday(F.date_add(sunday, 6))) == 6
    assert one(spark, padded_day_name(sunday)) == "Sunday   "
    assert one(spark, padded_month_name(sunday)) == "September"
    assert one(spark, padded_month_name(F.lit("2024-05-01").cast("date"))) == "May      "


def test_seconds_between(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    end = start + dt.timedelta(seconds=19, microseconds=183854)
    assert one(spark, seconds_between(F.lit(start), F.lit(end))) == Decimal("19.18")


def test_rates_and_means(spark):
    assert one(spark, rate(F.lit(2), F.lit(3))) == Decimal("0.6667")
    assert one(spark, rate(F.lit(2), F.lit(0))) is None
    total = F.lit(Decimal("0.05")).cast("decimal(28,2)")
    assert one(spark, mean_money(total, F.lit(2))) == Decimal("0.03")
    assert one(spark, guarded_rate(F.lit(5), F.lit(0))) == 5.0
    assert one(spark, four_digits(F.lit(1234.56789))) == "1234.5679"
    assert one(spark, millionth(F.lit(Decimal("1234567.89")))) == Decimal("1.23456789")
