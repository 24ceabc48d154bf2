"""Text, date and money expressions with worked values."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterlake.functions import dates, money, text


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("_")])
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    "amount, want",
    [
        ("24000", "  $24,000.00"),
        ("-24000.5", " -$24,000.50"),
        ("0", "        $.00"),
        ("0.5", "        $.50"),
        ("-0.25", "       -$.25"),
        ("999999.994", " $999,999.99"),
        ("999999.995", "############"),
        ("-1000000", "############"),
        (None, None),
    ],
)
def test_money_text(spark, amount, want):
    value = F.lit(amount).cast("decimal(12,3)")
    assert spark.range(1).select(text.money_text(value)).first()[0] == want


@pytest.mark.parametrize(
    "value, want",
    [("95000.00", "95000"), ("12.50", "12.5"), ("0.50", ".5"), ("-0.50", "-.5"), ("0.00", "0"),
     ("100", "100"), ("57.89", "57.89"), ("-3.00", "-3")],
)
def test_number_text(spark, value, want):
    decimal = F.lit(Decimal(value))
    assert spark.range(1).select(text.number_text(decimal)).first()[0] == want


def test_joined_treats_null_as_empty(spark):
    got = spark.range(1).select(text.joined(F.lit(None), F.lit("-"), F.lit(5), F.lit(None))).first()[0]
    assert got == "-5"


def test_masks_and_indent(spark):
    row = spark.range(1).select(
        text.mask_email(F.lit("jane.smith@example.com")), text.mask_phone(F.lit("555-0102")),
        text.indent(F.lit(1)), text.indent(F.lit(3)),
    ).first()
    assert list(row) == ["j***@example.com", "***-**02", "", "    "]


@pytest.mark.parametrize(
    "start, months, want",
    [
        (date(2024, 1, 31), 1, date(2024, 2, 29)),
        (date(2024, 2, 29), 1, date(2024, 3, 31)),
        (date(2023, 2, 28), -12, date(2022, 2, 28)),
        (date(2024, 3, 15), -6, date(2023, 9, 15)),
        (date(2024, 8, 30), -6, date(2024, 2, 29)),
    ],
)
def test_add_months_keeps_month_end(spark, start, months, want):
    assert spark.range(1).select(dates.add_months(F.lit(start), months)).first()[0] == want


@pytest.mark.parametrize(
    "start, end, complete, borders",
    [
        (date(2020, 11, 15), date(2024, 1, 1), 37, 38),
        (date(2020, 11, 15), date(2020, 12, 15), 1, 1),
        (date(2020, 12, 31), date(2021, 1, 1), 0, 1),
        (date(2024, 1, 1), date(2020, 11, 15), -37, -38),
    ],
)
def test_months(spark, start, end, complete, borders):
    s, e = F.lit(start), F.lit(end)
    row = spark.range(1).select(dates.complete_months(s, e), dates.month_boundaries(s, e)).first()
    assert list(row) == [complete, borders]


def test_leave_length_rules(spark):
    s, e = F.lit(date(2024, 3, 5)), F.lit(date(2024, 3, 7))
    open_end = F.lit(None).cast("date")
    row = spark.range(1).select(
        dates.leave_days(s, e, False, 0), dates.leave_days(s, e, True, 1),
        dates.leave_days(s, open_end, False, 0), dates.leave_days(s, open_end, True, 1),
        dates.leave_days(s, open_end, True, 0), dates.leave_days(s, open_end, True, None),
    ).first()
    assert list(row) == [2, 3, 0, 1, 0, None]


def test_started_years(spark):
    day = date(2024, 6, 1)
    got = [
        spark.range(1).select(dates.started_years(F.lit(s), day)).first()[0]
        for s in (date(2024, 6, 1), date(2024, 5, 31), date(2023, 6, 2), date(2020, 6, 1), date(2020, 5, 31))
    ]
    # 1461 days are exactly 4 years of 365.25 days
    assert got == [0, 1, 1, 4, 5]


def test_elapsed_seconds_do_not_wrap(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 2, 5, 500000)
    assert spark.range(1).select(dates.elapsed_seconds(F.lit(a), F.lit(b))).first()[0] == 125.5


def test_two_net_formulas_differ(spark):
    amount, bonus = F.lit(Decimal("95000.00")), F.lit(Decimal("9500.00"))
    row = spark.range(1).select(
        money.net_of_total(amount, bonus), money.net_of_bonus(amount, bonus),
        money.net_of_total(amount, F.lit(None).cast("decimal(10,2)")),
        money.bonus_of(bonus, "1.5"),
    ).first()
    assert [float(v) for v in row] == [73150.0, 101650.0, 66500.0, 14250.0]


def test_ratio_and_percent_guard_zero(spark):
    row = spark.range(1).select(
        money.ratio(F.lit(1), F.lit(0)), money.percent(F.lit(Decimal("1")), F.lit(Decimal("8")), 1),
        money.ratio(F.lit(Decimal("-5")), F.lit(Decimal("8")), 2),
    ).first()
    assert row[0] is None and float(row[1]) == 12.5 and float(row[2]) == -0.63
