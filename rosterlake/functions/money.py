"""Pay arithmetic on decimals, and ratios that cannot divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..labels import PROCESS_RATE
from .text import ColumnLike, _col


def rate(text: str) -> Column:
    return F.lit(text).cast("decimal(5,4)")


def wide(total: ColumnLike) -> Column:
    """A total of amounts, typed so that its quotients keep 12 or more decimals.

    Sums of sums have the full 38 digits, which leaves a quotient only six decimals: too few
    to round it a second time.
    """
    return _col(total).cast("decimal(28,2)")


def ratio(numerator: ColumnLike, denominator: ColumnLike, digits: int = 2) -> Column:
    """Rounded quotient, NULL when the denominator is zero."""
    return F.round(_col(numerator) / F.nullif(_col(denominator), F.lit(0)), digits)


def percent(part: ColumnLike, whole: ColumnLike, digits: int = 2) -> Column:
    return ratio(_col(part) * 100, whole, digits)


def mean(value: ColumnLike, digits: int = 2) -> Column:
    """Rounded average as sum by count, which keeps more digits than AVG before rounding."""
    return ratio(F.sum(_col(value)), F.count(_col(value)), digits)


def deduct(gross: ColumnLike, share: str) -> tuple[Column, Column]:
    """(deductions, net) of a gross amount at a rate, both with two decimals."""
    deductions = F.round(_col(gross) * rate(share), 2)
    return deductions, _col(gross) - deductions


def net_of_total(amount: ColumnLike, bonus: ColumnLike) -> Column:
    """Net pay of salary and bonus together: the rate applies to the sum."""
    return (_col(amount) + F.coalesce(_col(bonus), F.lit(0))) * (1 - rate(PROCESS_RATE))


def net_of_bonus(amount: ColumnLike, bonus: ColumnLike) -> Column:
    """Variant in which the rate applies to the bonus only; kept apart on purpose."""
    return _col(amount) + F.coalesce(_col(bonus), F.lit(0)) * (1 - rate(PROCESS_RATE))


def bonus_of(bonus: ColumnLike, multiplier: str = "1") -> Column:
    return F.round(_col(bonus) * F.lit(multiplier).cast("decimal(9,4)"), 2)
