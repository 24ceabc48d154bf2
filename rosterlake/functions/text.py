"""Text expressions with the NULL and number-format rules of the source dialect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined(*parts: ColumnLike) -> Column:
    """Concatenation in which NULL counts as the empty string."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def full_name(first: ColumnLike = "first_name", last: ColumnLike = "last_name") -> Column:
    return joined(first, F.lit(" "), last)


def name_or(key: ColumnLike, default: str, first: ColumnLike, last: ColumnLike) -> Column:
    """Full name, or ``default`` when the row was not found (its key is NULL).

    Testing the key and not the name matters: a concatenation is never NULL here.
    """
    return F.when(_col(key).isNull(), F.lit(default)).otherwise(full_name(first, last))


def money_text(amount: ColumnLike) -> Column:
    """Dollar text in a field of 12: sign and $ next to the digits, # on overflow.

    The format has six integer digits, no leading zero and two decimals.
    """
    value = F.round(_col(amount), 2)
    size = F.abs(value)
    digits = F.format_number(size, 2)
    digits = F.when(size < 1, F.substring(digits, 2, 3)).otherwise(digits)
    text = F.concat(F.when(value < 0, "-$").otherwise("$"), digits)
    return (
        F.when(value.isNull(), F.lit(None))
        .when(size >= 1_000_000, F.lit("#" * 12))
        .otherwise(F.lpad(text, 12, " "))
    )


def number_text(value: ColumnLike) -> Column:
    """A decimal as text without trailing zeros and without a zero before the point."""
    text = _col(value).cast("string")
    cut = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    cut = F.when(text.contains("."), cut).otherwise(text)
    return (
        F.when(cut.startswith("0."), F.substring(cut, 2, 40))
        .when(cut.startswith("-0."), F.concat(F.lit("-"), F.substring(cut, 3, 40)))
        .otherwise(cut)
    )


def indent(level: ColumnLike, width: int = 2) -> Column:
    """Blanks for a hierarchy level; level 1 is not indented."""
    return F.repeat(F.lit(" " * width), (_col(level) - 1).cast("int"))


def mask_email(email: ColumnLike) -> Column:
    """First character and the domain stay readable."""
    return F.regexp_replace(_col(email), r"^(.)[^@]*(@.*)$", "$1***$2")


def mask_phone(phone: ColumnLike) -> Column:
    """All digits but the last two become an asterisk."""
    return F.regexp_replace(_col(phone), r"[0-9](?=(?:[^0-9]*[0-9]){2})", "*")
