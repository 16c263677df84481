"""Measures and date arithmetic used by the marts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_sum(amount: str, status: str, statuses: list[str]) -> Column:
    """Sum of `amount` over rows whose status is listed; other rows add zero."""
    return F.sum(F.when(F.col(status).isin(statuses), F.col(amount)).otherwise(F.lit(0)))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def divide_exact(numerator: Column, denominator: Column, precision: int = 17) -> Column:
    """Decimal quotient with nine fractional digits, NULL on zero.

    The operands must be decimals or integers narrow enough for Spark to keep at
    least nine fractional digits (left of the point plus 9 within 38 digits).
    """
    return F.try_divide(numerator, denominator).cast(f"decimal({precision},9)")


def share_of(amount: Column, part: Column, whole: Column) -> Column:
    """`amount * part / whole`, rounded once to nine digits; NULL when `whole` is zero.

    The operands are sums of money below 10 ** 15 of either sign. The product is
    exact, and its 27 digits left of the point leave the quotient room for nine.
    """
    product = amount.cast("decimal(17,2)") * part.cast("decimal(17,2)")
    return F.try_divide(product.cast("decimal(31,4)"), whole.cast("decimal(17,2)")).cast("decimal(38,9)")


def not_deleted(name: str = "is_deleted") -> Column:
    """True unless the flag is true: rows with an unknown flag are kept."""
    return ~F.coalesce(F.col(name), F.lit(False))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Number of month boundaries between two dates."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def utc(moment: datetime | str) -> Column:
    """A timestamp literal read as UTC whatever time zone the driver host has."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def utc_like(df: DataFrame, col: str, moment: datetime | str) -> Column:
    """The literal in the type of `df[col]`, so a comparison needs no cast and reaches the scan."""
    return utc(moment).cast(df.schema[col].dataType)


def loaded_at(as_of: datetime | None) -> Column:
    """The load time: injected for repeatable runs, the clock otherwise."""
    return F.current_timestamp() if as_of is None else utc(as_of)


def parse_utc(value: str) -> datetime:
    """ISO-8601 text to a naive UTC datetime; `Z`, an offset or none are accepted."""
    parsed = datetime.fromisoformat(value)
    if parsed.tzinfo is None:
        return parsed
    return parsed.astimezone(timezone.utc).replace(tzinfo=None)
