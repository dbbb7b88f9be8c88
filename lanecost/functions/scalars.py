"""Small column helpers shared by every table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when values are stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends; by default only spaces go."""
    return F.trim(value, F.lit(WHITE_SPACE))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_2dp(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded half up, away from zero, to two places. Rounded
    once: the quotient is taken in whole hundredths, from whole numbers."""
    a = (part.cast("decimal(26,2)") * 100).cast("decimal(28,0)")
    b = (whole.cast("decimal(26,2)") * 100).cast("decimal(28,0)")
    doubled = (F.abs(a) * 20_000 + F.abs(b)).cast("decimal(34,0)")
    hundredths = F.call_function("div", doubled, F.nullif(F.abs(b) * 2, F.lit(0).cast("decimal(29,0)")))
    negative = (a < 0) != (b < 0)
    signed = F.when(negative, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def round_money(value: Column) -> Column:
    """Two places, half up. Only for DECIMAL input: doubles lose the half."""
    return F.round(value, 2).cast("decimal(16,2)")


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; zero when there are none."""
    return F.count(F.when(condition, F.lit(1)))


def date_of_key(key: Column) -> Column:
    """The date behind a YYYYMMDD integer, NULL if it is none."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def key_of_date(date: Column) -> Column:
    """YYYYMMDD integer of a date."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")
