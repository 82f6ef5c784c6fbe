"""Column expressions shared by the operators.  All JVM-side, none raise on bad text."""

from pyspark.sql import Column, functions as F

MONTH_PERIOD = "yyyy'M'MM"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_int(text) -> Column:
    """Text to INT; malformed text becomes NULL so that a check can report the row."""
    return as_column(text).try_cast("int")


def as_double(text) -> Column:
    return as_column(text).try_cast("double")


def month_of_period(text) -> Column:
    """``2024M01`` -> 2024-01-01, NULL when the text is not a month."""
    return F.try_to_date(as_column(text), MONTH_PERIOD)


def period_of_month(day) -> Column:
    """2024-01-15 -> ``2024M01``."""
    return F.date_format(as_column(day), MONTH_PERIOD)


def year_of_period(text) -> Column:
    """The leading year of a month or year period code, NULL when it is not a number."""
    return F.substring(as_column(text), 1, 4).try_cast("int")


def local_date(timestamp_text) -> Column:
    """The calendar day as published: the first ten characters, without any zone conversion."""
    return F.try_to_date(F.substring(as_column(timestamp_text), 1, 10), "yyyy-MM-dd")


def year_end(year) -> Column:
    """31 December; NULL for a year that a date cannot hold, so that a check can report it."""
    year = as_column(year)
    return F.when(year.between(1, 9999), F.make_date(year, F.lit(12), F.lit(31)))


def month_start(day) -> Column:
    return F.trunc(as_column(day), "month")


def ratio(numerator, denominator, digits: int | None = None) -> Column:
    """Division that yields NULL for a zero or missing denominator, optionally rounded half up."""
    value = F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))
    return value if digits is None else F.round(value, digits)


def growth(current, previous, digits: int = 4) -> Column:
    return F.round(ratio(current, previous) - F.lit(1), digits)


def per_thousand(part, whole, digits: int = 1) -> Column:
    return F.round(ratio(as_column(part) * F.lit(1000), whole), digits)


def estimate_from_rate(total, per_1000) -> Column:
    """Population behind ``per_1000 = total / population * 1000``; NULL for a zero rate or one too large for INT."""
    return F.round(ratio(total, per_1000) * F.lit(1000)).try_cast("int")


def resolution_minutes(period_count) -> Column:
    """Quarter-hour days have more than 30 periods, hourly days at most 25."""
    return F.when(as_column(period_count) > 30, F.lit(15)).otherwise(F.lit(60))


def months_between_calendar(later, earlier) -> Column:
    """Whole calendar months between two dates, ignoring the day of month."""
    later, earlier = as_column(later), as_column(earlier)
    return (F.year(later) - F.year(earlier)) * F.lit(12) + F.month(later) - F.month(earlier)


def years_between_calendar(later, year) -> Column:
    return F.year(as_column(later)) - as_column(year)


def at_grain(code, length: int, retired=()) -> Column:
    """Aggregate rows share the code column with detail rows; the code length tells them apart."""
    code = as_column(code)
    keep = F.length(code) == F.lit(length)
    return keep & ~code.isin(*retired) if retired else keep


def differs(left, right) -> Column:
    """Null-safe inequality: two NULLs are equal, NULL and a value are not."""
    return ~left.eqNullSafe(right)


def any_of(conditions) -> Column:
    """OR over a list; FALSE when the list is empty."""
    combined = F.lit(False)
    for condition in conditions:
        combined = combined | condition
    return combined


def product(sizes) -> Column:
    """Product of an integer array, as BIGINT."""
    return F.aggregate(as_column(sizes), F.lit(1).cast("bigint"), lambda total, size: total * size)
