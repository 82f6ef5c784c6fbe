"""Measures over periods that end at the newest published period.

The anchors are uncorrelated scalar subqueries.  Spark evaluates each once and
uses it as a literal in the scan's filter, so a table partitioned by the date
column is pruned by it, and no join is needed to spread the anchor over the rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.operators.aggregates import sum_where

REGISTRATION_SUMS = (
    "ev_registrations_12m",
    "ev_registrations_prev_12m",
    "phev_registrations_12m",
    "total_registrations_12m",
    "electric_stock_estimate",
)


def registration_windows(facts: DataFrame, month: str, span: int = 12) -> tuple[Column, Column]:
    """(in the trailing span, in the trailing span or the one before it).

    The lower bounds are computed inside the subqueries, so a row only compares with a constant.
    """
    newest = F.max(month)
    recent_from = facts.agg(F.add_months(newest, -span)).scalar()
    both_from = facts.agg(F.add_months(newest, -2 * span)).scalar()
    return F.col(month) > recent_from, F.col(month) > both_from


def registration_sums(fuel: Column, count: Column, recent: Column, both: Column,
                      electric: str, plug_in: str) -> list[Column]:
    """Aggregates for the trailing span, the span before it and the all-time electric stock.

    One pass yields what would otherwise be two grouped scans and a join.  The trailing sums
    are NULL for a group without any row in the two spans and 0 for a group that has rows but
    none of the wanted fuel; the stock is NULL for a group that never had an electric row.
    Sums of these sums over coarser keys keep exactly that meaning.
    """
    is_electric = fuel == F.lit(electric)
    seen = F.max(F.when(both, F.lit(1))).isNotNull()

    def within(condition: Column) -> Column:
        return F.when(seen, sum_where(count, condition))

    return [
        within(is_electric & recent).alias(REGISTRATION_SUMS[0]),
        within(is_electric & both & ~recent).alias(REGISTRATION_SUMS[1]),
        within((fuel == F.lit(plug_in)) & recent).alias(REGISTRATION_SUMS[2]),
        within(recent).alias(REGISTRATION_SUMS[3]),
        F.sum(F.when(is_electric, count)).alias(REGISTRATION_SUMS[4]),
    ]


def registration_measures(facts: DataFrame, key: str, electric: str, plug_in: str, span: int = 12,
                          month: str = "registration_month", fuel: str = "fuel_type_code",
                          count: str = "registration_count") -> DataFrame:
    """Trailing and previous sums and the electric stock per key, from one scan and one shuffle.

    Rows that can contribute to none of the sums are dropped before the aggregation.
    """
    recent, both = registration_windows(facts, month, span)
    flagged = facts.select(key, fuel, count, recent.alias("_recent"), both.alias("_both"))
    useful = flagged.where(F.col("_both") | (F.col(fuel) == F.lit(electric)))
    sums = registration_sums(F.col(fuel), F.col(count), F.col("_recent"), F.col("_both"), electric, plug_in)
    return useful.groupBy(key).agg(*sums)


def add_up(df: DataFrame, key: str, columns) -> DataFrame:
    """Roll additive measures up to a coarser key."""
    return df.groupBy(key).agg(*[F.sum(name).alias(name) for name in columns])


def trailing_price(daily: DataFrame, area: str, day: str, price: str, days: int = 365,
                   after: Column | None = None) -> DataFrame:
    """Mean and sample deviation, in hundredths, over the days up to the newest day of the whole table.

    The window ends at the newest day of all areas on purpose: an area that lags behind averages
    fewer days.  Pass ``after``, the last day before the window, when it can be read from a
    cheaper source than the daily table.
    """
    after = daily.agg(F.date_sub(F.max(day), days)).scalar() if after is None else after
    window = daily.where(F.col(day) > after)
    return window.groupBy(area).agg(
        F.round(F.avg(price) * 100, 2).alias("avg_ore_per_kwh_12m"),
        F.round(F.stddev_samp(price) * 100, 2).alias("price_stddev_ore_12m"),
    )


def cumulative_stock(facts: DataFrame, key: str, electric: str, fuel: str = "fuel_type_code",
                     count: str = "registration_count") -> DataFrame:
    """All-time sum of the electric registrations per key."""
    return (
        facts.where(F.col(fuel) == F.lit(electric)).groupBy(key)
        .agg(F.sum(count).alias("electric_stock_estimate"))
    )
