"""What should have landed, and what is missing.

The expected side is an array (a calendar or a code list) next to one row per area, so
neither a cross join nor a driver-side loop builds the grid.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwell.functions import scalars as S
from tierwell.operators.joins import missing_members


def calendar(first, last) -> Column:
    """All days from first to last; an empty array when last is before first."""
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return F.when(first <= last, days).otherwise(F.array().cast("array<date>"))


def area_frame(spark: SparkSession, areas, area: str = "price_area") -> DataFrame:
    return spark.createDataFrame([(name,) for name in areas], f"{area} string")


def expected_days(areas: DataFrame, days: Column, area: str = "price_area", day: str = "price_date") -> DataFrame:
    """Every (area, day) that should exist."""
    return areas.select(area, F.explode(days).alias(day))


def missing_days(present: DataFrame, areas: DataFrame, first: Column, last: Column, grace_days: int,
                 known_missing: DataFrame | None = None, area: str = "price_area",
                 day: str = "price_date") -> DataFrame:
    """Past (area, day) pairs without a file, up to ``grace_days`` before ``last``.

    Pairs in ``known_missing`` have been looked at and accepted.
    """
    wanted = calendar(first, F.date_sub(last, grace_days))
    gaps = missing_members(present, areas, [area], day, wanted)
    return gaps if known_missing is None else gaps.join(known_missing, [area, day], "left_anti")


def landing_status(expected: DataFrame, before: DataFrame, after: DataFrame, keys) -> DataFrame:
    """Per expected key: ``skipped`` (was there before), ``fetched`` (new) or ``missing``."""
    keys = list(keys)
    known = (
        before.select(*keys).withColumn("_before", F.lit(1))
        .unionByName(after.select(*keys).withColumn("_before", F.lit(0)))
        .groupBy(*keys).agg(F.max("_before").alias("_before"))
    )
    state = F.when(F.col("_before") == 1, "skipped").when(F.col("_before") == 0, "fetched").otherwise("missing")
    return expected.join(known, keys, "left").select(*keys, state.alias("status"))


def status_tally(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("days"))


def period_worklist(published: DataFrame, landed: DataFrame, first_year: int, period: str = "period") -> DataFrame:
    """Published periods of the wanted years that have no landed file yet."""
    wanted = published.where(S.year_of_period(period) >= first_year).select(period).distinct()
    return wanted.join(landed.select(period), period, "left_anti")
