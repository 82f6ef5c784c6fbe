"""Grouped and conditional aggregates.

All of them are declarative hash aggregates: Spark combines per map task before
the shuffle, so hot groups reach a reducer as one partial row per map task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.functions import scalars as S


def sum_where(value, condition: Column) -> Column:
    """Sum over the rows that satisfy the condition; 0 when rows exist but none does."""
    return F.sum(F.when(condition, S.as_column(value)).otherwise(F.lit(0)))


def max_where(value, condition: Column) -> Column:
    """Narrow to wide: the value on the matching row, NULL when there is none."""
    return F.max(F.when(condition, S.as_column(value)))


def wide_by_code(df: DataFrame, keys, code: str, value: str, columns: dict) -> DataFrame:
    """One column per code, for a fixed ``{column name: code}``.

    After deduplication each (keys, code) has one row, so the maximum is that row's value;
    unlike ``first`` it does not depend on row order.  Codes are given, so no extra job
    looks for them.
    """
    cells = [max_where(value, F.col(code) == F.lit(wanted)).alias(name) for name, wanted in columns.items()]
    return df.groupBy(*keys).agg(*cells)


def daily_profile(df: DataFrame, area: str, day: str, price: str) -> DataFrame:
    """Average, minimum, maximum and number of periods per area and day, and the implied resolution."""
    stats = df.groupBy(area, day).agg(
        F.avg(price).alias("avg_sek_per_kwh"),
        F.min(price).alias("min_sek_per_kwh"),
        F.max(price).alias("max_sek_per_kwh"),
        F.count("*").cast("int").alias("period_count"),
    )
    return stats.withColumn("resolution_minutes", S.resolution_minutes("period_count"))


def grid_profile(df: DataFrame, axes: dict) -> DataFrame:
    """One row: rows present, distinct members per axis, and the rows a complete grid would have."""
    counts = df.agg(
        F.count("*").alias("row_count"),
        *[F.countDistinct(column).alias(name) for name, column in axes.items()],
    )
    expected = F.lit(1).cast("bigint")
    for name in axes:
        expected = expected * F.col(name)
    return counts.withColumn("expected_rows", expected).withColumn(
        "is_complete", F.col("row_count") == F.col("expected_rows")
    )


def coverage_profile(df: DataFrame, area: str, file: str, start: str) -> DataFrame:
    """Per area: distinct files, rows, earliest and latest period."""
    return df.groupBy(area).agg(
        F.countDistinct(file).alias("file_count"),
        F.count("*").alias("row_count"),
        F.min(start).alias("earliest"),
        F.max(start).alias("latest"),
    ).orderBy(area)


def top_by(df: DataFrame, measure: str, tie_break: str, rows: int = 25) -> DataFrame:
    """Top rows by a measure; planned as a per-partition heap, not as a global sort."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie_break)).limit(rows)
