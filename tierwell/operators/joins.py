"""Joins of the layers.

No side is hinted as broadcast.  Every dimension here is either a table with
file statistics or an aggregate whose size adaptive execution measures, so Spark
broadcasts it while it is under ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles (with skew splitting) once it has outgrown that.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def seed_frame(spark, pairs, key: str, value: str) -> DataFrame:
    """A maintained mapping as a frame; its size is that of the literal."""
    items = sorted(pairs.items() if isinstance(pairs, dict) else pairs)
    return spark.createDataFrame([tuple(item) for item in items], f"{key} string, {value} string")


def enrich(df: DataFrame, *lookups: tuple) -> DataFrame:
    """Left joins with dimensions that are unique on their key: ``enrich(df, (counties, "county_code"))``."""
    return reduce(lambda left, lookup: left.join(lookup[0], lookup[1], "left"), lookups, df)


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that the dimension lacks.

    Distinct first: it combines on the map side, so the anti join sees each key
    once however many rows carry it.
    """
    return df.select(key).distinct().join(dimension.select(key), key, "left_anti")


def distinct_array(df: DataFrame, column: str) -> Column:
    """The distinct values of a column as one sorted array, as a scalar subquery.

    For members of a calendar or a code list.  Distinct runs as a shuffled hash aggregate first,
    so the task that gathers the array sees every value once, not once per map task.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return values.agg(F.array_sort(F.collect_list(column))).scalar()


def missing_members(present: DataFrame, expected: DataFrame, keys, member: str, wanted) -> DataFrame:
    """(keys, member) that should exist but do not.

    ``expected`` lists the keys, ``wanted`` is an array expression with the members each key
    should have (a calendar, a code list).  Expected cells are dealt out by key and member, so
    no key is gathered in one row, and meet the distinct present ones in an anti join.
    """
    keys = list(keys)
    cells = expected.select(*keys).withColumn(member, F.explode(wanted)).distinct()
    have = present.select(*keys, member).distinct()
    matches = [cells[c].eqNullSafe(have[c]) for c in (*keys, member)]
    return cells.join(have, reduce(Column.__and__, matches), "left_anti")
