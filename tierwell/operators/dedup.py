"""One row per business key.

The newest row per key is picked with ``row_number() = 1``.  Spark places a
partial group limit in front of the shuffle, so each map task forwards at most
one row per key: a key that holds a third of the table reaches the reducer as
one row per map task, not as a third of the table.
"""

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def _newest_first(df: DataFrame, keys, order) -> list:
    """Order columns first, then every other sortable column, so that ties are not left to chance."""
    rest = [
        field.name
        for field in df.schema.fields
        if field.name not in keys and field.name not in order and not isinstance(field.dataType, _UNORDERED)
    ]
    return [F.col(name).desc_nulls_last() for name in [*order, *rest]]


def keep_newest(df: DataFrame, keys, order) -> DataFrame:
    """The row per ``keys`` that is newest by ``order``; equal rows are resolved by their other values."""
    keys, order = list(keys), list(order)
    ranking = Window.partitionBy(*keys).orderBy(*_newest_first(df, keys, order))
    return df.select("*", F.row_number().over(ranking).alias("_rank")).where("_rank = 1").drop("_rank")


def deduplicate(df: DataFrame, keys, version: str = "_ingested_at") -> DataFrame:
    """Newest load per key, without the version column.  A frame that has none is returned as it is."""
    return keep_newest(df, keys, [version]).drop(version) if version in df.columns else df


def newest_labels(df: DataFrame, code: str, label: str, period: str = "Tid",
                  version: str = "_ingested_at") -> DataFrame:
    """(code, period, version, label): the label of each code's newest period, and of its newest load.

    Every cell of a load repeats its label.  The first step, a hash aggregate that combines on
    the map side, shrinks the table to codes x periods x labels before anything is sorted or
    moved; the ``max`` over a struct, which needs a sort, then runs on that small rest.  (A plain
    ``distinct`` as first step would be optimised away in front of a ``max``.)
    """
    loads = df.groupBy(
        F.col(code).alias("code"), F.col(period).alias("period"), F.col(label).alias("label")
    ).agg(F.max(version).alias("version"))
    newest = F.max(F.struct("period", "version", "label")).alias("newest")
    return loads.groupBy("code").agg(newest).select("code", "newest.*")


def merge_labels(state: DataFrame, partial: DataFrame) -> DataFrame:
    """One state out of two: the newest label per code.  The order of merges, and repeated ones, make no difference."""
    newest = F.max(F.struct("period", "version", "label")).alias("newest")
    return state.unionByName(partial).groupBy("code").agg(newest).select("code", "newest.*")


def latest_labels(df: DataFrame, code: str, label: str, period: str = "Tid",
                  version: str = "_ingested_at") -> DataFrame:
    """(code, label): the label of the newest period, and of its newest load."""
    return newest_labels(df, code, label, period, version).select("code", "label")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")
