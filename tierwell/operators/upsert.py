"""Key-based upsert: insert new keys, update rows whose values differ, keep the rest.

Keys match with ``=`` (a NULL key never matches, so the quality gate has to reject them);
values compare null-safely.  Source rows must be unique per key.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.functions import scalars as S

ACTION = "_action"
INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def _prefixed(target: DataFrame, keys, values) -> DataFrame:
    return target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values], F.lit(True).alias("_in_target"))


def _values(df: DataFrame, keys) -> list[str]:
    return [c for c in df.columns if c not in keys]


def _changed(values) -> Column:
    """FALSE when every column is part of the key."""
    return S.any_of(S.differs(F.col(c), F.col(f"_old_{c}")) for c in values)


def label_changes(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Source rows with what the upsert would do with them: inserted, updated or unchanged."""
    keys = list(keys)
    values = _values(source, keys)
    action = (
        F.when(F.col("_in_target").isNull(), INSERTED).when(_changed(values), UPDATED).otherwise(UNCHANGED)
    )
    joined = source.join(_prefixed(target, keys, values), keys, "left")
    return joined.select(*source.columns, action.alias(ACTION))


def apply_changes(target: DataFrame, changes: DataFrame, keys) -> DataFrame:
    """Target with the changed rows replaced and the new ones added.

    ``changes`` holds inserted and updated rows only.  While it is small Spark broadcasts its
    keys and the target is not shuffled.
    """
    keys, columns = list(keys), target.columns
    return target.join(changes.select(*keys), keys, "left_anti").select(*columns).unionByName(changes.select(*columns))


def merge_rows(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """The upsert in one full outer join: all rows afterwards, each with its action.

    For target and source of similar size; the jobs use ``label_changes`` and
    ``apply_changes`` instead, which leave unaffected rows where they are.
    """
    keys = list(keys)
    values = _values(source, keys)
    joined = source.withColumn("_in_source", F.lit(True)).join(_prefixed(target, keys, values), keys, "full")
    action = (
        F.when(F.col("_in_source").isNull(), KEPT)
        .when(F.col("_in_target").isNull(), INSERTED)
        .when(_changed(values), UPDATED)
        .otherwise(UNCHANGED)
    )
    taken = [F.when(F.col("_in_source"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in values]
    return joined.select(*keys, *taken, action.alias(ACTION))


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    return merge_rows(target, source, keys).select(*source.columns)


def action_counts(labelled: DataFrame) -> DataFrame:
    """Rows per action."""
    return labelled.groupBy(F.col(ACTION).alias("action")).agg(F.count("*").alias("row_count"))
