"""Upsert semantics and stored merges."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tierwell.config import RunConfig
from tierwell.operators import storage, upsert as U

SCHEMA = "k string, y int, v int"


@pytest.fixture
def sides(spark):
    target = [("same", 1, None), ("set", 1, None), ("one", 1, 1), ("cleared", 1, 4), ("kept", 1, 9)]
    source = [("same", 1, None), ("set", 1, 1), ("one", 1, 1), ("cleared", 1, None), ("new", 2, 5)]
    target, source = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    return target, source


AFTER = sorted(
    [("same", 1, None), ("set", 1, 1), ("one", 1, 1), ("cleared", 1, None), ("kept", 1, 9), ("new", 2, 5)], key=repr)


def test_actions(sides):
    assert rows(U.action_counts(U.merge_rows(*sides, ["k", "y"]))) == [
        ("inserted", 1), ("kept", 1), ("unchanged", 2), ("updated", 2)]
    assert rows(U.label_changes(*sides, ["k", "y"]), "k", U.ACTION) == [
        ("cleared", "updated"), ("new", "inserted"), ("one", "unchanged"), ("same", "unchanged"), ("set", "updated")]


def test_both_ways_give_the_same_rows(sides):
    target, source = sides
    keys = ["k", "y"]
    assert rows(U.upsert(target, source, keys)) == AFTER
    changes = U.label_changes(target, source, keys).where(F.col(U.ACTION) != U.UNCHANGED).drop(U.ACTION)
    assert rows(U.apply_changes(target, changes, keys)) == AFTER


def test_twice_is_once(sides):
    target, source = sides
    once = U.upsert(target, source, ["k", "y"])
    assert rows(U.upsert(once, source, ["k", "y"])) == AFTER
    counts = dict(rows(U.action_counts(U.merge_rows(once, source, ["k", "y"]))))
    assert counts == {"unchanged": 5, "kept": 1}


def test_table_of_keys_only_never_updates(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(U.action_counts(U.merge_rows(df, df, ["k"]))) == [("unchanged", 2)]


def test_null_key_never_matches(spark):
    df = spark.createDataFrame([(None, 1, 1)], SCHEMA)
    assert rows(U.action_counts(U.merge_rows(df, df, ["k", "y"]))) == [("inserted", 1), ("kept", 1)]


def config(tmp_path):
    return RunConfig(landing="", storage=str(tmp_path), prefix=f"m{abs(hash(str(tmp_path)))}_")


@pytest.mark.parametrize("stored_by", [None, "y"])
def test_stored_merge(spark, sides, tmp_path, stored_by):
    target, source = sides
    first = config(tmp_path)
    storage.create_schemas(spark, first, "silver")
    name = first.table("silver", "t")
    assert storage.merge(target, first, "silver", "t", ["k", "y"], stored_by) == storage.MergeResult(5, 0, 0, 5)
    assert rows(spark.table(name), "k", "y", "v") == rows(target)
    merged = storage.merge(source, config(tmp_path), "silver", "t", ["k", "y"], stored_by)
    assert merged == storage.MergeResult(1, 2, 2, 6)
    assert rows(spark.table(name), "k", "y", "v") == AFTER
    files = spark.table(name).inputFiles()
    merged = storage.merge(source, config(tmp_path), "silver", "t", ["k", "y"], stored_by)
    assert merged == storage.MergeResult(0, 0, 5, 6)
    assert spark.table(name).inputFiles() == files


def test_only_changed_partitions_are_read_and_written(spark, tmp_path):
    c = config(tmp_path)
    storage.create_schemas(spark, c, "silver")
    target = spark.range(40).selectExpr("cast(id as string) as k", "cast(id % 4 as int) as y", "0 as v")
    storage.merge(target, c, "silver", "p", ["k", "y"], "y")
    table = c.table("silver", "p")
    before = set(spark.table(table).inputFiles())
    changed = target.withColumn("v", F.when(F.col("k") == "6", 1).otherwise(0))
    storage.merge(changed, config(tmp_path), "silver", "p", ["k", "y"], "y")
    gone = before - set(spark.table(table).inputFiles())
    assert gone and all("/y=2/" in name for name in gone)
    assert rows(spark.table(table).where("v = 1"), "k") == [("6",)]
    assert spark.table(table).count() == 40


def test_partition_column_has_to_be_part_of_the_key(spark, sides, tmp_path):
    target, source = sides
    c = config(tmp_path)
    storage.create_schemas(spark, c, "silver")
    storage.merge(target, c, "silver", "w", ["k"], "y")
    with pytest.raises(ValueError, match="not part of its key"):
        storage.merge(source, config(tmp_path), "silver", "w", ["k"], "y")


def test_partitioned_table_can_be_published_again(spark, sides, tmp_path):
    target, source = sides
    c = config(tmp_path)
    storage.create_schemas(spark, c, "gold")
    storage.publish(target, c, "gold", "again", "y")
    assert storage.publish(source, config(tmp_path), "gold", "again", "y") == 5
    assert rows(spark.table(c.table("gold", "again")), "k", "y", "v") == rows(source)


def test_changed_columns_replace_the_table(spark, sides, tmp_path):
    target, _ = sides
    c = config(tmp_path)
    storage.create_schemas(spark, c, "gold")
    storage.publish(target, c, "gold", "t")
    assert storage.publish(target.withColumn("w", F.lit("x")), config(tmp_path), "gold", "t") == 5
    assert spark.table(c.table("gold", "t")).columns == ["k", "y", "v", "w"]
