"""Releases: seen as a whole, replaced without a gap, and removed when they are old."""

import os
from dataclasses import replace

import pytest
from helpers import rows

from tierwell.config import RunConfig
from tierwell.operators import release, storage


@pytest.fixture
def config(spark, tmp_path):
    config = RunConfig(landing=str(tmp_path), storage=str(tmp_path / "tables"), prefix=f"rel_{os.urandom(4).hex()}_")
    storage.create_schemas(spark, config, "gold", "ops")
    return config


def put(spark, config, version, **tables):
    config = replace(config, version=version)
    new = release.Release(spark, config, "gold")
    for name, values in tables.items():
        new.write(name, spark.createDataFrame([(v,) for v in values], "x int"))
    return new


def folders(config, name):
    return sorted(os.listdir(f"{config.storage}/{config.schema('gold')}/{name}"))


def test_nothing_is_seen_before_the_commit(spark, config):
    assert release.tables(spark, config, "gold") == {}
    put(spark, config, "v1", a=[1], b=[2]).commit()
    put(spark, config, "v2", a=[10], b=[20])
    assert {name: rows(df, "x") for name, df in release.tables(spark, config, "gold").items()} == {"a": [(1,)], "b": [(2,)]}
    assert rows(spark.table(config.table("gold", "a")), "x") == [(1,)]


def test_all_tables_switch_and_counts_are_taken_while_writing(spark, config):
    put(spark, config, "v1", a=[1], b=[2]).commit()
    assert put(spark, config, "v2", a=[10, 11], b=[]).commit() == {"a": 2, "b": 0}
    assert rows(spark.table(config.table("gold", "a")), "x") == [(10,), (11,)]
    assert rows(spark.table(config.table("gold", "b")), "x") == []


def test_other_columns_replace_the_view(spark, config):
    put(spark, config, "v1", a=[1]).commit()
    new = release.Release(spark, replace(config, version="v2"), "gold")
    new.write("a", spark.createDataFrame([("u", 1.5)], "y string, z double"))
    new.commit()
    assert spark.table(config.table("gold", "a")).dtypes == [("y", "string"), ("z", "double")]


def test_a_column_without_a_name_of_its_own_is_shown(spark, config):
    spark.range(3).createOrReplaceTempView("three")
    new = release.Release(spark, replace(config, version="v1"), "gold")
    new.write("a", spark.table("three").select("id", spark.table("three").groupBy().max("id").scalar()).toDF("id", "most"))
    new.write("b", spark.sql("SELECT id, id + 1, (SELECT max(id) FROM three) FROM three"))
    new.commit()
    assert rows(spark.table(config.table("gold", "a")), "id", "most") == [(0, 2), (1, 2), (2, 2)]
    assert spark.table(config.table("gold", "b")).columns[1] == "(id + 1)"


def test_a_table_published_alone_becomes_a_view(spark, config):
    storage.publish(spark.createDataFrame([(1,)], "x int"), replace(config, version="v0"), "gold", "a")
    put(spark, config, "v1", a=[5]).commit()
    assert rows(spark.table(config.table("gold", "a")), "x") == [(5,)]


def test_old_versions_go_and_what_is_being_written_stays(spark, config):
    put(spark, config, "v1", a=[1]).commit()
    put(spark, config, "failed", a=[2])
    put(spark, config, "v2", a=[3]).commit()
    put(spark, config, "v3", a=[4]).commit()
    put(spark, config, "running", a=[5])
    removed = release.keep_last(spark, config, "gold", 2)
    assert [path.rpartition("/")[2] for path in removed] == ["failed", "v1"]
    assert folders(config, "a") == ["running", "v2", "v3"]
    assert release.keep_last(spark, config, "gold", 2) == []
    with pytest.raises(ValueError, match="newest"):
        release.keep_last(spark, config, "gold", 0)
