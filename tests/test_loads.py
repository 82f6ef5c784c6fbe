"""Loads that die, what a run lists and reads, the stored label state, and checks that are counted while writing."""

import datetime
import os
import re

import pytest
from helpers import rows
from landing_files import write_price

from tierwell.config import RunConfig
from tierwell.operators import dedup, quality as Q, storage
from tierwell.operators.storage import StoredBy
from tierwell.plans import bronze, labels
from tierwell.sources import landing, manifest
from pyspark.sql import functions as F

NAME = "prices"


@pytest.fixture
def config(spark, tmp_path):
    c = RunConfig(landing=str(tmp_path / "landing"), storage=str(tmp_path / "tables"), prefix=f"loads_{abs(hash(tmp_path))}_")
    storage.create_schemas(spark, c, "bronze", "ops", "silver")
    return c


def again(c):
    return RunConfig(landing=c.landing, storage=c.storage, prefix=c.prefix)


def load(spark, c, **how):
    return bronze.load_files(
        spark, c, NAME, f"{c.landing}/elpris", 2,
        lambda spark, root, between, within: landing.read_prices(spark, root, between, within=within),
        lambda df: df.select("elomrade", "time_start", F.col("source_file").alias("_source_file")), **how)


def land(tmp_path, area, day):
    write_price(tmp_path / "landing", area, datetime.date.fromisoformat(day))


def settle(tmp_path):
    """Folders as they are a while after their last change."""
    for folder, _, _ in os.walk(tmp_path / "landing"):
        os.utime(folder, (1_700_000_000, 1_700_000_000))


def test_a_load_that_dies_at_any_point_counts_once(spark, tmp_path, config, monkeypatch):
    land(tmp_path, "SE1", "2024-01-01")
    land(tmp_path, "SE2", "2024-01-01")

    def crash(*_):
        raise KeyError("crash")

    with pytest.raises(KeyError):
        load(spark, config, between_writes=crash)
    assert manifest.complete_rows(spark, config, NAME).count() == 0
    with monkeypatch.context() as broken:
        broken.setattr(manifest.Load, "record", crash)
        with pytest.raises(KeyError):
            load(spark, again(config))
    assert manifest.complete_rows(spark, config, NAME).count() == manifest.complete_files(spark, config, NAME).count() == 0
    assert load(spark, again(config)) == 2
    assert load(spark, again(config)) == 0
    assert spark.table(config.table("bronze", NAME)).count() == 3 * 48  # what the dead loads left is there, and unseen
    assert rows(manifest.complete_rows(spark, config, NAME).groupBy("elomrade").count()) == [("SE1", 24), ("SE2", 24)]
    assert rows(manifest.recorded(spark, config, NAME), "files", "row_count") == [(2, 48)]


def test_only_changed_folders_are_listed_and_only_fresh_ones_read(spark, tmp_path, config, monkeypatch):
    for area, day in (("SE1", "2015-01-01"), ("SE1", "2024-01-01"), ("SE2", "2024-01-01"), ("SE 3", "2024-01-01")):
        land(tmp_path, area, day)
    settle(tmp_path)
    assert load(spark, config) == 4
    listed, read = [], []
    files, prices = landing.landed_files, landing.read_prices
    monkeypatch.setattr(landing, "landed_files", lambda *a, **k: listed.append(k.get("within", a[5] if len(a) > 5 else None)) or files(*a, **k))
    monkeypatch.setattr(landing, "read_prices", lambda *a, **k: read.append(k["within"]) or prices(*a, **k))
    land(tmp_path, "SE1", "2015-01-02")  # a late file of an old year
    os.utime(tmp_path / "landing" / "elpris" / "elomrade=SE1" / "ar=2015" / "2015-01-02.json", (1_600_000_000, 1_600_000_000))
    assert load(spark, again(config)) == 1
    late = ["elomrade=SE1/ar=2015"]
    # The folder whose name is written another way in paths is listed again; it can't be told apart by name.
    assert [[f for f in within if " " not in f] for within in listed] == [late, late] and read == [late]
    assert manifest.complete_rows(spark, config, NAME).count() == 5 * 24
    settle(tmp_path)
    assert load(spark, again(config)) == 0
    listed.clear()
    assert load(spark, again(config)) == 0
    assert [[f for f in within if " " not in f] for within in listed] == [[]]


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_a_price_file_is_read_once_and_its_numbers_stay_as_written(spark, tmp_path):
    folder = tmp_path / "elomrade=SE1" / "ar=2024"
    folder.mkdir(parents=True)
    periods = [f'{{"time_start": "t{i}",\n "SEK_per_kWh": {i}.50, "EUR_per_kWh": 1E2}}' for i in range(5000)]
    file = folder / "2024-01-01.json"
    file.write_text("[" + ",\n".join(periods) + "]\n")
    before = bytes_read(spark)
    found = rows(landing.read_prices(spark, str(tmp_path)), "time_start", "SEK_per_kWh", "EUR_per_kWh", "EXR")
    read = bytes_read(spark) - before
    assert found == sorted((f"t{i}", f"{i}.50", "1E2", None) for i in range(5000))
    assert read < 2 * file.stat().st_size
    # A file that is cut into several parts of the read still counts once.
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        prices = landing.read_prices(spark, str(tmp_path))
        assert prices.rdd.getNumPartitions() > 1 and prices.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_a_price_file_in_utf_16_fails_the_job(spark, tmp_path):
    folder = tmp_path / "elomrade=SE1" / "ar=2024"
    folder.mkdir(parents=True)
    (folder / "2024-01-01.json").write_bytes('[{"time_start": "t", "SEK_per_kWh": 1.50}]'.encode("utf-16"))
    with pytest.raises(Exception, match="FAILFAST"):
        landing.read_prices(spark, str(tmp_path)).collect()


def test_a_folder_that_went_is_no_longer_listed(spark, tmp_path, config):
    land(tmp_path, "SE1", "2024-01-01")
    land(tmp_path, "SE2", "2024-01-01")
    settle(tmp_path)
    root = f"{config.landing}/elpris"
    assert bronze._listing(spark, config, NAME, root, 2).count() == 2
    (tmp_path / "landing" / "elpris" / "elomrade=SE2").rename(tmp_path / "gone")
    assert rows(bronze._listing(spark, again(config), NAME, root, 2), "source_file") == [("elomrade=SE1/ar=2024/2024-01-01.json",)]
    assert bronze._listing(spark, again(config), NAME, f"{config.landing}/nothing", 2).count() == 0


def test_label_state_of_two_loads_is_the_full_build_and_reads_the_second_alone(spark, config):
    source = {"codes": labels.LabelSource("facts", "code", "label", "Tid")}
    parts = ([("a", "old", "2024"), ("b", "kept", "2024"), ("a", "older", "2023")], [("a", "new", "2024"), ("b", "past", "2022"), ("c", None, "2024")])
    for part in parts:
        one = manifest.Load(spark, config, "facts")
        one.record(0, one.write_rows(spark.createDataFrame(part, "code string, label string, Tid string"))["rows"])
        state = labels.refresh(spark, again(config), source)["codes"]
    full = dedup.latest_labels(manifest.complete_rows(spark, config, "facts"), "code", "label")
    assert rows(state) == rows(full) == [("a", "new"), ("b", "kept"), ("c", None)]
    assert manifest.not_used(spark, config, "facts", "labels_codes").count() == 0
    second = spark.createDataFrame([(one.load_id,)], "load_id string")
    partial = labels.partial_state(spark, config, source["codes"], second)
    plan = partial._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_load[^\]]*", plan)
    assert rows(partial, "code") == [("a",), ("b",), ("c",)] and rows(partial.where("code = 'b'"), "label") == [("past",)]
    # Merged again after a crash, it changes nothing.
    stored = spark.table(labels.state_table(config, "codes"))
    assert rows(dedup.merge_labels(stored, partial)) == rows(stored)


def test_row_rules_are_counted_by_the_write_and_others_once(spark, config):
    frame = spark.range(10).withColumn("v", F.when(F.col("id") > 6, F.lit(None)).otherwise(F.col("id")))
    keys = spark.range(8).withColumnRenamed("id", "k")

    def declare(t):
        return [Q.not_null("t", "v", t["t"], ["v"]), Q.row_rule("t", "small", t["t"], F.col("v") > 100),
                Q.foreign_key("t", "fk", t["t"].withColumnRenamed("id", "k"), keys, "k"), Q.expect_count("t", "ten", t["t"], 10)]

    written, checks = Q.write_checked({"t": frame}, declare, lambda name, df: storage.stage(df, config, name))
    assert [check.counted for check in checks] == [3, 0, None, None]
    log = Q.QualityChecks(spark, config.results_table, "r", "l").add(*checks)
    assert [(o.failed_rows, o.sample) for o in log.evaluate()] == [
        (3, '[{"id":7,"v":null},{"id":8,"v":null},{"id":9,"v":null}]'), (0, None), (2, '[{"k":8},{"k":9}]'), (0, None)]
    assert Q.QualityChecks(spark, config.results_table, "r", "l").evaluate() == []


def test_uniqueness_after_a_merge_is_checked_where_it_wrote(spark, config):
    month = StoredBy("month", "day", F.date_format("day", "yyyy-MM"))
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-31')) as day").withColumn("v", F.lit(1))
    first = storage.merge(days, config, "silver", "daily", ["day"], month)
    assert (first.inserted, first.total, first.written.count()) == (91, 91, 91)
    later = again(config)
    second = storage.merge(days.where("day = '2024-02-10'").withColumn("v", F.lit(2)), later, "silver", "daily", ["day"], month)
    assert second == storage.MergeResult(0, 1, 0, 91) and second.written.count() == 29
    assert all("month=2024-02" in file for file in second.written.inputFiles())
    assert storage.merge(days.limit(0), again(config), "silver", "daily", ["day"], month).written is None
    assert spark.table(config.table("silver", "daily")).where("v = 2").count() == 1
    with pytest.raises(ValueError, match="not part of its key"):
        storage.merge(days, again(config), "silver", "daily", ["day"], StoredBy("w", "v", F.col("v")))
