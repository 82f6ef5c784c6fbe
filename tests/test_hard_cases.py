"""Cases in which rows could be lost or wrong members accepted without a failing check."""

import datetime
import json
import os
import time

import pytest
from helpers import rows
from landing_files import category, document

from tierwell.config import RunConfig
from tierwell.functions import scalars as S
from tierwell.operators import storage
from tierwell.operators.joins import missing_members
from tierwell.plans import bronze
from tierwell.sources import cube, landing, manifest
from pyspark.sql import functions as F


@pytest.fixture
def stockholm(monkeypatch):
    monkeypatch.setenv("TZ", "Europe/Stockholm")
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


def test_a_file_of_the_repeated_hour_is_loaded(spark, tmp_path, stockholm):
    folder = tmp_path / "landing" / "elpris" / "elomrade=SE1" / "ar=2024"
    folder.mkdir(parents=True)
    hours = [datetime.datetime(2024, 10, 27, h, 30, tzinfo=datetime.timezone.utc) for h in (0, 1)]  # 02:30 twice
    for day, at in zip(("2024-10-01", "2024-10-02"), hours):
        file = folder / f"{day}.json"
        file.write_text(json.dumps([{"time_start": f"{day}T00:00:00+02:00", "SEK_per_kWh": 1.0}]))
        os.utime(file, (at.timestamp(), at.timestamp()))
    root = str(tmp_path / "landing" / "elpris")
    fresh = landing.landed_files(spark, root, 2)
    between = manifest.read_window(fresh)
    assert between == tuple(int(at.timestamp() * 1_000_000) for at in hours)
    assert manifest.unseen(fresh, landing.landed_files(spark, root, 2, between=between)).count() == 0
    assert manifest.only(landing.read_prices(spark, root, between), fresh).count() == 2


def test_an_unreachable_file_stops_the_load(spark, tmp_path):
    config = RunConfig(landing=str(tmp_path), storage=str(tmp_path / "s"), prefix="unread_")
    storage.create_schemas(spark, config, "bronze", "ops")
    listed = spark.createDataFrame([("a.json", datetime.datetime(2024, 1, 1))], "source_file string, modified_at timestamp")
    with pytest.raises(RuntimeError, match="nothing was appended"):
        bronze._load_new(spark, config, "t", listed, lambda between: listed.limit(0), lambda between: listed, lambda rows: rows)
    assert not storage.exists(spark, config.table("ops", "loaded_t"))


def test_members_are_held_against_sizes(spark):
    good = document([("Region", category(["01", "02"], {"01": "a", "02": "b"})), ("Tid", category(["2024"]))], [1, 2])
    few = json.loads(json.dumps(good)) | {"size": [3, 1], "value": [1, 2, 3]}
    many = json.loads(json.dumps(good)) | {"size": [1, 1], "value": [1]}
    unlabelled = json.loads(json.dumps(good))
    del unlabelled["dimension"]["Region"]["category"]["label"]["02"]
    df = spark.createDataFrame(
        [(name, json.dumps(doc)) for name, doc in (("good", good), ("few", few), ("many", many), ("unlabelled", unlabelled))], "file string, value string"
    )
    wrong = cube.wrong_members(df, ["Region", "Tid"], ["Region"])
    assert rows(wrong, "file", "dimension", "declared_members", "members", "unlabelled") == [
        ("few", "Region", 3, 2, 0), ("many", "Region", 1, 2, 0), ("unlabelled", "Region", 2, 2, 1)]


@pytest.mark.parametrize(("kind", "values"), [
    ("string", ["a:b", "c/d e", "it's 100%", "x=y", "back\\slash"]),
    ("timestamp", [datetime.datetime(2024, 1, 1, 3, 4, 5), datetime.datetime(2024, 1, 2)]),
])
def test_partition_values_survive_a_merge(spark, tmp_path, kind, values):
    config = RunConfig(landing="", storage=str(tmp_path), prefix=f"part_{kind}_")
    storage.create_schemas(spark, config, "silver")
    make = lambda v, ids: spark.createDataFrame([(x, i, v) for x in values for i in ids], f"p {kind}, id int, v int")
    storage.merge(make(1, [1, 2]), config, "silver", "t", ["p", "id"], "p")
    config = RunConfig(landing="", storage=str(tmp_path), prefix=f"part_{kind}_")
    result = storage.merge(make(2, [2, 3]), config, "silver", "t", ["p", "id"], "p")
    assert (result.inserted, result.updated, result.total) == (len(values), len(values), 3 * len(values))
    expected = [(x, i, v) for x in values for i, v in ((1, 1), (2, 2), (3, 2))]
    assert rows(spark.table(config.table("silver", "t")), "p", "id", "v") == sorted(expected, key=repr)


def test_merge_refuses_what_it_cannot_place(spark, tmp_path):
    config = RunConfig(landing="", storage=str(tmp_path), prefix="refuse_")
    storage.create_schemas(spark, config, "silver")
    first = spark.createDataFrame([("a", 1)], "p string, v int")
    storage.merge(first, config, "silver", "t", ["p"], "p")
    with pytest.raises(ValueError, match="share a key"):
        storage.merge(first.union(first), config, "silver", "t", ["p"], "p")
    with pytest.raises(ValueError, match="has none"):
        storage.merge(spark.createDataFrame([(None, 2)], "p string, v int"), config, "silver", "t", ["p"], "p")


def test_values_out_of_range_become_null(spark):
    df = spark.createDataFrame([(10_000_000, 1, 99_999_999), (1000, 500, 2020)], "total int, rate int, year int")
    found = rows(df.select(S.estimate_from_rate("total", "rate").alias("e"), S.year_end("year").cast("string").alias("y")))
    assert sorted(found, key=str) == [(2000, "2020-12-31"), (None, None)]


def test_missing_members_gathers_no_key(spark):
    present = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 9)], "k string, m int")
    keys = spark.createDataFrame([("a",), ("b",), ("d",)], "k string")
    gaps = missing_members(present, keys, ["k"], "m", F.array(F.lit(1), F.lit(2)))
    assert rows(gaps) == [("a", 2), ("b", 1), ("d", 1), ("d", 2)]
    assert "collect_list" not in gaps._jdf.queryExecution().executedPlan().toString()
