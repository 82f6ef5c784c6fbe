"""Landing files to decision table, and again: what a second run must and must not change."""

import datetime
import json
import os

import pytest
from helpers import rows
from landing_files import MUNICIPALITIES, land, price_day, registration_count, registrations, write, write_price

from tierwell.config import RunConfig
from tierwell.functions import codes as C
from tierwell.operators.quality import QualityError, history
from tierwell.plans import bronze, gold, silver

AS_OF = datetime.date(2022, 11, 6)
REGION_COUNT = 1 + 21 + C.MUNICIPALITY_COUNT + 1


def config(folder, prefix, **changes):
    return RunConfig(landing=str(folder / "landing"), storage=str(folder / "storage"), prefix=prefix,
                     as_of=AS_OF, **{"run_id": "run", **changes})


def again(before, **changes):
    return RunConfig(landing=before.landing, storage=before.storage, prefix=before.prefix, as_of=AS_OF,
                     **{"run_id": "again", **changes})


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    land(folder / "landing", AS_OF)
    (folder / "landing" / "TAB3277" / "TAB3277_2022M11.json.tmp").write_text("{ unfinished")
    first = config(folder, "jobs_")
    return folder, first, bronze.run(spark, first), silver.run(spark, first), gold.run(spark, first)


def test_bronze_holds_every_cell_and_period(spark, done):
    _, c, loaded, _, _ = done
    assert loaded == {"scb_new_registrations": 3, "scb_cars_in_traffic": 2, "electricity_prices": 6 * 4}
    table = spark.table(c.table("bronze", "scb_new_registrations"))
    assert table.columns == [
        "Region", "Region_label", "Drivmedel", "Drivmedel_label", "ContentsCode", "Tid", "value",
        "_source_table", "_source_file", "_ingested_at", "_load"]
    assert table.count() == 3 * REGION_COUNT * 8
    assert rows(table.where("Region = '2550' and Drivmedel = '120'"), "Tid", "value", "_source_file") == sorted(
        (p, str(registration_count("2550", "120", p)), f"TAB3277_{p}.json") for p in ("2022M08", "2022M09", "2022M10"))
    prices = spark.table(c.table("bronze", "electricity_prices"))
    assert prices.columns == ["elomrade", "time_start", "time_end", "SEK_per_kWh", "EUR_per_kWh", "EXR",
                              "_source_file", "_ingested_at", "_load"]
    assert "elomrade=SE3/ar=2022/2022-11-01.json" in {r[0] for r in rows(prices.select("_source_file").distinct())}
    assert rows(bronze.price_coverage(spark, c), "elomrade", "file_count", "row_count")[3] == ("SE4", 6, 6 * 96)


def test_silver_is_typed_and_at_municipality_grain(spark, done):
    _, c, _, merged, _ = done
    assert merged["municipality"].total == C.MUNICIPALITY_COUNT
    assert merged["new_registrations"].inserted == 3 * C.MUNICIPALITY_COUNT * 8
    assert merged["cars_in_traffic"].total == 2 * C.MUNICIPALITY_COUNT * len(C.OWNERSHIP_COUNTS)
    facts = spark.table(c.table("silver", "new_registrations"))
    assert dict(facts.dtypes) == {"municipality_code": "string", "registration_month": "date",
                                  "fuel_type_code": "string", "registration_count": "int"}
    assert {r[0] for r in rows(facts.select("municipality_code").distinct())} == set(MUNICIPALITIES)
    daily = spark.table(c.table("silver", "electricity_prices_daily"))
    assert rows(daily.where("price_date = '2022-11-03'"), "price_area", "period_count", "resolution_minutes") == [
        ("SE1", 24, 60), ("SE2", 24, 60), ("SE3", 24, 60), ("SE4", 96, 15)]
    people = spark.table(c.table("silver", "inhabitants")).where("municipality_code = '2550' and year = 2021")
    assert rows(people, "cars_per_1000_inhabitants", "inhabitants_estimate") == [(412, round(1350 / 412 * 1000))]


def test_gold_has_one_row_per_municipality(spark, done):
    _, c, _, _, counts = done
    assert counts["charging_station_candidates"] == C.MUNICIPALITY_COUNT
    table = spark.table(c.table("gold", "charging_station_candidates"))
    assert len(table.columns) == 25
    row = table.where("municipality_code = '2550'").first()
    ev = sum(registration_count("2550", "120", p) for p in ("2022M08", "2022M09", "2022M10"))
    assert (row.ev_registrations_12m, row.electric_stock_estimate, row.ev_registration_growth) == (ev, ev, None)
    assert (row.cars_total, row.cars_legal_entities, row.price_area, row.vehicles_as_of_year) == (1350, 450, "SE1", 2021)
    assert gold.top_candidates(spark, c).count() == 25


def test_second_run_changes_nothing(spark, done):
    _, c, _, _, _ = done
    second = again(c)
    assert set(bronze.run(spark, second).values()) == {0}
    merged = silver.run(spark, second)
    assert {(m.inserted, m.updated) for m in merged.values()} == {(0, 0)}
    assert merged["new_registrations"].unchanged == merged["new_registrations"].total
    assert not os.path.exists(second.path("silver", "municipality"))


def test_relanded_file_is_a_new_version_and_wins(spark, done):
    folder, c, _, _, _ = done
    path = folder / "landing" / "TAB3277" / "TAB3277_2022M09.json"
    write(path, registrations("2022M09", suffix=" ny", change=("0150", "120", 777)))
    write_price(folder / "landing", "SE3", datetime.date(2022, 11, 2), price=1.0)
    before = spark.table(c.table("silver", "new_registrations")).inputFiles()
    third = again(c)
    assert bronze.run(spark, third) == {"scb_new_registrations": 1, "scb_cars_in_traffic": 0, "electricity_prices": 1}
    merged = silver.run(spark, third)
    assert (merged["new_registrations"].inserted, merged["new_registrations"].updated) == (0, 1)
    assert merged["electricity_prices_daily"].updated == 1
    assert merged["municipality"].updated == 0  # the newest period still has the old label
    facts = spark.table(c.table("silver", "new_registrations"))
    assert facts.count() == 3 * C.MUNICIPALITY_COUNT * 8
    assert facts.where("municipality_code = '0150' and fuel_type_code = '120' and registration_count = 777").count() == 1
    # Only the month with a change is rewritten.
    rewritten = set(facts.inputFiles()) - set(before)
    assert rewritten and all("2022-09-01" in name for name in rewritten)


def test_touched_periods_give_the_same_tables(spark, done):
    folder, c, _, _, _ = done
    idle = silver.run(spark, again(c), only_touched=True)
    assert {(m.inserted, m.updated) for m in idle.values()} == {(0, 0)}
    assert idle["new_registrations"].unchanged == 0  # no period was looked at
    write(folder / "landing" / "TAB3277" / "TAB3277_2022M08.json", registrations("2022M08", change=("0350", "140", 888)))
    write_price(folder / "landing", "SE2", datetime.date(2022, 11, 4), price=2.0)
    bronze.run(spark, again(c))
    merged = silver.run(spark, again(c), only_touched=True)
    assert (merged["new_registrations"].updated, merged["new_registrations"].unchanged) == (1, C.MUNICIPALITY_COUNT * 8 - 1)
    assert (merged["electricity_prices_daily"].updated, merged["electricity_prices_daily"].unchanged) == (1, 3)
    assert merged["cars_in_traffic"].unchanged == 0
    everything = silver.run(spark, again(c))
    assert {(m.inserted, m.updated) for m in everything.values()} == {(0, 0)}


def test_failed_check_leaves_silver_as_it_was_and_is_logged(spark, tmp_path):
    c = config(tmp_path, "broken_")
    land(tmp_path / "landing", AS_OF)
    write_price(tmp_path / "landing", "SE1", datetime.date(2022, 11, 3), periods=12)
    write(tmp_path / "landing" / "TAB3277" / "TAB3277_2022X11.json", registrations("2022X11"))
    bronze.run(spark, c)
    with pytest.raises(QualityError) as failure:
        silver.run(spark, c)
    assert "days are complete" in str(failure.value) and "periods are months" in str(failure.value)
    assert not spark.catalog.tableExists(c.table("silver", "municipality"))
    log = history(spark, c.results_table, "run").where("layer = 'silver' and not passed")
    found = {r.check_name: r for r in log.collect()}
    assert found["days are complete"].failed_rows == 1
    assert '"price_date":"2022-11-03"' in found["days are complete"].sample
    assert found["periods are months"].failed_rows == C.MUNICIPALITY_COUNT * 8


def test_gap_and_wrong_size_stop_bronze(spark, tmp_path):
    c = config(tmp_path, "gaps_")
    land(tmp_path / "landing", AS_OF)
    (tmp_path / "landing" / "elpris" / "elomrade=SE2" / "ar=2022" / "2022-11-02.json").rename(tmp_path / "kept.json")
    with pytest.raises(QualityError, match="no past day without a file"):
        bronze.load_prices(spark, c)
    assert bronze.load_prices(spark, again(c, known_missing_days=(("SE2", "2022-11-02"),))) == 23
    payload = registrations("2022M10")
    payload["value"] = payload["value"][:-1]
    write(tmp_path / "landing" / "TAB3277" / "TAB3277_2022M10.json", payload)
    with pytest.raises(QualityError, match="cells as declared"):
        bronze.load_cube(spark, c, "scb_new_registrations")
    assert not spark.catalog.tableExists(c.table("bronze", "scb_new_registrations"))


def test_stale_sources_stop_gold(spark, done):
    _, c, _, _, _ = done
    late = RunConfig(landing=c.landing, storage=c.storage, prefix=c.prefix, run_id="late",
                     as_of=datetime.date(2025, 1, 1))
    location = spark.table(c.table("gold", "dim_municipality")).inputFiles()
    with pytest.raises(QualityError, match="prices are recent"):
        gold.run(spark, late)
    assert spark.table(c.table("gold", "dim_municipality")).inputFiles() == location


def test_dropped_bronze_table_is_rebuilt_from_the_files(spark, done):
    _, c, _, _, _ = done
    name = c.table("bronze", "scb_cars_in_traffic")
    count = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    assert bronze.load_cube(spark, again(c), "scb_cars_in_traffic") == 2
    assert spark.table(name).count() == count


def test_run_that_died_before_the_manifest_is_repeated_without_effect(spark, done):
    _, c, _, _, _ = done
    spark.sql(f"DROP TABLE {c.table('ops', 'loaded_electricity_prices')}")
    count = spark.table(c.table("bronze", "electricity_prices")).count()
    assert bronze.load_prices(spark, again(c)) == 24
    assert spark.table(c.table("bronze", "electricity_prices")).count() > count
    merged = silver.run(spark, again(c))
    assert {(m.inserted, m.updated) for m in merged.values()} == {(0, 0)}


def test_file_without_rows_is_loaded_once(spark, tmp_path):
    c = config(tmp_path, "empty_", known_missing_days=())
    land(tmp_path / "landing", AS_OF)
    path = tmp_path / "landing" / "elpris" / "elomrade=SE1" / "ar=2022" / "2022-11-05.json"
    write(path, [])
    assert bronze.load_prices(spark, c) == 24
    assert bronze.load_prices(spark, again(c)) == 0


def test_late_file_with_an_old_time_is_still_loaded(spark, tmp_path):
    c = config(tmp_path, "late_")
    land(tmp_path / "landing", AS_OF)
    day = datetime.date(2022, 11, 5)
    path = tmp_path / "landing" / "elpris" / "elomrade=SE4" / "ar=2022" / f"{day}.json"
    path.rename(tmp_path / "kept.json")
    assert bronze.load_prices(spark, c) == 23
    write(path, price_day("SE4", day, periods=24))
    os.utime(path, (1_000_000_000, 1_000_000_000))
    assert bronze.load_prices(spark, again(c)) == 1
    newer = path.with_name(f"{datetime.date(2022, 11, 7)}.json")
    older = path.with_name(f"{datetime.date(2022, 11, 8)}.json")
    write(newer, price_day("SE4", datetime.date(2022, 11, 7)))
    write(older, price_day("SE4", datetime.date(2022, 11, 8)))
    os.utime(older, (1_000_000_001, 1_000_000_001))
    assert bronze.load_prices(spark, again(c)) == 2
    table = spark.table(c.table("bronze", "electricity_prices"))
    assert table.count() == 18 * 24 + 5 * 96 + 3 * 24


def test_worklist_and_tally(spark, done):
    _, c, _, _, _ = done
    published = [registrations(p) for p in ("2015M12", "2022M10", "2022M11")]
    metadata = spark.createDataFrame([(json.dumps(p),) for p in published], "value string")
    assert rows(bronze.cube_worklist(spark, c, "scb_new_registrations", metadata)) == [("2022M11",)]
    nothing = spark.createDataFrame([], "source_file string, modified_at timestamp")
    assert rows(bronze.price_landing_tally(spark, c, nothing)) == [("fetched", 24)]


def test_parameters_keep_runs_apart(spark, done):
    _, c, _, _, _ = done
    assert c.table("gold", "t") == "jobs_gold.t"
    assert config_today(spark) == AS_OF


def config_today(spark):
    return spark.range(1).select(RunConfig("", "", as_of=AS_OF).today().alias("d")).first().d


def test_bronze_load_time_is_one_value_per_append(spark, done):
    _, c, _, _, _ = done
    loads = spark.table(c.table("bronze", "electricity_prices")).groupBy("_source_file", "_ingested_at").count()
    assert {n for (n,) in rows(loads.select("count").distinct())} == {24, 96}  # whole files
