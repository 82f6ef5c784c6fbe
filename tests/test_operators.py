"""Hand-written cases for scalars, deduplication, trailing periods and calendars."""

import datetime
import itertools

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tierwell.functions import codes as C
from tierwell.functions import scalars as S
from tierwell.operators import aggregates, dedup, joins, star, trailing
from tierwell.plans import curated
from tierwell.sources import calendar

D = datetime.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, wanted", [("2024M01", D(2024, 1, 1)), ("2024X01", None), ("2024M13", None), (None, None)])
def test_month_of_period(spark, text, wanted):
    assert one(spark, S.month_of_period(F.lit(text).cast("string"))) == wanted


@pytest.mark.parametrize("text, wanted", [("12", 12), ("abc", None), ("1.0", None), (None, None), ("99999999999", None)])
def test_bad_numbers_become_null(spark, text, wanted):
    assert one(spark, S.as_int(F.lit(text).cast("string"))) == wanted


def test_local_date_needs_no_time_zone(spark):
    assert one(spark, S.local_date(F.lit("2024-01-15T00:00:00+01:00"))) == D(2024, 1, 15)
    assert one(spark, S.local_date(F.lit("yesterday"))) is None


@pytest.mark.parametrize("total, rate, wanted", [(1030, 412, 2500), (500, 0, None), (None, 412, None), (500, None, None), (1, 16, 63)])
def test_estimate_from_rate(spark, total, rate, wanted):
    assert one(spark, S.estimate_from_rate(F.lit(total).cast("int"), F.lit(rate).cast("int"))) == wanted


def test_rounding_is_half_up(spark):
    assert one(spark, S.ratio(F.lit(5), F.lit(2), 0)) == 3.0
    assert one(spark, S.ratio(F.lit(-5), F.lit(2), 0)) == -3.0


@pytest.mark.parametrize("count, minutes", [(23, 60), (30, 60), (31, 15), (96, 15)])
def test_resolution(spark, count, minutes):
    assert one(spark, S.resolution_minutes(F.lit(count))) == minutes


def test_growth_without_a_previous_period(spark):
    assert one(spark, S.growth(F.lit(5), F.lit(0))) is None
    assert one(spark, S.growth(F.lit(3), F.lit(2))) == 0.5


def test_calendar_differences(spark):
    later, earlier = F.lit(D(2024, 2, 1)), F.lit(D(2023, 11, 30))
    assert one(spark, S.months_between_calendar(later, earlier)) == 3
    assert one(spark, S.years_between_calendar(later, F.lit(2022))) == 2


def test_null_safe_difference(spark):
    nothing = F.lit(None).cast("int")
    assert one(spark, S.differs(nothing, nothing)) is False
    assert one(spark, S.differs(nothing, F.lit(1))) is True
    assert one(spark, S.any_of([])) is False


def test_keep_newest_does_not_depend_on_row_order(spark):
    versions = [("a", 1, "x", 5), ("a", 2, "y", 1), ("a", 2, "y", 3), ("b", 1, None, None), ("b", None, "z", 9)]
    for order in itertools.islice(itertools.permutations(versions), 0, 120, 17):
        df = spark.createDataFrame(list(order), "k string, v int, label string, n int").repartition(3)
        assert rows(dedup.keep_newest(df, ["k"], ["v"])) == [("a", 2, "y", 3), ("b", 1, None, None)]


def test_deduplicate_drops_the_version_or_leaves_the_frame_alone(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "k string, _ingested_at int, n int")
    assert rows(dedup.deduplicate(df, ["k"])) == [("a", 20)]
    plain = df.drop("_ingested_at")
    assert dedup.deduplicate(plain, ["k"]) is plain


def test_latest_label_is_of_the_newest_period_then_load(spark):
    df = spark.createDataFrame([
        ("1", "old", "2023M12", 9), ("1", "new", "2024M01", 1), ("1", "corrected", "2024M01", 2),
        ("2", "named", "2023M01", 1), ("2", None, "2024M01", 1),
    ], "code string, name string, Tid string, _ingested_at int")
    assert rows(dedup.latest_labels(df, "code", "name")) == [("1", "corrected"), ("2", None)]


def test_grain_separates_detail_county_and_retired(spark):
    labels = spark.createDataFrame([
        ("00", "Riket"), ("01", "Län 1"), ("0114", "A"), ("1917", "Gone"), ("9901", "Lost")], "code string, label string")
    areas = joins.seed_frame(spark, {"01": "SE3"}, "county_code", "price_area")
    assert rows(curated.municipality(labels, areas, ("01",))) == [
        ("0114", "A", "01", "Län 1", "SE3", True), ("9901", "Lost", "99", None, None, False)]


def test_seed_matches_the_split_counties(spark):
    assert len(C.COUNTY_PRICE_AREA) == 21 and set(C.SPLIT_COUNTIES) <= set(C.COUNTY_PRICE_AREA)


def test_inhabitants_use_the_newest_load_of_each_code(spark):
    bronze = spark.createDataFrame([
        ("0114", "2023", "000", "900", 1), ("0114", "2023", "000", "1000", 2), ("0114", "2023", "060", "500", 1),
        ("0115", "2023", "000", "700", 1), ("0115", "2023", "060", "0", 1), ("01", "2023", "000", "9", 1),
        ("0116", "2023", "000", "700", 1), ("0116", "2023", "060", "350", 1), ("0116", "2023", "060", None, 2),
    ], "Region string, Tid string, Agarkategori string, value string, _ingested_at int")
    built = curated.inhabitants(bronze, "000", "060")
    assert rows(built, "municipality_code", "cars_per_1000_inhabitants", "inhabitants_estimate") == [
        ("0114", 500, 2000), ("0115", 0, None), ("0116", None, None)]
    assert built.first().reference_date == D(2023, 12, 31)


def test_corrected_price_replaces_the_old_one_and_autumn_hour_stays_double(spark):
    bronze = spark.createDataFrame([
        ("SE3", "2024-10-27T02:00:00+02:00", "1.0", 1, "f"), ("SE3", "2024-10-27T02:00:00+01:00", "3.0", 1, "f"),
        ("SE3", "2024-10-27T02:00:00+01:00", "5.0", 2, "f"),
    ], "elomrade string, time_start string, SEK_per_kWh string, _ingested_at int, _source_file string")
    assert rows(curated.electricity_prices_daily(bronze)) == [("SE3", D(2024, 10, 27), 3.0, 1.0, 5.0, 2, 60)]


def registrations(spark, data):
    return spark.createDataFrame(data, "municipality_code string, registration_month date, fuel_type_code string, registration_count int")


def test_trailing_windows(spark):
    facts = registrations(spark, [
        ("A", D(2024, 6, 1), "120", 5), ("A", D(2023, 7, 1), "120", 7), ("A", D(2023, 6, 1), "120", 11),
        ("A", D(2022, 7, 1), "120", 13), ("A", D(2022, 6, 1), "120", 17), ("A", D(2024, 1, 1), "140", 2),
        ("B", D(2024, 6, 1), "100", 4), ("C", D(2020, 1, 1), "100", 9), ("D", D(2020, 1, 1), "120", 3),
    ])
    assert rows(trailing.registration_measures(facts, "municipality_code", "120", "140")) == [
        ("A", 12, 24, 2, 14, 53),
        ("B", 0, 0, 0, 4, None),        # rows, but none electric
        ("D", None, None, None, None, 3),  # nothing in 24 months
    ]
    assert rows(trailing.cumulative_stock(facts, "municipality_code", "120")) == [("A", 53), ("D", 3)]


def test_sums_of_sums_keep_their_meaning(spark):
    facts = registrations(spark, [("A", D(2024, 6, 1), "100", 4), ("B", D(2020, 1, 1), "120", 9)])
    per_key = trailing.registration_measures(facts, "municipality_code", "120", "140")
    total = trailing.add_up(per_key.withColumn("all", F.lit("x")), "all", trailing.REGISTRATION_SUMS)
    assert rows(total) == [("x", 0, 0, 0, 4, 9)]


def test_trailing_price_uses_the_global_anchor(spark):
    daily = spark.createDataFrame([
        ("SE1", D(2024, 12, 31), 1.0), ("SE1", D(2024, 1, 2), 2.0), ("SE1", D(2024, 1, 1), 100.0),
        ("SE2", D(2024, 6, 1), 0.5),
    ], "price_area string, price_date date, avg_sek_per_kwh double")
    assert rows(trailing.trailing_price(daily, "price_area", "price_date", "avg_sek_per_kwh")) == [
        ("SE1", 150.0, 70.71), ("SE2", 50.0, None)]


def test_decision_table_on_a_small_star(spark):
    tables = {
        "dim_municipality": spark.createDataFrame([
            ("A", "a", "01", "x", "SE1", False), ("B", "b", "01", "x", "SE9", True)],
            "municipality_code string, municipality_name string, county_code string, county_name string, price_area string, price_area_is_split boolean"),
        "fact_cars_in_traffic": spark.createDataFrame([
            ("A", 2023, D(2023, 12, 31), "000", 100), ("A", 2023, D(2023, 12, 31), "030", 40),
            ("A", 2023, D(2023, 12, 31), "040", 5), ("A", 2022, D(2022, 12, 31), "000", 999)],
            "municipality_code string, year int, reference_date date, ownership_category_code string, vehicle_count int"),
        "fact_inhabitants": spark.createDataFrame([("A", 2023, D(2023, 12, 31), 300), ("A", 2022, D(2022, 12, 31), 1)],
            "municipality_code string, year int, reference_date date, inhabitants_estimate int"),
        "fact_new_registrations": registrations(spark, [("A", D(2024, 1, 1), "120", 6), ("A", D(2023, 1, 1), "120", 4)]),
        "fact_electricity_price_daily": spark.createDataFrame([("SE1", D(2024, 1, 1), 0.5)],
            "price_area string, price_date date, avg_sek_per_kwh double"),
    }
    result = star.decision_table(tables, C)
    a, b = sorted(result.collect(), key=lambda r: r.municipality_code)
    assert (a.cars_total, a.legal_entity_share_of_fleet, a.inhabitants_estimate) == (100, 0.4, 300)
    assert (a.ev_registration_growth, a.ev_registrations_change, a.ev_share_of_new_registrations) == (0.5, 2, 1.0)
    assert (a.electric_stock_estimate, a.electric_share_of_fleet, a.electric_cars_per_1000_inhabitants) == (10, 0.1, 33.3)
    assert (a.avg_ore_per_kwh_12m, a.price_stddev_ore_12m) == (50.0, None)
    assert (b.cars_total, b.ev_registrations_12m, b.avg_ore_per_kwh_12m) == (None, None, None)
    assert b.registrations_through_month == D(2024, 1, 1) and b.vehicles_as_of_year == 2023
    assert result.columns[-2:] == ["registrations_through_month", "vehicles_as_of_year"] and len(result.columns) == 25


def test_freshness_of_empty_facts_is_null(spark):
    lags = star.freshness_lags(star.freshness_facts(
        spark.createDataFrame([], "registration_month date"), spark.createDataFrame([], "year int"),
        spark.createDataFrame([], "price_date date"), F.lit(D(2024, 1, 1))))
    row = lags.first()
    assert (row.months_behind, row.years_behind, row.days_behind) == (None, None, None)


def test_orphans_are_distinct(spark):
    facts = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    assert rows(joins.orphan_keys(facts, spark.createDataFrame([("y",)], "k string"), "k")) == [("x",)]


def test_missing_days(spark):
    areas = calendar.area_frame(spark, ["SE1", "SE2"])
    present = spark.createDataFrame(
        [("SE1", D(2024, 1, d)) for d in (1, 2, 4, 9)] + [("SE1", D(2023, 1, 1))], "price_area string, price_date date")
    accepted = spark.createDataFrame([("SE2", D(2024, 1, 1))], "price_area string, price_date date")
    gaps = calendar.missing_days(present, areas, F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 6)), 2, accepted)
    assert rows(gaps) == [("SE1", D(2024, 1, 3)), *[("SE2", D(2024, 1, d)) for d in (2, 3, 4)]]
    early = calendar.missing_days(present, areas, F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 1)), 2)
    assert early.isEmpty()


def test_landing_status(spark):
    areas = calendar.area_frame(spark, ["SE1"])
    expected = calendar.expected_days(areas, calendar.calendar(F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 3))))
    before = spark.createDataFrame([("SE1", D(2024, 1, 1))], "price_area string, price_date date")
    after = spark.createDataFrame([("SE1", D(2024, 1, d)) for d in (1, 2)], "price_area string, price_date date")
    states = calendar.landing_status(expected, before, after, ["price_area", "price_date"])
    assert rows(calendar.status_tally(states)) == [("fetched", 1), ("missing", 1), ("skipped", 1)]


def test_grid_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "x string, y int")
    assert rows(aggregates.grid_profile(df, {"xs": "x", "ys": "y"})) == [(3, 2, 2, 4, False)]


def test_top_by_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None)], "k string, n int")
    assert [r.k for r in aggregates.top_by(df, "n", "k", 2).collect()] == ["a", "b"]
