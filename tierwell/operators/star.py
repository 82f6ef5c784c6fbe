"""The star schema and the wide decision table on top of it."""

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.functions import scalars as S
from tierwell.operators.aggregates import max_where
from tierwell.operators.joins import enrich
from tierwell.operators.trailing import registration_measures, trailing_price

# Star table -> (source table, columns it exposes).
STAR_TABLES = {
    "dim_municipality": ("municipality", (
        "municipality_code", "municipality_name", "county_code",
        "county_name", "price_area", "price_area_is_split")),
    "dim_fuel_type": ("fuel_type", ("fuel_type_code", "fuel_type_name", "is_electrified")),
    "dim_ownership_category": ("ownership_category", (
        "ownership_category_code", "ownership_category_name")),
    "fact_new_registrations": ("new_registrations", (
        "municipality_code", "registration_month", "fuel_type_code", "registration_count")),
    "fact_cars_in_traffic": ("cars_in_traffic", (
        "municipality_code", "year", "reference_date", "ownership_category_code", "vehicle_count")),
    "fact_inhabitants": ("inhabitants", (
        "municipality_code", "year", "reference_date", "inhabitants_estimate")),
    "fact_electricity_price_daily": ("electricity_prices_daily", (
        "price_area", "price_date", "avg_sek_per_kwh", "min_sek_per_kwh",
        "max_sek_per_kwh", "resolution_minutes")),
}
CANDIDATES = "charging_station_candidates"


def star_view(source: DataFrame, name: str) -> DataFrame:
    return source.select(*STAR_TABLES[name][1])


def fleet_measures(cars: DataFrame, key: str, year: Column, total: str, legal_entity: str, taxi: str) -> DataFrame:
    """Vehicle counts of one year, one column per ownership code.  Codes overlap and are never added up."""
    code = F.col("ownership_category_code")
    return cars.where(F.col("year") == year).groupBy(key).agg(
        max_where("vehicle_count", code == total).alias("cars_total"),
        max_where("vehicle_count", code == legal_entity).alias("cars_legal_entities"),
        max_where("vehicle_count", code == taxi).alias("cars_taxi"),
    )


def decision_columns(wide: DataFrame, through_month: Column, as_of_year: Column) -> DataFrame:
    """Ratios and changes on the joined measures.  Inputs for a decision, not a ranking score."""
    ev, ev_before = F.col("ev_registrations_12m"), F.col("ev_registrations_prev_12m")
    stock, fleet = F.col("electric_stock_estimate"), F.col("cars_total")
    return wide.select(
        *STAR_TABLES["dim_municipality"][1],
        "cars_total", "cars_legal_entities", "cars_taxi",
        S.ratio("cars_legal_entities", fleet, 4).alias("legal_entity_share_of_fleet"),
        "inhabitants_estimate",
        "ev_registrations_12m", "ev_registrations_prev_12m",
        S.growth(ev, ev_before).alias("ev_registration_growth"),
        (ev - ev_before).alias("ev_registrations_change"),
        "phev_registrations_12m", "total_registrations_12m",
        S.ratio(ev, "total_registrations_12m", 4).alias("ev_share_of_new_registrations"),
        "electric_stock_estimate",
        S.ratio(stock, fleet, 4).alias("electric_share_of_fleet"),
        S.per_thousand(stock, "inhabitants_estimate").alias("electric_cars_per_1000_inhabitants"),
        "avg_ore_per_kwh_12m", "price_stddev_ore_12m",
        through_month.alias("registrations_through_month"),
        as_of_year.alias("vehicles_as_of_year"),
    )


def decision_table(tables: dict, codes, price_days: int = 365) -> DataFrame:
    """One row per municipality, from the star schema.

    Every measure is aggregated to its join key first, so the star join only ever meets
    frames with one row per key and the facts are shuffled once each, as partial sums.
    """
    key = "municipality_code"
    cars, registrations = tables["fact_cars_in_traffic"], tables["fact_new_registrations"]
    year = cars.agg(F.max("year")).scalar()
    month = registrations.agg(F.max("registration_month")).scalar()
    wide = enrich(
        tables["dim_municipality"],
        (fleet_measures(cars, key, year, codes.OWNERSHIP_TOTAL, codes.OWNERSHIP_LEGAL_ENTITY,
                        codes.OWNERSHIP_TAXI), key),
        (tables["fact_inhabitants"].where(F.col("year") == year).select(key, "inhabitants_estimate"), key),
        (registration_measures(registrations, key, codes.FUEL_ELECTRIC, codes.FUEL_PLUG_IN), key),
        (trailing_price(tables["fact_electricity_price_daily"], "price_area", "price_date",
                        "avg_sek_per_kwh", price_days), "price_area"),
    )
    return decision_columns(wide, month, year)


def freshness_facts(registrations: DataFrame, cars: DataFrame, prices: DataFrame, today: Column) -> DataFrame:
    """One row: the newest month, year and day of the three facts next to today's date."""
    return registrations.agg(F.max("registration_month").alias("latest_registration_month")).select(
        "latest_registration_month",
        cars.agg(F.max("year")).scalar().alias("latest_vehicle_year"),
        prices.agg(F.max("price_date")).scalar().alias("latest_price_date"),
        today.alias("today"),
    )


def freshness_lags(facts: DataFrame) -> DataFrame:
    """How many months, years and days the three facts are behind.  NULL when a fact is empty."""
    return facts.select(
        "*",
        S.months_between_calendar("today", "latest_registration_month").alias("months_behind"),
        S.years_between_calendar("today", F.col("latest_vehicle_year")).alias("years_behind"),
        F.datediff("today", "latest_price_date").alias("days_behind"),
    )
