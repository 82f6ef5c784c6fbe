"""Bronze frames to curated (silver) frames: typed, at the right grain, one row per business key.

Each builder takes text frames and returns a lazy DataFrame; nothing is written here.  Code
sets and grain conditions are arguments so that the builders do not know which country,
fuel or area list they serve.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.functions import codes as C
from tierwell.functions import scalars as S
from tierwell.operators.aggregates import daily_profile
from tierwell.operators.dedup import deduplicate, keep_newest, latest_labels
from tierwell.operators.joins import enrich, seed_frame
from tierwell.operators.storage import StoredBy

# Curated table -> business key.
KEYS = {
    "municipality": ("municipality_code",),
    "fuel_type": ("fuel_type_code",),
    "ownership_category": ("ownership_category_code",),
    "new_registrations": ("municipality_code", "registration_month", "fuel_type_code"),
    "cars_in_traffic": ("municipality_code", "year", "ownership_category_code"),
    "inhabitants": ("municipality_code", "year"),
    "electricity_prices_daily": ("price_area", "price_date"),
}

# Curated facts that grow with time -> the key column they are stored by, or what is computed from one.
# A merge then rewrites only the months or years that have changed rows.
def stored_by() -> dict:
    month = F.date_format("price_date", "yyyy-MM")
    return {
        "new_registrations": "registration_month",
        "cars_in_traffic": "year",
        "inhabitants": "year",
        "electricity_prices_daily": StoredBy("price_month", "price_date", month),
    }


@dataclass(frozen=True)
class RegionGrain:
    """Which region codes are detail rows, which are county rows, and which are no longer used."""

    detail: int = 4
    county: int = 2
    retired: tuple = C.RETIRED_REGIONS

    def is_detail(self, code) -> Column:
        return S.at_grain(code, self.detail, self.retired)

    def is_county(self, code) -> Column:
        return S.at_grain(code, self.county)


def municipality(labels: DataFrame, areas: DataFrame, split_counties, grain=RegionGrain()) -> DataFrame:
    """Detail regions with their county's name and price area.

    ``labels`` is (code, label) with one row per code, ``areas`` is (county_code, price_area).
    """
    code, label = F.col("code"), F.col("label")
    detail = labels.where(grain.is_detail(code)).select(
        code.alias("municipality_code"),
        label.alias("municipality_name"),
        F.substring(code, 1, grain.county).alias("county_code"),
    )
    counties = labels.where(grain.is_county(code)).select(code.alias("county_code"), label.alias("county_name"))
    return enrich(detail, (counties, "county_code"), (areas, "county_code")).select(
        "municipality_code", "municipality_name", "county_code", "county_name", "price_area",
        F.col("county_code").isin(*split_counties).alias("price_area_is_split"),
    )


def fuel_type(bronze: DataFrame, electrified) -> DataFrame:
    return fuel_type_of(latest_labels(bronze, "Drivmedel", "Drivmedel_label"), electrified)


def fuel_type_of(labels: DataFrame, electrified) -> DataFrame:
    code = F.col("code")
    return labels.select(
        code.alias("fuel_type_code"),
        F.col("label").alias("fuel_type_name"),
        code.isin(*electrified).alias("is_electrified"),
    )


def ownership_category(bronze: DataFrame, counts) -> DataFrame:
    named = bronze.where(F.col("Agarkategori").isin(*counts))
    return ownership_category_of(latest_labels(named, "Agarkategori", "Agarkategori_label"), counts)


def ownership_category_of(labels: DataFrame, counts) -> DataFrame:
    return labels.where(F.col("code").isin(*counts)).select(
        F.col("code").alias("ownership_category_code"), F.col("label").alias("ownership_category_name")
    )


def new_registrations(bronze: DataFrame, grain=RegionGrain()) -> DataFrame:
    typed = bronze.where(grain.is_detail("Region")).select(
        F.col("Region").alias("municipality_code"),
        S.month_of_period("Tid").alias("registration_month"),
        F.col("Drivmedel").alias("fuel_type_code"),
        S.as_int("value").alias("registration_count"),
        "_ingested_at",
    )
    return deduplicate(typed, KEYS["new_registrations"])


def typed_cars(bronze: DataFrame, grain=RegionGrain()) -> DataFrame:
    """Counts and ratios of the cube as they are published, typed but not yet separated."""
    year = S.as_int("Tid")
    return bronze.where(grain.is_detail("Region")).select(
        F.col("Region").alias("municipality_code"),
        year.alias("year"),
        S.year_end(year).alias("reference_date"),
        F.col("Agarkategori").alias("ownership_category_code"),
        S.as_int("value").alias("value"),
        "_ingested_at",
    )


def cars_in_traffic(bronze: DataFrame, counts, grain=RegionGrain()) -> DataFrame:
    """Only the categories that are counts: a ratio must not end up in a count column."""
    cars = typed_cars(bronze, grain).where(F.col("ownership_category_code").isin(*counts))
    return deduplicate(cars.withColumnRenamed("value", "vehicle_count"), KEYS["cars_in_traffic"])


def inhabitants(bronze: DataFrame, total: str, rate: str, grain=RegionGrain()) -> DataFrame:
    """Population estimate from the total and the rate per 1,000 of the same year.

    The newest value of each of the two codes is taken inside the aggregation, as the largest
    (load time, value) pair, so the typed rows are shuffled once and not once for
    deduplication and again for the grouping.
    """
    code = F.col("ownership_category_code")

    def newest(wanted: str) -> Column:
        return F.max(F.when(code == F.lit(wanted), F.struct("_ingested_at", "value")))

    pairs = typed_cars(bronze, grain).groupBy("municipality_code", "year", "reference_date").agg(
        newest(total).alias("total"), newest(rate).alias("rate")
    )
    return pairs.select(
        "municipality_code", "year", "reference_date",
        F.col("rate.value").alias("cars_per_1000_inhabitants"),
        S.estimate_from_rate("total.value", "rate.value").alias("inhabitants_estimate"),
    )


def electricity_prices_daily(bronze: DataFrame) -> DataFrame:
    """Hourly or quarter-hourly prices to one row per area and local day.

    The period is keyed by the offset timestamp *text*, so the repeated hour of an autumn
    clock change stays two periods.
    """
    typed = bronze.select(
        F.col("elomrade").alias("price_area"),
        S.local_date("time_start").alias("price_date"),
        "time_start",
        S.as_double("SEK_per_kWh").alias("sek_per_kwh"),
        "_ingested_at",
        "_source_file",
    )
    prices = keep_newest(typed, ["price_area", "time_start"], ["_ingested_at", "_source_file"])
    return daily_profile(prices, "price_area", "price_date", "sek_per_kwh")


def build_facts(registrations: DataFrame, cars: DataFrame, cars_and_rates: DataFrame,
                prices: DataFrame) -> dict[str, DataFrame]:
    return {
        "new_registrations": new_registrations(registrations),
        "cars_in_traffic": cars_in_traffic(cars, C.OWNERSHIP_COUNTS),
        "inhabitants": inhabitants(cars_and_rates, C.OWNERSHIP_TOTAL, C.OWNERSHIP_CARS_PER_1000),
        "electricity_prices_daily": electricity_prices_daily(prices),
    }


def build_dimensions(regions: DataFrame, fuels: DataFrame, categories: DataFrame) -> dict[str, DataFrame]:
    """The dimensions from the newest (code, label) of each."""
    areas = seed_frame(regions.sparkSession, C.COUNTY_PRICE_AREA, "county_code", "price_area")
    return {
        "municipality": municipality(regions, areas, C.SPLIT_COUNTIES),
        "fuel_type": fuel_type_of(fuels, C.ELECTRIFIED_FUELS),
        "ownership_category": ownership_category_of(categories, C.OWNERSHIP_COUNTS),
    }
