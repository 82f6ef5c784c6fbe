"""Bronze to silver: build, store aside, check, and only then merge."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.config import RunConfig
from tierwell.functions import codes as C
from tierwell.operators import aggregates, quality as Q, storage
from tierwell.plans import curated, labels
from tierwell.sources import manifest

LAYER = "silver"


def checks_before_write(t: dict[str, DataFrame], categories: DataFrame) -> list[Q.Check]:
    """``categories`` has the newest label of every ownership category that ever landed."""
    municipality, fuel_type = t["municipality"], t["fuel_type"]
    registrations, cars = t["new_registrations"], t["cars_in_traffic"]
    people, prices = t["inhabitants"], t["electricity_prices_daily"]
    count = F.col("registration_count")
    grid = aggregates.grid_profile(registrations, {
        "municipalities": "municipality_code", "fuel_types": "fuel_type_code", "months": "registration_month",
    })
    by_category = aggregates.wide_by_code(
        cars, ["municipality_code", "year"], "ownership_category_code", "vehicle_count",
        {code: code for code in C.OWNERSHIP_COUNTS},
    )
    checks = [
        Q.expect_count("municipality", f"{C.MUNICIPALITY_COUNT} municipalities", municipality, C.MUNICIPALITY_COUNT),
        Q.not_null("municipality", "county name and price area are known", municipality, ["county_name", "price_area"]),
        Q.not_null("fuel_type", "fuel types are named", fuel_type, ["fuel_type_name"]),
        Q.in_set("fuel_type", "fuel codes are classified", fuel_type, "fuel_type_code", C.FUEL_CODES, Q.WARNING),
        Q.not_null("new_registrations", "periods are months", registrations, ["registration_month"]),
        Q.row_rule("new_registrations", "counts are present and not negative", registrations,
                   count.isNull() | (count < 0)),
        Q.foreign_key("new_registrations", "municipality is in the dimension", registrations, municipality,
                      "municipality_code"),
        Q.foreign_key("new_registrations", "fuel type is in the dimension", registrations, fuel_type,
                      "fuel_type_code"),
        Q.complete_grid("new_registrations", "all municipalities, fuel types and months are there", grid),
        Q.not_null("cars_in_traffic", "the total is present", by_category, [C.OWNERSHIP_TOTAL]),
        Q.sum_identity("cars_in_traffic", "the total is the sum of its parts", by_category,
                       C.OWNERSHIP_TOTAL, C.OWNERSHIP_PARTS),
        Q.parts_present("cars_in_traffic", "the parts of the total are present", by_category, C.OWNERSHIP_PARTS),
        # Before the curated layer drops what it does not know.
        Q.known_codes("cars_in_traffic", "bronze has only known ownership categories", categories,
                      "code", "label", C.OWNERSHIP_COUNTS + C.OWNERSHIP_RATIOS),
        Q.not_null("inhabitants", "an estimate is present", people, ["inhabitants_estimate"]),
        Q.between("inhabitants", "the estimate is plausible", people, "inhabitants_estimate", *C.INHABITANTS_RANGE),
        Q.not_null("electricity_prices_daily", "an average price is present", prices, ["avg_sek_per_kwh"], Q.WARNING),
        Q.between("electricity_prices_daily", "the average price is possible", prices, "avg_sek_per_kwh",
                  *C.DAILY_PRICE_RANGE),
        Q.in_set("electricity_prices_daily", "days are complete", prices, "period_count", C.COMPLETE_DAY_PERIODS),
        Q.row_rule("electricity_prices_daily", "the average price is not unheard of", prices,
                   F.col("avg_sek_per_kwh") > C.DAILY_PRICE_ALERT, Q.WARNING),
    ]
    # A NULL in a key never matches in a merge and would be inserted again by every run.
    return checks + [
        Q.not_null(name, "the key has no gaps", t[name], keys) for name, keys in curated.KEYS.items()
    ]


# Curated fact -> (bronze table, its column whose first ten characters are the period: a month, a year or a day).
_PERIODS = {
    "new_registrations": ("scb_new_registrations", "Tid"),
    "cars_in_traffic": ("scb_cars_in_traffic", "Tid"),
    "inhabitants": ("scb_cars_in_traffic", "Tid"),
    "electricity_prices_daily": (C.PRICE_TABLE, "time_start"),
}


def _touched(bronze: DataFrame, fresh: DataFrame, column: str) -> DataFrame:
    """All loads of the periods that ``fresh``, the rows of new loads, has.

    The first and last touched period bound the read of the other loads.
    Every load of a touched period is kept: which one wins is for the deduplication to say.
    """
    loads = bronze.withColumn("_period", F.coalesce(F.substring(column, 1, 10), F.lit("")))
    periods = fresh.select(F.coalesce(F.substring(column, 1, 10), F.lit("")).alias("_period")).distinct()
    first, last = periods.agg(F.min("_period"), F.max("_period")).first()
    if first is None:
        return bronze.where(F.lit(False))
    # A missing period counts as "", which has no lower bound.
    near = loads.where((F.col(column) >= first) & (F.col("_period") <= last)) if first else loads
    return near.join(periods, "_period", "left_semi").drop("_period")


def run(spark: SparkSession, config: RunConfig, only_touched: bool = False) -> dict[str, storage.MergeResult]:
    """Build, check and merge all tables.

    By default every fact is rebuilt from all of bronze, and the checks see all of it.  With
    ``only_touched`` the facts are rebuilt for the periods of the loads that they have not taken in
    yet; a merge never deletes, so the tables end up the same, but checks on facts (such as
    the complete grid) then cover those periods only.  A fact that is not there is built from all of
    bronze.  Dimensions come from the stored newest labels, which only new loads are merged into.
    """
    try:
        return _run(spark, config, only_touched)
    finally:
        storage.drop_stage(spark, config)


def _run(spark: SparkSession, config: RunConfig, only_touched: bool) -> dict[str, storage.MergeResult]:
    storage.create_schemas(spark, config, LAYER, "ops")
    checks = Q.QualityChecks(spark, config.results_table, config.run_id, LAYER)
    # The loads this run takes in, kept: others may be recorded meanwhile.
    loads = {
        name: storage.stage(manifest.recorded(spark, config, name).select("load_id"), config, f"loads_of_{name}")
        for name in (*C.CUBE_TABLES, C.PRICE_TABLE)
    }
    bronze = {name: manifest.complete_rows(spark, config, name, ids) for name, ids in loads.items()}
    newest = labels.refresh(spark, config)
    sources = {fact: bronze[name] for fact, (name, _) in _PERIODS.items()}
    if only_touched:
        for fact, (name, column) in _PERIODS.items():
            if storage.exists(spark, config.table(LAYER, fact)):
                new = manifest.not_used(spark, config, name, fact).join(loads[name], "load_id", "left_semi")
                sources[fact] = _touched(bronze[name], manifest.complete_rows(spark, config, name, new), column)
    frames = curated.build_dimensions(**newest) | curated.build_facts(*sources.values())

    # Stored once: the checks and the merge see the same rows, and row rules are counted on the way.
    built, declared = Q.write_checked(
        frames, lambda t: checks_before_write(t, newest["categories"]),
        lambda name, df: storage.stage(df, config, f"{LAYER}_{name}"),
    )
    checks.add(*declared)
    checks.enforce("before write", "No merge was started.")

    stored_by = curated.stored_by()
    results = {
        name: storage.merge(df, config, LAYER, name, curated.KEYS[name], stored_by.get(name))
        for name, df in built.items()
    }
    manifest.mark_used(config, {(fact, name): loads[name] for fact, (name, _) in _PERIODS.items()})
    # Keys hold what a table is stored by, so only what was written can have a key twice.
    for name, result in results.items():
        check = "stored keys are unique"
        if result.written is None:
            checks.condition(name, check, True, "")
        else:
            checks.add(Q.unique_key(name, check, result.written, curated.KEYS[name]))
    checks.enforce("after write", "Drop the table and merge again.")
    return results
