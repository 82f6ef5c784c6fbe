"""Silver to gold: rebuild the star schema and the decision table, check, then release them all at once."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.config import RunConfig
from tierwell.functions import codes as C
from tierwell.operators import quality as Q, release, star, storage
from tierwell.operators.aggregates import top_by

LAYER = "gold"
REQUIRED = ("cars_total", "inhabitants_estimate", "ev_registrations_12m", "avg_ore_per_kwh_12m")


def views(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    """The star schema as lazy projections of the stored silver tables, also as temporary views."""
    frames = {
        name: star.star_view(spark.table(config.table("silver", source)), name)
        for name, (source, _) in star.STAR_TABLES.items()
    }
    frames[star.CANDIDATES] = star.decision_table(frames, C)
    return register(frames)


def register(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames, also as temporary views of their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def checks_before_write(t: dict[str, DataFrame], today) -> list[Q.Check]:
    candidates = t[star.CANDIDATES]
    lags = star.freshness_lags(star.freshness_facts(
        t["fact_new_registrations"], t["fact_cars_in_traffic"], t["fact_electricity_price_daily"], today
    ))
    return [
        Q.expect_count(star.CANDIDATES, f"{C.MUNICIPALITY_COUNT} rows", candidates, C.MUNICIPALITY_COUNT),
        Q.unique_key(star.CANDIDATES, "municipalities are unique", candidates, ["municipality_code"]),
        Q.not_null(star.CANDIDATES, "the required measures are present", candidates, REQUIRED,
                   show=("municipality_code", "municipality_name", *REQUIRED)),
        Q.row_rule(star.CANDIDATES, "the electric share is at most the whole fleet", candidates,
                   F.col("electric_share_of_fleet") > 1, Q.WARNING,
                   show=("municipality_name", "electric_share_of_fleet", "legal_entity_share_of_fleet")),
        Q.freshness("fact_new_registrations", "registrations are recent", lags, "months_behind", C.MAX_MONTHS_BEHIND),
        Q.freshness("fact_cars_in_traffic", "cars in traffic are recent", lags, "years_behind", C.MAX_YEARS_BEHIND),
        Q.freshness("fact_electricity_price_daily", "prices are recent", lags, "days_behind", C.MAX_DAYS_BEHIND),
    ]


def run(spark: SparkSession, config: RunConfig) -> dict[str, int]:
    """Row count per table.  New versions are written first; readers are switched to all of them after the checks."""
    storage.create_schemas(spark, config, LAYER, "ops")
    checks = Q.QualityChecks(spark, config.results_table, config.run_id, LAYER)
    new = release.Release(spark, config, LAYER)
    written = {name: new.write(name, df) for name, df in views(spark, config).items()}
    checks.add(*checks_before_write(written, config.today()))
    checks.enforce("before write", "The new versions stay unused.")
    counts = new.commit()
    release.keep_last(spark, config, LAYER, config.keep_releases)
    return counts


def top_candidates(spark: SparkSession, config: RunConfig, rows: int = 25) -> DataFrame:
    """The decision table's head: the largest electric stocks."""
    return top_by(spark.table(config.table(LAYER, star.CANDIDATES)), "electric_stock_estimate", "municipality_code", rows)
