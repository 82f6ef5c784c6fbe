"""The driver's tables, read as the layers of this package.

nation = municipality, region = county, order priority = fuel type, market segment =
ownership category, order month = registration month, event type = price area and event
value = price.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.functions import scalars as S
from tierwell.operators.joins import seed_frame

# Region name -> price area (event type): the maintained seed of the analogy.
REGION_AREA = {"AFRICA": "click", "AMERICA": "view", "ASIA": "purchase", "EUROPE": "error", "MIDDLE EAST": "signup"}
SPLIT_REGIONS = ("ASIA", "EUROPE")
FUELS = {"1-URGENT": "Urgent", "2-HIGH": "High"}
ELECTRIC, PLUG_IN = "1-URGENT", "2-HIGH"
LEGAL_ENTITY, TAXI = "BUILDING", "MACHINERY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def municipalities(spark, sf_dir) -> DataFrame:
    """Nation with its region and price area, in the columns of the municipality dimension."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    areas = seed_frame(spark, REGION_AREA, "county_name", "price_area")
    code = F.format_string("%02d%02d", F.col("n_regionkey"), F.col("n_nationkey"))
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .withColumn("county_name", F.col("r_name"))
        .join(areas, "county_name", "left")
        .select(
            "n_nationkey",
            code.alias("municipality_code"),
            F.col("n_name").alias("municipality_name"),
            F.substring(code, 1, 2).alias("county_code"),
            "county_name",
            "price_area",
            F.col("county_name").isin(*SPLIT_REGIONS).alias("price_area_is_split"),
        )
    )


def registrations(spark, sf_dir) -> DataFrame:
    """Orders as registrations at customer grain: one car per order."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        S.month_start(F.col("o_orderdate").cast("date")).alias("registration_month"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("fuel_type_code"),
        F.lit(1).alias("registration_count"),
    )
