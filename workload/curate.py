"""Typing, grain, deduplication and aggregation over the driver's tables."""

from pyspark.sql import functions as F

from tierwell.functions import scalars as S
from tierwell.operators import aggregates, dedup, star
from tierwell.operators.joins import seed_frame
from tierwell.plans import curated
from workload import tables as T
from workload.registry import query

# County (nation number as text) -> price area, a maintained seed.  Two nations are left out
# on purpose: a county without an area keeps a NULL, which the checks then report.
NATION_AREA = {f"{n:02d}": ("click", "view", "purchase", "error", "signup")[n // 5] for n in range(23)}
SPLIT_NATIONS = ("03", "11", "17")
# Code 0000000007 plays the discontinued region.
WIDE_GRAIN = curated.RegionGrain(detail=10, county=2, retired=("0000000007",))
STATUS_COUNTS = ("F", "O")

REGISTRATION_BRONZE_SQL = """
    SELECT printf('%010d', o_custkey) AS region, substr(o_orderpriority, 1, 1) AS fuel,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(trunc(o_totalprice) AS INTEGER) AS amount, o_orderdate AS loaded
    FROM orders"""

CAR_BRONZE_SQL = """
    SELECT printf('%010d', o_custkey) AS region, o_orderstatus AS category,
           CAST(year(o_orderdate) AS INTEGER) AS yr,
           CAST(trunc(o_totalprice) AS INTEGER) AS amount, o_orderdate AS loaded
    FROM orders"""

STOCK_SQL = f"""
    SELECT region AS municipality_code, yr AS year, make_date(yr, 12, 31) AS reference_date,
           category AS ownership_category_code, amount AS vehicle_count
    FROM ({CAR_BRONZE_SQL})
    WHERE category IN ('F', 'O') AND region <> '0000000007'
    QUALIFY row_number() OVER (PARTITION BY region, yr, category ORDER BY loaded DESC, amount DESC) = 1"""


def registration_bronze(spark, sf_dir):
    """Orders in the shape of the registration cube: codes and values as text."""
    date = F.col("o_orderdate").cast("date")
    return T.table(spark, sf_dir, "orders").select(
        F.format_string("%010d", "o_custkey").alias("Region"),
        F.substring("o_orderpriority", 1, 1).alias("Drivmedel"),
        F.substring("o_orderpriority", 3, 20).alias("Drivmedel_label"),
        S.period_of_month(date).alias("Tid"),
        F.col("o_totalprice").cast("int").cast("string").alias("value"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


def car_bronze(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").select(
        F.format_string("%010d", "o_custkey").alias("Region"),
        F.col("o_orderstatus").alias("Agarkategori"),
        F.concat(F.lit("status "), "o_orderstatus").alias("Agarkategori_label"),
        F.year("o_orderdate").cast("string").alias("Tid"),
        F.col("o_totalprice").cast("int").cast("string").alias("value"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


@query("keep_newest", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def keep_newest(spark, sf_dir):
    return dedup.keep_newest(T.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("deduplicate", """
SELECT user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC, props DESC) = 1""")
def deduplicate(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").drop("event_id").withColumnRenamed("ts", "_ingested_at")
    return dedup.deduplicate(events, ["user_id", "event_type"])


@query("latest_labels", """
SELECT o_custkey AS code, o_orderpriority AS label FROM orders
QUALIFY row_number() OVER (
    PARTITION BY o_custkey
    ORDER BY strftime(o_orderdate, '%YM%m') DESC, o_orderdate DESC, o_orderpriority DESC) = 1""")
def latest_labels(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders").withColumn("Tid", S.period_of_month(F.col("o_orderdate")))
    return dedup.latest_labels(orders, "o_custkey", "o_orderpriority", version="o_orderdate")


@query("dimension_enrich", """
SELECT printf('%02d%08d', c.c_nationkey, c.c_custkey) AS municipality_code, c.c_name AS municipality_name,
       printf('%02d', c.c_nationkey) AS county_code, n.n_name AS county_name,
       CASE WHEN c.c_nationkey < 5 THEN 'click' WHEN c.c_nationkey < 10 THEN 'view'
            WHEN c.c_nationkey < 15 THEN 'purchase' WHEN c.c_nationkey < 20 THEN 'error'
            WHEN c.c_nationkey < 23 THEN 'signup' END AS price_area,
       c.c_nationkey IN (3, 11, 17) AS price_area_is_split
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE printf('%02d%08d', c.c_nationkey, c.c_custkey) <> '0000000007'""")
def dimension_enrich(spark, sf_dir):
    """Customers are the detail regions and nations the county rows of one label table."""
    customers = T.table(spark, sf_dir, "customer").select(
        F.format_string("%02d%08d", "c_nationkey", "c_custkey").alias("code"), F.col("c_name").alias("label")
    )
    nations = T.table(spark, sf_dir, "nation").select(
        F.format_string("%02d", "n_nationkey").alias("code"), F.col("n_name").alias("label")
    )
    areas = seed_frame(spark, NATION_AREA, "county_code", "price_area")
    return curated.municipality(customers.unionByName(nations), areas, SPLIT_NATIONS, WIDE_GRAIN)


@query("fuel_types", """
SELECT substr(o_orderpriority, 1, 1) AS fuel_type_code, max(substr(o_orderpriority, 3)) AS fuel_type_name,
       substr(o_orderpriority, 1, 1) IN ('1', '2') AS is_electrified
FROM orders GROUP BY 1, 3""")
def fuel_types(spark, sf_dir):
    return curated.fuel_type(registration_bronze(spark, sf_dir), ("1", "2"))


@query("ownership_categories", """
SELECT DISTINCT o_orderstatus AS ownership_category_code, 'status ' || o_orderstatus AS ownership_category_name
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def ownership_categories(spark, sf_dir):
    return curated.ownership_category(car_bronze(spark, sf_dir), STATUS_COUNTS)


@query("fact_monthly", f"""
SELECT region AS municipality_code, month AS registration_month, fuel AS fuel_type_code,
       amount AS registration_count
FROM ({REGISTRATION_BRONZE_SQL})
WHERE region <> '0000000007'
QUALIFY row_number() OVER (PARTITION BY region, month, fuel ORDER BY loaded DESC, amount DESC) = 1""")
def fact_monthly(spark, sf_dir):
    return curated.new_registrations(registration_bronze(spark, sf_dir), WIDE_GRAIN)


@query("stock_yearly", STOCK_SQL)
def stock_yearly(spark, sf_dir):
    return curated.cars_in_traffic(car_bronze(spark, sf_dir), STATUS_COUNTS, WIDE_GRAIN).select(
        "municipality_code", "year", "reference_date", "ownership_category_code", "vehicle_count"
    )


@query("ratio_estimate", f"""
SELECT municipality_code, year, reference_date, rate AS cars_per_1000_inhabitants,
       CAST(round(CAST(total AS DOUBLE) / nullif(rate, 0) * 1000) AS INTEGER) AS inhabitants_estimate
FROM (SELECT municipality_code, year, reference_date,
             max(amount) FILTER (category = 'F') AS total, max(amount) FILTER (category = 'O') AS rate
      FROM (SELECT region AS municipality_code, yr AS year, make_date(yr, 12, 31) AS reference_date,
                   category, amount
            FROM ({CAR_BRONZE_SQL}) WHERE region <> '0000000007'
            QUALIFY row_number() OVER (PARTITION BY region, yr, category
                                       ORDER BY loaded DESC, amount DESC) = 1)
      GROUP BY ALL)""")
def ratio_estimate(spark, sf_dir):
    return curated.inhabitants(car_bronze(spark, sf_dir), "F", "O", WIDE_GRAIN)


@query("daily_rollup", """
SELECT event_type AS price_area, CAST(ts AS DATE) AS price_date,
       round(avg(value), 6) AS avg_sek_per_kwh, min(value) AS min_sek_per_kwh, max(value) AS max_sek_per_kwh,
       CAST(count(*) AS INTEGER) AS period_count,
       CASE WHEN count(*) > 30 THEN 15 ELSE 60 END AS resolution_minutes
FROM (SELECT * FROM events
      QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                                 ORDER BY ts DESC, printf('%012d', event_id) DESC, value DESC) = 1)
GROUP BY 1, 2""")
def daily_rollup(spark, sf_dir):
    """Events as price rows, one period per hour and type: later events of the hour correct the earlier ones."""
    bronze = T.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("elomrade"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("time_start"),
        F.col("value").cast("string").alias("SEK_per_kWh"),
        F.col("ts").alias("_ingested_at"),
        F.format_string("%012d", "event_id").alias("_source_file"),
    )
    daily = curated.electricity_prices_daily(bronze)
    return daily.withColumn("avg_sek_per_kwh", F.round("avg_sek_per_kwh", 6))


@query("pivot_wide", f"""
SELECT municipality_code, year, max(vehicle_count) FILTER (ownership_category_code = 'F') AS filled,
       max(vehicle_count) FILTER (ownership_category_code = 'O') AS open
FROM ({STOCK_SQL}) GROUP BY 1, 2""")
def pivot_wide(spark, sf_dir):
    return aggregates.wide_by_code(
        stock_yearly(spark, sf_dir), ["municipality_code", "year"], "ownership_category_code", "vehicle_count",
        {"filled": "F", "open": "O"},
    )


@query("coverage_profile", """
SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS file_count, count(*) AS row_count,
       min(ts) AS earliest, max(ts) AS latest
FROM events GROUP BY 1 ORDER BY 1""")
def coverage_profile(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return aggregates.coverage_profile(events, "event_type", "day", "ts")


@query("event_props", """
SELECT event_type, count(*) AS row_count, CAST(sum(CAST(props->>'$.k' AS INTEGER)) AS BIGINT) AS k_sum,
       min(CAST(props->>'$.k' AS INTEGER)) AS k_min, max(CAST(props->>'$.k' AS INTEGER)) AS k_max
FROM events GROUP BY 1""")
def event_props(spark, sf_dir):
    k = F.from_json("props", "k int").getField("k").alias("k")
    return T.table(spark, sf_dir, "events").select("event_type", k).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.sum("k").alias("k_sum"), F.min("k").alias("k_min"), F.max("k").alias("k_max")
    )


@query("scalar_functions", """
SELECT o_orderkey,
       strftime(o_orderdate, '%YM%m') AS period,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS parsed_month,
       CAST(year(o_orderdate) AS INTEGER) AS period_year,
       make_date(year(o_orderdate), 12, 31) AS year_end,
       CAST(o_orderdate AS DATE) AS local_day,
       TRY_CAST(o_orderstatus AS INTEGER) AS bad_int,
       o_totalprice AS price,
       o_totalprice / nullif(CAST(o_custkey AS DOUBLE), 0) AS price_per_key,
       round(o_totalprice / 7.0 - 1, 4) AS price_growth,
       round(o_custkey * 1000 / nullif(o_totalprice, 0), 1) AS per_1000,
       CASE WHEN day(o_orderdate) > 30 THEN 15 ELSE 60 END AS resolution,
       CAST((2001 - year(o_orderdate)) * 12 + 10 - month(o_orderdate) AS INTEGER) AS months_behind,
       CAST(2001 - year(o_orderdate) AS INTEGER) AS years_behind,
       length(o_orderpriority) = 6 AS at_grain,
       nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(o_orderstatus, 'F') AS status_differs,
       CAST(o_orderdate - INTERVAL 365 DAY AS DATE) AS year_before,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS twelve_months_before,
       strftime(o_orderdate, '%m-%d') || '_' || o_orderstatus || '.json' AS file_name
FROM orders""")
def scalar_functions(spark, sf_dir):
    """Every shared column expression over each order."""
    day = F.col("o_orderdate").cast("date")
    period = S.period_of_month(day)
    as_of = F.lit("2001-10-15").cast("date")
    status = F.col("o_orderstatus")
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        period.alias("period"),
        S.month_of_period(period).alias("parsed_month"),
        S.year_of_period(period).alias("period_year"),
        S.year_end(S.year_of_period(period)).alias("year_end"),
        S.local_date(F.date_format(day, "yyyy-MM-dd'T00:00:00+02:00'")).alias("local_day"),
        S.as_int("o_orderstatus").alias("bad_int"),
        S.as_double(F.col("o_totalprice").cast("string")).alias("price"),
        S.ratio("o_totalprice", "o_custkey").alias("price_per_key"),
        S.growth("o_totalprice", F.lit(7.0)).alias("price_growth"),
        S.per_thousand("o_custkey", "o_totalprice").alias("per_1000"),
        S.resolution_minutes(F.dayofmonth(day)).alias("resolution"),
        S.months_between_calendar(as_of, day).alias("months_behind"),
        S.years_between_calendar(as_of, F.year(day)).alias("years_behind"),
        S.at_grain("o_orderpriority", 6).alias("at_grain"),
        S.differs(F.nullif(status, F.lit("P")), F.nullif(status, F.lit("F"))).alias("status_differs"),
        F.date_sub(day, 365).alias("year_before"),
        F.add_months(day, -12).alias("twelve_months_before"),
        F.concat(F.date_format(day, "MM-dd"), F.lit("_"), status, F.lit(".json")).alias("file_name"),
    )


@query("star_dim_fuel_type", """
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS fuel_type_code, substr(o_orderpriority, 3) AS fuel_type_name,
       substr(o_orderpriority, 1, 1) IN ('1', '2') AS is_electrified
FROM orders""")
def star_dim_fuel_type(spark, sf_dir):
    return star.star_view(fuel_types(spark, sf_dir), "dim_fuel_type")


@query("star_dim_ownership_category", """
SELECT DISTINCT o_orderstatus AS ownership_category_code, 'status ' || o_orderstatus AS ownership_category_name
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def star_dim_ownership_category(spark, sf_dir):
    return star.star_view(ownership_categories(spark, sf_dir), "dim_ownership_category")
