"""Star schema, trailing-period measures and the decision table over the driver's tables."""

import datetime
import uuid
from types import SimpleNamespace

from pyspark.sql import functions as F

from tierwell.config import shared_folder
from tierwell.functions import scalars as S
from tierwell.operators import aggregates, star, storage, trailing
from tierwell.operators.joins import enrich
from workload import tables as T
from workload.registry import query

PRICE_DAYS = 14  # the events span 30 days
AS_OF = datetime.date(2001, 10, 15)
ALL_SEGMENTS = "ALL"

MUNICIPALITY_SQL = """
    SELECT n.n_nationkey,
           printf('%02d%02d', n.n_regionkey, n.n_nationkey) AS municipality_code,
           n.n_name AS municipality_name,
           printf('%02d', n.n_regionkey) AS county_code,
           r.r_name AS county_name,
           s.area AS price_area,
           r.r_name IN ('ASIA', 'EUROPE') AS price_area_is_split
    FROM nation n
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
    LEFT JOIN (VALUES ('AFRICA', 'click'), ('AMERICA', 'view'), ('ASIA', 'purchase'),
                      ('EUROPE', 'error'), ('MIDDLE EAST', 'signup')) AS s(county, area)
           ON s.county = r.r_name"""

ORDER_MONTH_SQL = """
    SELECT o.o_custkey, c.c_nationkey, c.c_mktsegment, o.o_orderpriority AS fuel,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
           CAST(year(o.o_orderdate) AS INTEGER) AS yr
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"""

REGISTRATION_SQL = f"""
    SELECT c_nationkey,
           CASE WHEN count(*) FILTER (month > edge - INTERVAL 24 MONTH) > 0
                THEN count(*) FILTER (fuel = '1-URGENT' AND month > edge - INTERVAL 12 MONTH)
           END AS ev_registrations_12m,
           CASE WHEN count(*) FILTER (month > edge - INTERVAL 24 MONTH) > 0
                THEN count(*) FILTER (fuel = '1-URGENT' AND month > edge - INTERVAL 24 MONTH
                                      AND month <= edge - INTERVAL 12 MONTH)
           END AS ev_registrations_prev_12m,
           CASE WHEN count(*) FILTER (month > edge - INTERVAL 24 MONTH) > 0
                THEN count(*) FILTER (fuel = '2-HIGH' AND month > edge - INTERVAL 12 MONTH)
           END AS phev_registrations_12m,
           CASE WHEN count(*) FILTER (month > edge - INTERVAL 24 MONTH) > 0
                THEN count(*) FILTER (month > edge - INTERVAL 12 MONTH)
           END AS total_registrations_12m,
           nullif(count(*) FILTER (fuel = '1-URGENT'), 0) AS electric_stock_estimate
    FROM (SELECT *, max(month) OVER () AS edge FROM ({ORDER_MONTH_SQL}))
    GROUP BY c_nationkey"""

CANDIDATES_SQL = f"""
WITH muni AS ({MUNICIPALITY_SQL}),
reg AS ({REGISTRATION_SQL}),
ord AS ({ORDER_MONTH_SQL}),
people AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1),
fleet AS (
    SELECT c_nationkey,
           count(*) AS cars_total,
           count(*) FILTER (c_mktsegment = 'BUILDING') AS cars_legal_entities,
           count(*) FILTER (c_mktsegment = 'MACHINERY') AS cars_taxi
    FROM ord WHERE yr = (SELECT max(yr) FROM ord) GROUP BY 1),
est AS (
    SELECT f.*, CAST(round(CAST(cars_total AS DOUBLE)
                     / nullif(CAST(round(cars_total * 1000.0 / customers) AS INTEGER), 0) * 1000) AS INTEGER)
                AS inhabitants_estimate
    FROM fleet f JOIN people p USING (c_nationkey)),
day_price AS (
    SELECT event_type, CAST(ts AS DATE) AS d, avg(value) AS p FROM events GROUP BY 1, 2),
price AS (
    SELECT event_type, round(avg(p) * 100, 2) AS avg_ore_per_kwh_12m,
           round(stddev_samp(p) * 100, 2) AS price_stddev_ore_12m
    FROM day_price WHERE d > (SELECT max(d) FROM day_price) - INTERVAL 14 DAY GROUP BY 1)
SELECT m.municipality_code, m.municipality_name, m.county_code, m.county_name, m.price_area,
       m.price_area_is_split,
       e.cars_total, e.cars_legal_entities, e.cars_taxi,
       round(e.cars_legal_entities / nullif(CAST(e.cars_total AS DOUBLE), 0), 4) AS legal_entity_share_of_fleet,
       e.inhabitants_estimate,
       r.ev_registrations_12m, r.ev_registrations_prev_12m,
       round(r.ev_registrations_12m / nullif(CAST(r.ev_registrations_prev_12m AS DOUBLE), 0) - 1, 4)
           AS ev_registration_growth,
       r.ev_registrations_12m - r.ev_registrations_prev_12m AS ev_registrations_change,
       r.phev_registrations_12m, r.total_registrations_12m,
       round(r.ev_registrations_12m / nullif(CAST(r.total_registrations_12m AS DOUBLE), 0), 4)
           AS ev_share_of_new_registrations,
       r.electric_stock_estimate,
       round(r.electric_stock_estimate / nullif(CAST(e.cars_total AS DOUBLE), 0), 4) AS electric_share_of_fleet,
       round(r.electric_stock_estimate * 1000 / nullif(CAST(e.inhabitants_estimate AS DOUBLE), 0), 1)
           AS electric_cars_per_1000_inhabitants,
       p.avg_ore_per_kwh_12m, p.price_stddev_ore_12m,
       (SELECT max(month) FROM ord) AS registrations_through_month,
       (SELECT max(yr) FROM ord) AS vehicles_as_of_year
FROM muni m
LEFT JOIN reg r ON r.c_nationkey = m.n_nationkey
LEFT JOIN est e ON e.c_nationkey = m.n_nationkey
LEFT JOIN price p ON p.event_type = m.price_area"""


def daily_event_prices(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("price_area"), F.col("ts").cast("date").alias("price_date"), "value"
    )
    return aggregates.daily_profile(events, "price_area", "price_date", "value")


def days_back(df, stamp, days):
    """The day that many days before the newest one."""
    return df.agg(F.date_sub(F.max(stamp).cast("date"), days)).scalar()


@query("candidates", CANDIDATES_SQL)
def candidates(spark, sf_dir):
    """All measures of the orders are summed per customer first: one shuffle that combines on the map
    side and leaves the sums partitioned by the key of the join with the customers."""
    orders = T.registrations(spark, sf_dir)
    month = orders.agg(F.max("registration_month")).scalar()
    year = orders.agg(F.max("year")).scalar()
    recent, both = trailing.registration_windows(orders, "registration_month")
    flagged = orders.select("*", recent.alias("recent"), both.alias("both"))
    sums = trailing.registration_sums(
        F.col("fuel_type_code"), F.col("registration_count"), F.col("recent"), F.col("both"), T.ELECTRIC, T.PLUG_IN
    )
    cars = F.sum(F.when(F.col("year") == year, F.col("registration_count"))).alias("cars")
    per_customer = flagged.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*sums, cars)

    def cars_of(segment):
        """NULL for a nation without any cars in the year, 0 when only the segment has none."""
        wanted = (F.col("c_mktsegment") == segment) & F.col("cars").isNotNull()
        return F.when(F.max("cars").isNotNull(), aggregates.sum_where("cars", wanted))

    per_nation = (
        T.table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(per_customer, "c_custkey", "left")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(
            *[F.sum(name).alias(name) for name in trailing.REGISTRATION_SUMS],
            F.sum("cars").alias("cars_total"),
            cars_of(T.LEGAL_ENTITY).alias("cars_legal_entities"),
            cars_of(T.TAXI).alias("cars_taxi"),
            F.count("*").alias("customers"),
        )
        .withColumn("per_1000", F.round(S.ratio(F.col("cars_total") * 1000, "customers")).cast("int"))
        .withColumn("inhabitants_estimate", S.estimate_from_rate("cars_total", "per_1000"))
    )
    prices = trailing.trailing_price(
        daily_event_prices(spark, sf_dir), "price_area", "price_date", "avg_sek_per_kwh",
        PRICE_DAYS, days_back(T.table(spark, sf_dir, "events"), "ts", PRICE_DAYS),
    )
    wide = enrich(T.municipalities(spark, sf_dir), (per_nation, "n_nationkey"), (prices, "price_area"))
    return star.decision_columns(wide, month, year)


@query("top_candidates", f"""
SELECT * FROM ({CANDIDATES_SQL})
ORDER BY electric_stock_estimate DESC NULLS LAST, municipality_code LIMIT 10""")
def top_candidates(spark, sf_dir):
    return aggregates.top_by(candidates(spark, sf_dir), "electric_stock_estimate", "municipality_code", 10)


@query("trailing_12m", f"""
SELECT c_nationkey, ev_registrations_12m, ev_registrations_prev_12m, phev_registrations_12m,
       total_registrations_12m, electric_stock_estimate
FROM ({REGISTRATION_SQL})""")
def trailing_12m(spark, sf_dir):
    per_customer = trailing.registration_measures(
        T.registrations(spark, sf_dir), "o_custkey", T.ELECTRIC, T.PLUG_IN
    )
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return trailing.add_up(joined, "c_nationkey", trailing.REGISTRATION_SUMS)


@query("trailing_365d", """
WITH daily AS (
    SELECT o_orderpriority AS price_area, CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS p
    FROM orders GROUP BY 1, 2)
SELECT price_area, round(avg(p) * 100, 2) AS avg_ore_per_kwh_12m,
       round(stddev_samp(p) * 100, 2) AS price_stddev_ore_12m
FROM daily WHERE d > (SELECT max(d) FROM daily) - INTERVAL 365 DAY GROUP BY 1""")
def trailing_365d(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    daily = aggregates.daily_profile(
        orders.select(F.col("o_orderpriority").alias("price_area"), day.alias("price_date"), "o_totalprice"),
        "price_area", "price_date", "o_totalprice",
    )
    after = days_back(orders, "o_orderdate", 365)
    return trailing.trailing_price(daily, "price_area", "price_date", "avg_sek_per_kwh", after=after)


@query("cumulative_stock", """
SELECT c.c_nationkey, count(*) AS electric_stock_estimate
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderpriority = '1-URGENT' GROUP BY 1""")
def cumulative_stock(spark, sf_dir):
    stock = trailing.cumulative_stock(T.registrations(spark, sf_dir), "o_custkey", T.ELECTRIC)
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = stock.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return trailing.add_up(joined, "c_nationkey", ["electric_stock_estimate"])


@query("freshness", """
SELECT *, CAST((year(today) - year(latest_registration_month)) * 12
               + month(today) - month(latest_registration_month) AS INTEGER) AS months_behind,
       CAST(year(today) - latest_vehicle_year AS INTEGER) AS years_behind,
       CAST(today - latest_price_date AS INTEGER) AS days_behind
FROM (SELECT (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders) AS latest_registration_month,
             (SELECT CAST(max(year(l_shipdate)) AS INTEGER) FROM lineitem) AS latest_vehicle_year,
             (SELECT CAST(max(ts) AS DATE) FROM events) AS latest_price_date,
             DATE '2001-10-15' AS today)""")
def freshness(spark, sf_dir):
    shipped = T.table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    priced = T.table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("price_date"))
    facts = star.freshness_facts(T.registrations(spark, sf_dir), shipped, priced, F.lit(AS_OF))
    return star.freshness_lags(facts)


def nation_star(spark, sf_dir, stage=lambda df, name: df):
    """The star schema at nation grain.

    Orders are counted per customer before the join, so a customer with very many of them
    brings one row per month and priority to it.  ``stage(df, name)`` may store what several
    tables are made of; the counts have a row per nation, month, priority and segment.
    """
    municipality = T.municipalities(spark, sf_dir)
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    counts = (
        T.registrations(spark, sf_dir)
        .groupBy(F.col("o_custkey").alias("c_custkey"), "registration_month", "year", "fuel_type_code")
        .agg(F.count("*").alias("orders"))
        .join(customer, "c_custkey")
        .groupBy("c_nationkey", "registration_month", "year", "fuel_type_code", "c_mktsegment")
        .agg(F.sum("orders").alias("orders"))
        .join(municipality.select(F.col("n_nationkey").alias("c_nationkey"), "municipality_code"), "c_nationkey")
    )
    counts = stage(counts, "counts")
    registrations = counts.groupBy("municipality_code", "registration_month", "fuel_type_code").agg(
        F.sum("orders").alias("registration_count")
    )
    category = F.explode(F.array(F.lit(ALL_SEGMENTS), "c_mktsegment")).alias("ownership_category_code")
    cars = (
        counts.select("municipality_code", "year", category, "orders")
        .groupBy("municipality_code", "year", "ownership_category_code")
        .agg(F.sum("orders").alias("vehicle_count"))
        .withColumn("reference_date", S.year_end("year"))
    )
    people = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    rate = F.round(S.ratio(F.col("vehicle_count") * 1000, "customers")).cast("int")
    inhabitants = (
        cars.where(F.col("ownership_category_code") == ALL_SEGMENTS)
        .join(municipality.select("n_nationkey", "municipality_code"), "municipality_code")
        .join(people, "n_nationkey")
        .select("municipality_code", "year", "reference_date",
                S.estimate_from_rate("vehicle_count", rate).alias("inhabitants_estimate"))
    )
    tables = {
        "dim_municipality": municipality,
        "fact_new_registrations": registrations,
        "fact_cars_in_traffic": cars,
        "fact_inhabitants": inhabitants,
        "fact_electricity_price_daily": daily_event_prices(spark, sf_dir),
    }
    return {name: star.star_view(df, name) for name, df in tables.items()}


NATION_CODES = SimpleNamespace(
    OWNERSHIP_TOTAL=ALL_SEGMENTS, OWNERSHIP_LEGAL_ENTITY=T.LEGAL_ENTITY, OWNERSHIP_TAXI=T.TAXI,
    FUEL_ELECTRIC=T.ELECTRIC, FUEL_PLUG_IN=T.PLUG_IN,
)


# A category without cars has no row in the star schema, so its count is NULL there and not 0.
@query("decision_table", f"""
SELECT * REPLACE (nullif(cars_legal_entities, 0) AS cars_legal_entities, nullif(cars_taxi, 0) AS cars_taxi,
                  CASE WHEN cars_legal_entities > 0 THEN legal_entity_share_of_fleet END
                       AS legal_entity_share_of_fleet)
FROM ({CANDIDATES_SQL})""")
def decision_table(spark, sf_dir):
    """The decision table from the star schema, as the gold job builds it: over stored facts."""
    folder = f"{shared_folder(spark)}/star/{uuid.uuid4().hex}"
    tables = nation_star(spark, sf_dir, lambda df, name: storage.write_parquet(df, f"{folder}/{name}"))
    return star.decision_table(tables, NATION_CODES, PRICE_DAYS)


@query("star_dim_municipality", f"""
SELECT municipality_code, municipality_name, county_code, county_name, price_area, price_area_is_split
FROM ({MUNICIPALITY_SQL})""")
def star_dim_municipality(spark, sf_dir):
    return star.star_view(T.municipalities(spark, sf_dir), "dim_municipality")


@query("star_fact_new_registrations", f"""
SELECT m.municipality_code, o.month AS registration_month, o.fuel AS fuel_type_code, count(*) AS registration_count
FROM ({ORDER_MONTH_SQL}) o JOIN ({MUNICIPALITY_SQL}) m ON m.n_nationkey = o.c_nationkey GROUP BY 1, 2, 3""")
def star_fact_new_registrations(spark, sf_dir):
    return nation_star(spark, sf_dir)["fact_new_registrations"]


@query("star_fact_cars_in_traffic", f"""
SELECT m.municipality_code, o.yr AS year, make_date(o.yr, 12, 31) AS reference_date,
       c.category AS ownership_category_code, count(*) AS vehicle_count
FROM ({ORDER_MONTH_SQL}) o JOIN ({MUNICIPALITY_SQL}) m ON m.n_nationkey = o.c_nationkey,
     LATERAL (SELECT 'ALL' AS category UNION ALL SELECT o.c_mktsegment) c
GROUP BY ALL""")
def star_fact_cars_in_traffic(spark, sf_dir):
    return nation_star(spark, sf_dir)["fact_cars_in_traffic"]


@query("star_fact_inhabitants", f"""
SELECT m.municipality_code, o.yr AS year, make_date(o.yr, 12, 31) AS reference_date,
       CAST(round(CAST(cars AS DOUBLE) / nullif(CAST(round(cars * 1000.0 / customers) AS INTEGER), 0) * 1000)
            AS INTEGER) AS inhabitants_estimate
FROM (SELECT c_nationkey, yr, count(*) AS cars FROM ({ORDER_MONTH_SQL}) GROUP BY 1, 2) o
JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) p USING (c_nationkey)
JOIN ({MUNICIPALITY_SQL}) m ON m.n_nationkey = o.c_nationkey""")
def star_fact_inhabitants(spark, sf_dir):
    return nation_star(spark, sf_dir)["fact_inhabitants"]


@query("star_fact_electricity_price_daily", """
SELECT event_type AS price_area, CAST(ts AS DATE) AS price_date, round(avg(value), 6) AS avg_sek_per_kwh,
       min(value) AS min_sek_per_kwh, max(value) AS max_sek_per_kwh,
       CASE WHEN count(*) > 30 THEN 15 ELSE 60 END AS resolution_minutes
FROM events GROUP BY 1, 2""")
def star_fact_electricity_price_daily(spark, sf_dir):
    daily = nation_star(spark, sf_dir)["fact_electricity_price_daily"]
    return daily.withColumn("avg_sek_per_kwh", F.round("avg_sek_per_kwh", 6))
