"""Quality checks, grids and calendars over the driver's tables."""

from pyspark.sql import functions as F

from tierwell.operators import aggregates, joins, quality, storage
from tierwell.sources import calendar
from workload import mart, tables as T
from workload.merge import scratch_config
from workload.registry import ORACLES, query

EVENT_TYPES = ("click", "view", "purchase", "error", "signup", "refund")
ALLOWED_VALUE = 120.0
BIG_VALUE, LANDED_VALUE = 220.0, 180.0

WIDE_SQL = """
    SELECT o_custkey AS municipality_code, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS filled,
           nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS open,
           nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS partial
    FROM orders GROUP BY 1, 2"""


def order_days(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day")
    )


def orders_by_status(spark, sf_dir):
    """Orders per customer and year, in total and per status; a status without orders is NULL."""
    orders = T.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("municipality_code"), F.year("o_orderdate").alias("year"), "o_orderstatus"
    )

    def count_of(status):
        return F.sum(F.when(F.col("o_orderstatus") == status, F.lit(1)))

    return orders.groupBy("municipality_code", "year").agg(
        F.count("*").alias("total"), count_of("F").alias("filled"),
        count_of("O").alias("open"), count_of("P").alias("partial"),
    )


@query("orphan_keys", """
SELECT DISTINCT l_orderkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def orphan_keys(spark, sf_dir):
    """Line items against a dimension that lacks the partial orders."""
    dimension = T.table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    dimension = dimension.select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.orphan_keys(T.table(spark, sf_dir, "lineitem"), dimension, "l_orderkey")


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(T.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("complete_grid", """
SELECT *, statuses * priorities * days AS expected_rows, row_count = statuses * priorities * days AS is_complete
FROM (SELECT count(*) AS row_count, count(DISTINCT o_orderstatus) AS statuses,
             count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT day) AS days
      FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders))""")
def complete_grid(spark, sf_dir):
    axes = {"statuses": "o_orderstatus", "priorities": "o_orderpriority", "days": "day"}
    return aggregates.grid_profile(order_days(spark, sf_dir).distinct(), axes)


@query("missing_cells", """
SELECT s.o_orderstatus, p.o_orderpriority, d.day
FROM (SELECT DISTINCT o_orderstatus FROM orders) s
CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
CROSS JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) d
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = s.o_orderstatus
                  AND o.o_orderpriority = p.o_orderpriority AND CAST(o.o_orderdate AS DATE) = d.day)""")
def missing_cells(spark, sf_dir):
    """The cells an incomplete grid lacks; only those are ever emitted."""
    days = order_days(spark, sf_dir)
    priorities = joins.distinct_array(days, "o_orderpriority")
    pairs = days.select("o_orderstatus").distinct().select(
        "o_orderstatus", F.explode(priorities).alias("o_orderpriority")
    )
    keys = ["o_orderstatus", "o_orderpriority"]
    return joins.missing_members(days, pairs, keys, "day", joins.distinct_array(days, "day"))


@query("calendar_gaps", f"""
WITH span AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) - 2 AS last FROM events),
landed AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events WHERE value > {BIG_VALUE})
SELECT a.area AS price_area, CAST(d.day AS DATE) AS price_date
FROM (VALUES ('click'), ('view'), ('purchase'), ('error'), ('signup'), ('refund')) AS a(area)
CROSS JOIN (SELECT unnest(generate_series(first, last, INTERVAL 1 DAY)) AS day FROM span) d
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.event_type = a.area AND l.day = CAST(d.day AS DATE))
  AND NOT (a.area = 'refund' AND CAST(d.day AS DATE) = DATE '2024-01-05')""")
def calendar_gaps(spark, sf_dir):
    """A day counts as landed when it has a large event; refunds never land, one such day is accepted."""
    events = T.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("price_area"), F.col("ts").cast("date").alias("price_date"), "value"
    )
    accepted = spark.createDataFrame([("refund", "2024-01-05")], "price_area string, day string").select(
        "price_area", F.to_date("day").alias("price_date")
    )
    first = events.agg(F.min("price_date")).scalar()
    last = events.agg(F.max("price_date")).scalar()
    landed = events.where(F.col("value") > BIG_VALUE)
    return calendar.missing_days(landed, calendar.area_frame(spark, EVENT_TYPES), first, last, 2, accepted)


@query("status_tally", f"""
WITH days AS (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events),
                                            (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY)) AS day),
best AS (SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS v FROM events GROUP BY 1, 2)
SELECT CASE WHEN v > {BIG_VALUE} THEN 'skipped' WHEN v > {LANDED_VALUE} THEN 'fetched' ELSE 'missing' END AS status,
       count(*) AS days
FROM (VALUES ('click'), ('view'), ('purchase'), ('error'), ('signup'), ('refund')) AS a(area)
CROSS JOIN days d LEFT JOIN best b ON b.event_type = a.area AND b.day = CAST(d.day AS DATE)
GROUP BY 1""")
def status_tally(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("price_area"), F.col("ts").cast("date").alias("price_date"), "value"
    )
    days = calendar.calendar(events.agg(F.min("price_date")).scalar(), events.agg(F.max("price_date")).scalar())
    expected = calendar.expected_days(calendar.area_frame(spark, EVENT_TYPES), days)
    statuses = calendar.landing_status(
        expected, events.where(F.col("value") > BIG_VALUE), events.where(F.col("value") > LANDED_VALUE),
        ["price_area", "price_date"],
    )
    return calendar.status_tally(statuses)


@query("period_worklist", """
SELECT DISTINCT strftime(l_shipdate, '%YM%m') AS period FROM lineitem
WHERE year(l_shipdate) >= 1996
  AND strftime(l_shipdate, '%YM%m') NOT IN (SELECT strftime(o_orderdate, '%YM%m') FROM orders)""")
def period_worklist(spark, sf_dir):
    """Ship months are the published periods, order months the landed ones."""
    published = T.table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy'M'MM").alias("period")).distinct()
    landed = T.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy'M'MM").alias("period")).distinct()
    return calendar.period_worklist(published, landed, 1996)


@query("sum_identity", f"SELECT * FROM ({WIDE_SQL}) WHERE total <> filled + open")
def sum_identity(spark, sf_dir):
    """Rows whose total is not filled + open; where one of the two is NULL the row passes."""
    wide = orders_by_status(spark, sf_dir)
    return quality.sum_identity("stock", "total = parts", wide, "total", ["filled", "open"]).offending()


@query("parts_present", f"SELECT * FROM ({WIDE_SQL}) WHERE filled IS NULL OR open IS NULL")
def parts_present(spark, sf_dir):
    wide = orders_by_status(spark, sf_dir)
    return quality.parts_present("stock", "parts are there", wide, ["filled", "open"]).offending()


@query("unknown_codes", """
SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""")
def unknown_codes(spark, sf_dir):
    lineitem = T.table(spark, sf_dir, "lineitem")
    return quality.known_codes("lineitem", "flags are known", lineitem, "l_returnflag", "l_linestatus",
                               ["A", "N"]).offending()


@query("row_rules", f"""
SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders
WHERE o_totalprice NOT BETWEEN 1000 AND 450000 OR o_orderstatus NOT IN ('F', 'O')
   OR nullif(o_orderpriority, '5-LOW') IS NULL""")
def row_rules(spark, sf_dir):
    """The offending rows of three rules over one table."""
    orders = T.table(spark, sf_dir, "orders").withColumn("urgency", F.nullif("o_orderpriority", F.lit("5-LOW")))
    rules = (
        quality.between("orders", "price is plausible", orders, "o_totalprice", 1000, 450000),
        quality.in_set("orders", "status is known", orders, "o_orderstatus", ["F", "O"]),
        quality.not_null("orders", "urgency is set", orders, ["urgency"]),
    )
    bad = F.lit(False)
    for rule in rules:
        bad = bad | rule.bad
    return orders.where(bad).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")


def order_checks(spark, sf_dir):
    """One check of every kind, over whole tables."""
    orders = T.table(spark, sf_dir, "orders").withColumn("urgency", F.nullif("o_orderpriority", F.lit("5-LOW")))
    lineitem, events = T.table(spark, sf_dir, "lineitem"), T.table(spark, sf_dir, "events")
    partial_free = orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    wide = orders_by_status(spark, sf_dir)
    lags = mart.freshness(spark, sf_dir)
    nations = T.table(spark, sf_dir, "nation")
    return [
        quality.expect_count("nation", "25 nations", nations, 25),
        quality.expect_count("nation", "24 nations", nations, 24, quality.WARNING),
        quality.not_null("orders", "customer and date are set", orders, ["o_custkey", "o_orderdate"]),
        quality.not_null("orders", "urgency is set", orders, ["urgency"], quality.WARNING),
        quality.between("orders", "price is plausible", orders, "o_totalprice", 1000, 450000),
        quality.in_set("orders", "status is known", orders, "o_orderstatus", ["F", "O"]),
        quality.row_rule("orders", "no negative price", orders, F.col("o_totalprice") < 0),
        quality.row_rule("events", "no value above the limit", events, F.col("value") > ALLOWED_VALUE),
        quality.foreign_key("lineitem", "order exists", lineitem, partial_free, "l_orderkey"),
        quality.unique_key("lineitem", "key is unique", lineitem, ["l_orderkey", "l_linenumber"]),
        quality.known_codes("lineitem", "flags are known", lineitem, "l_returnflag", "l_linestatus", ["A", "N"],
                            quality.WARNING),
        quality.sum_identity("stock", "total is filled plus open", wide, "total", ["filled", "open"]),
        quality.parts_present("stock", "filled and open are there", wide, ["filled", "open"]),
        quality.complete_grid("orders", "every status and priority every day", complete_grid(spark, sf_dir)),
        quality.calendar_complete("events", "no day is missing", calendar_gaps(spark, sf_dir)),
        quality.freshness("orders", "at most 4 months old", lags, "months_behind", 4),
        quality.freshness("events", "at most 3 days old", lags, "days_behind", 3),
    ]


CHECK_COUNTS_SQL = f"""
    SELECT 'nation' AS table_name, '25 nations' AS check_name, 'error' AS severity,
           (SELECT CAST(count(*) <> 25 AS BIGINT) FROM nation) AS failed_rows
    UNION ALL SELECT 'nation', '24 nations', 'warning', (SELECT CAST(count(*) <> 24 AS BIGINT) FROM nation)
    UNION ALL SELECT 'orders', 'customer and date are set', 'error',
        (SELECT count(*) FROM orders WHERE o_custkey IS NULL OR o_orderdate IS NULL)
    UNION ALL SELECT 'orders', 'urgency is set', 'warning',
        (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW')
    UNION ALL SELECT 'orders', 'price is plausible', 'error',
        (SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 450000)
    UNION ALL SELECT 'orders', 'status is known', 'error',
        (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
    UNION ALL SELECT 'orders', 'no negative price', 'error', (SELECT count(*) FROM orders WHERE o_totalprice < 0)
    UNION ALL SELECT 'events', 'no value above the limit', 'error',
        (SELECT count(*) FROM events WHERE value > {ALLOWED_VALUE})
    UNION ALL SELECT 'lineitem', 'order exists', 'error',
        (SELECT count(DISTINCT l_orderkey) FROM lineitem
         WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
    UNION ALL SELECT 'lineitem', 'key is unique', 'error',
        (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    UNION ALL SELECT 'lineitem', 'flags are known', 'warning',
        (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem
                               WHERE l_returnflag NOT IN ('A', 'N')))
    UNION ALL SELECT 'stock', 'total is filled plus open', 'error',
        (SELECT count(*) FROM ({WIDE_SQL}) WHERE total <> filled + open)
    UNION ALL SELECT 'stock', 'filled and open are there', 'warning',
        (SELECT count(*) FROM ({WIDE_SQL}) WHERE filled IS NULL OR open IS NULL)
    UNION ALL SELECT 'orders', 'every status and priority every day', 'error',
        (SELECT CAST(count(*) <> count(DISTINCT s) * count(DISTINCT p) * count(DISTINCT d) AS BIGINT)
         FROM (SELECT DISTINCT o_orderstatus AS s, o_orderpriority AS p, o_orderdate AS d FROM orders))
    UNION ALL SELECT 'events', 'no day is missing', 'error',
        (SELECT count(*) FROM ({{gaps}}))
    UNION ALL SELECT 'orders', 'at most 4 months old', 'error',
        (SELECT CAST((2001 - year(max(o_orderdate))) * 12 + 10 - month(max(o_orderdate)) > 4 AS BIGINT) FROM orders)
    UNION ALL SELECT 'events', 'at most 3 days old', 'error',
        (SELECT CAST(DATE '2001-10-15' - CAST(max(ts) AS DATE) > 3 AS BIGINT) FROM events)"""


@query("check_summary", f"""
SELECT *, failed_rows = 0 AS passed,
       CASE WHEN failed_rows = 0 THEN 'OK' WHEN severity = 'error' THEN 'FAIL' ELSE 'WARN' END AS status
FROM ({CHECK_COUNTS_SQL.format(gaps=ORACLES["calendar_gaps"])})""")
def check_summary(spark, sf_dir):
    return quality.summary(spark, order_checks(spark, sf_dir))


@query("quality_log", f"""
SELECT 'orders' AS layer, 'before write' AS stage, table_name, check_name, severity, failed_rows = 0 AS passed,
       failed_rows, failed_rows > 0 AS has_sample
FROM ({CHECK_COUNTS_SQL.format(gaps=ORACLES["calendar_gaps"])})""")
def quality_log(spark, sf_dir):
    """All results of a stage, as they are appended to the log before the stage is stopped."""
    config = scratch_config(spark)
    storage.create_schemas(spark, config, "ops")
    log = quality.QualityChecks(spark, config.results_table, config.version, "orders")
    log.add(*order_checks(spark, sf_dir))
    try:
        log.enforce("before write", "Nothing was written.")
    except quality.QualityError:
        pass  # expected: some of the checks fail on these tables
    return quality.history(spark, config.results_table, config.version).select(
        "layer", "stage", "table_name", "check_name", "severity", "passed", "failed_rows",
        F.col("sample").isNotNull().alias("has_sample"),
    )


@query("quality_facts", """
SELECT 'orphans' AS check_name, 'warning' AS severity, count(*) = 0 AS passed, count(*) AS failed_rows
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))
UNION ALL SELECT 'there are orders', 'error', count(*) > 0, CAST(0 AS BIGINT) FROM orders
UNION ALL SELECT 'there are no orders', 'warning', count(*) = 0, CAST(count(*) > 0 AS BIGINT) FROM orders""")
def quality_facts(spark, sf_dir):
    """Checks declared the short ways: offending rows as they are, and facts that the caller already knows."""
    config = scratch_config(spark)
    storage.create_schemas(spark, config, "ops")
    orders, customers = T.table(spark, sf_dir, "orders"), T.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    empty = orders.isEmpty()
    log = quality.QualityChecks(spark, config.results_table, config.version, "orders")
    log.rows("orders", "orphans", joins.orphan_keys(
        orders, customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"), quality.WARNING)
    log.condition("orders", "there are orders", not empty, "the table is empty")
    log.condition("orders", "there are no orders", empty, "the table has rows", quality.WARNING)
    log.enforce("before write", "Nothing was written.")
    return quality.history(spark, config.results_table, config.version).select("check_name", "severity", "passed", "failed_rows")


@query("sample_json", """
SELECT '[' || string_agg(CAST(to_json({o_orderkey: o_orderkey, o_orderstatus: o_orderstatus,
                                       urgency: urgency, day: day}) AS VARCHAR), ',' ORDER BY o_orderkey) || ']' AS sample
FROM (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS urgency,
             strftime(o_orderdate, '%Y-%m-%d') AS day
      FROM orders WHERE o_orderpriority = '5-LOW' ORDER BY o_orderkey LIMIT 5)""")
def sample_json(spark, sf_dir):
    """The logged sample of a failed rule: five rows as JSON, dates as text, NULLs kept."""
    orders = T.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("urgency"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return quality.sample_json(quality.not_null("orders", "urgency is set", orders, ["urgency"]).offending())
