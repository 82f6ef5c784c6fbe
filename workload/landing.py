"""Landed documents derived from the driver's tables, written and read back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwell.config import RunConfig, shared_folder
from tierwell.operators import storage
from tierwell.functions import codes as C
from tierwell.operators.quality import QualityError, declared_size
from tierwell.plans import bronze, labels
from tierwell.sources import cube, landing, manifest
from workload import tables as T
from workload.registry import query

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
YEARS = tuple(range(1995, 2002))
DIMENSIONS = ("Region", "Drivmedel", "ContentsCode", "Tid")

CUBE_SQL = """
    SELECT 'cube_' || c.o_custkey || '.json' AS _source_file,
           printf('%010d', c.o_custkey) AS "Region", 'Customer ' || c.o_custkey AS "Region_label",
           p.code AS "Drivmedel", p.label AS "Drivmedel_label", 'ORDERS' AS "ContentsCode",
           CAST(y.yr AS VARCHAR) AS "Tid", CAST(n.orders AS VARCHAR) AS value
    FROM (SELECT DISTINCT o_custkey FROM orders) c
    CROSS JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS code, substr(o_orderpriority, 3) AS label
                FROM orders) p
    CROSS JOIN (SELECT unnest(range(1995, 2002)) AS yr) y
    LEFT JOIN (SELECT o_custkey, substr(o_orderpriority, 1, 1) AS code, year(o_orderdate) AS yr,
                      count(*) AS orders
               FROM orders GROUP BY 1, 2, 3) n
           ON n.o_custkey = c.o_custkey AND n.code = p.code AND n.yr = y.yr"""


def cube_documents(spark, sf_dir):
    """One cube document per customer: orders by priority and year.

    A document with less than half of its cells is written in object form (sparse values,
    member index as an object in reverse order), the others in list form.  Counting comes
    first, so a document gathers at most one entry per cell.
    """
    counts = (
        T.table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("p"),
                 F.year("o_orderdate").alias("y"))
        .agg(F.count("*").cast("string").alias("n"))
    )
    width, height = len(YEARS), len(PRIORITIES)
    position = (F.col("p") - 1) * width + F.col("y") - YEARS[0]
    cells = counts.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct(position.cast("int").alias("position"), "n"))).alias("cells")
    )
    sparse = F.size("cells") * 2 < width * height
    code, key = F.format_string("%010d", "o_custkey"), F.col("o_custkey").cast("string")
    names = {label[0]: label[2:] for label in PRIORITIES}

    def quoted(values, separator=","):
        return separator.join(f'"{value}"' for value in values)

    def members(index_list, index_object, labels):
        index = F.when(sparse, F.lit(index_object)).otherwise(F.lit(index_list))
        return F.concat(F.lit('{"category":{"index":'), index, F.lit(f',"label":{labels}}}}}'))

    def objects(items):
        return "{" + ",".join(f'"{k}":{v}' for k, v in items) + "}"

    fuels, years = list(names), [str(y) for y in YEARS]
    fuel = members(f"[{quoted(fuels)}]", objects(reversed(list(zip(fuels, range(height))))),
                   objects((k, f'"{v}"') for k, v in names.items()))
    year = members(f"[{quoted(years)}]", objects(reversed(list(zip(years, range(width))))),
                   objects((y, f'"{y}"') for y in years))
    region = F.concat(F.lit('{"category":{"index":["'), code, F.lit('"],"label":{"'), code,
                      F.lit('":"Customer '), key, F.lit('"}}}'))
    dense = F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), lambda i: F.col("cells")[i].cast("int"))
    as_object = F.to_json(F.col("cells").cast("map<string, int>"))
    value = F.when(sparse, as_object).otherwise(F.to_json(dense))
    document = F.concat(
        F.lit(f'{{"id":[{quoted(DIMENSIONS)}],"size":[1,{height},1,{width}],"dimension":{{"Region":'), region,
        F.lit(',"Drivmedel":'), fuel,
        F.lit(',"ContentsCode":{"category":{"index":["ORDERS"],"label":{"ORDERS":"orders"}}},"Tid":'), year,
        F.lit('},"value":'), value, F.lit("}"),
    )
    return cells.select(F.concat(F.lit("cube_"), key, F.lit(".json")).alias("_source_file"), document.alias("text"))


@query("cube_roundtrip", CUBE_SQL)
def cube_roundtrip(spark, sf_dir):
    return cube.flatten(cube_documents(spark, sf_dir), DIMENSIONS, ("Region", "Drivmedel"), text="text", chunk_cells=20)


@query("cube_sizes", """
SELECT DISTINCT 'cube_' || o_custkey || '.json' AS _source_file, CAST(35 AS BIGINT) AS declared_cells,
       CAST(35 AS BIGINT) AS actual_cells, true AS matches
FROM orders""")
def cube_sizes(spark, sf_dir):
    """Declared cells against flattened rows, per document."""
    documents = cube_documents(spark, sf_dir)
    rows = cube.flatten(documents, DIMENSIONS, text="text")
    report = cube.size_report(cube.outline(documents, "text"), rows)
    return report.withColumn("matches", ~declared_size("cube", "declared", report).bad)


@query("cube_wrong_members", """
SELECT DISTINCT 'cube_' || o_custkey || '.json' AS _source_file, 'Drivmedel' AS dimension,
       CAST(CASE o_custkey % 4 WHEN 1 THEN 6 WHEN 2 THEN 4 ELSE 5 END AS INTEGER) AS declared_members,
       CAST(5 AS INTEGER) AS members, CAST(5 AS INTEGER) AS distinct_codes,
       CAST(CASE o_custkey % 4 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS unlabelled
FROM orders WHERE o_custkey % 4 > 0""")
def cube_wrong_members(spark, sf_dir):
    """Three of four documents are made wrong: a member too few, one too many, a label missing."""
    height, width = len(PRIORITIES), len(YEARS)
    number = F.regexp_extract("_source_file", r"\d+", 0).cast("long") % 4
    sizes = lambda n: f'"size":[1,{n},1,{width}]'
    text = F.when(number == 1, F.replace("text", F.lit(sizes(height)), F.lit(sizes(height + 1)))).when(
        number == 2, F.replace("text", F.lit(sizes(height)), F.lit(sizes(height - 1)))
    ).when(number == 3, F.replace("text", F.lit(',"5":"LOW"'), F.lit(""))).otherwise(F.col("text"))
    documents = cube_documents(spark, sf_dir).withColumn("text", text)
    return cube.wrong_members(documents, DIMENSIONS, ("Region", "Drivmedel"), text="text")


@query("incremental_load", """
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2),
     half AS (SELECT min(d) + CAST((max(d) - min(d)) // 2 AS INTEGER) AS cut FROM e)
SELECT CAST(CASE WHEN d <= cut THEN 1 ELSE 2 END AS INTEGER) AS load, count(*) AS files,
       CAST(sum(n) AS BIGINT) AS row_count, count(*) AS reported
FROM e, half GROUP BY 1
UNION ALL SELECT 3, 0, 0, 0""")
def incremental_load(spark, sf_dir):
    """Events land as one JSON array a file in two parts; the bronze load runs after each, and once more."""
    name = uuid.uuid4().hex
    folder = f"{shared_folder(spark)}/incremental/{name}"
    config = RunConfig(landing=f"{folder}/landing", storage=f"{folder}/tables", prefix=f"inc_{name}_")
    root = f"{config.landing}/elpris"
    storage.create_schemas(spark, config, "bronze", "ops")
    events = T.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    ends = events.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    cut = ends.select(F.date_add("a", F.floor(F.datediff("b", "a") / 2).cast("int"))).scalar()
    period = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("time_start"), F.col("value").alias("SEK_per_kWh"))
    files = events.groupBy(F.col("event_type").alias("elomrade"), F.year("day").alias("ar"), "day").agg(
        F.to_json(F.collect_list(period)).alias("value")
    )
    reported = []
    for part in (files.where(F.col("day") <= cut), files.where(F.col("day") > cut), None):
        if part is not None:  # a file holds one array, as the download leaves it
            part.drop("day").write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", "\n").partitionBy(
                "elomrade", "ar").format("text").save(f"{root}")
        reported.append(bronze.load_files(
            spark, config, "prices", root, len(landing.PRICE_FOLDERS),
            lambda spark, root, between, within: landing.read_prices(
                spark, root, between, pattern="*.txt", within=within),  # the suffix of Spark's text files
            lambda rows: rows.select("elomrade", "time_start", "SEK_per_kWh", F.col("source_file").alias("_source_file")),
            "*.txt",
        ))
    by_load = lambda table, time, *more: spark.table(table).groupBy(time).agg(*more).select(
        F.row_number().over(Window.orderBy(time)).alias("load"), "*")
    files_by_load = by_load(config.table("ops", "loaded_prices"), "loaded_at", F.count("*").alias("files"))
    rows = by_load(config.table("bronze", "prices"), "_ingested_at", F.count("*").alias("row_count"))
    said = spark.createDataFrame(list(enumerate(reported, 1)), "load int, reported long")
    none = F.lit(0).cast("long")
    return said.join(files_by_load, "load", "left").join(rows, "load", "left").select(
        "load", F.coalesce("files", none).alias("files"), F.coalesce("row_count", none).alias("row_count"), "reported")


def land_daily_files(spark, sf_dir, root, where=None, **options):
    """Events as one JSON array a file, per type and day, the way the download leaves them."""
    events = T.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    period = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("time_start"), F.col("value").alias("SEK_per_kWh"))
    files = (events if where is None else events.where(where)).groupBy(
        F.col("event_type").alias("elomrade"), F.year("day").alias("ar"), "day"
    ).agg(F.to_json(F.collect_list(period)).alias("value"))
    writer = files.drop("day").write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", "\n").options(**options)
    writer.partitionBy("elomrade", "ar").format("text").save(root)


def load_daily_files(spark, config, name="prices", **how):
    """The bronze load over them; ``.txt`` is the suffix of Spark's text files."""
    return bronze.load_files(
        spark, config, name, f"{config.landing}/elpris", len(landing.PRICE_FOLDERS),
        lambda spark, root, between, within: landing.read_prices(spark, root, between, pattern="*.txt", within=within),
        lambda rows: rows.select("elomrade", "time_start", "SEK_per_kWh", F.col("source_file").alias("_source_file")),
        "*.txt", **how,
    )


def landing_config(spark, kind):
    name = uuid.uuid4().hex
    folder = f"{shared_folder(spark)}/{kind}/{name}"
    config = RunConfig(landing=f"{folder}/landing", storage=f"{folder}/tables", prefix=f"{kind}_{name}_")
    storage.create_schemas(spark, config, "bronze", "ops")
    return config


class Crash(Exception):
    pass


def crash():
    raise Crash


DAILY_SQL = """
SELECT event_type AS elomrade, count(*) AS row_count, count(DISTINCT CAST(ts AS DATE)) AS files, CAST(1 AS BIGINT) AS loads
FROM events GROUP BY 1"""


def visible(spark, config):
    """Per type: rows, files and loads that readers see."""
    rows = manifest.complete_rows(spark, config, "prices")
    return rows.groupBy("elomrade").agg(
        F.count("*").alias("row_count"), F.countDistinct("_source_file").alias("files"), F.countDistinct("_load").alias("loads")
    )


@query("load_after_crash", DAILY_SQL)
def load_after_crash(spark, sf_dir):
    """A load dies between its two writes and is repeated: every file counts once."""
    config = landing_config(spark, "crash")
    land_daily_files(spark, sf_dir, f"{config.landing}/elpris")
    try:
        load_daily_files(spark, config, between_writes=crash)
    except Crash:
        pass
    load_daily_files(spark, config)
    return visible(spark, config)


@query("load_of_one_suffix", DAILY_SQL.replace("FROM events", "FROM events WHERE event_id % 2 = 0"))
def load_of_one_suffix(spark, sf_dir):
    """Files of another suffix beside the landed ones (half of the events, compressed) are not read."""
    config = landing_config(spark, "suffix")
    land_daily_files(spark, sf_dir, f"{config.landing}/elpris", F.col("event_id") % 2 == 0)
    land_daily_files(spark, sf_dir, f"{config.landing}/elpris", F.col("event_id") % 2 == 1, compression="gzip")
    load_daily_files(spark, config)
    return visible(spark, config)


@query("rebuilt_bronze", DAILY_SQL)
def rebuilt_bronze(spark, sf_dir):
    """After DROP TABLE every landed file is new again, and the table is built from the archive."""
    config = landing_config(spark, "rebuild")
    land_daily_files(spark, sf_dir, f"{config.landing}/elpris")
    load_daily_files(spark, config)
    spark.sql(f"DROP TABLE {config.table('bronze', 'prices')}")
    load_daily_files(spark, config)
    return visible(spark, config)


@query("rows_without_area", """
SELECT 'no row is without elomrade' AS check_name, false AS passed, CAST(1 AS BIGINT) AS failed_rows,
       CAST(split_part(sample, ' ', 1) AS BIGINT) AS found, CAST(0 AS BIGINT) AS visible_loads
FROM (SELECT count(*) || ' rows' AS sample FROM events WHERE event_type = (SELECT min(event_type) FROM events))""")
def rows_without_area(spark, sf_dir):
    """Price rows that lack a required column (one type of event lands in the folder for no value) stop the load before
    its record is written, and are reported."""
    config, name = landing_config(spark, "required"), C.PRICE_TABLE
    events = T.table(spark, sf_dir, "events")
    least = events.agg(F.min("event_type").alias("t")).select("t").scalar()
    events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("time_start"), F.col("value").alias("SEK_per_kWh"),
        F.when(F.col("event_type") != least, F.col("event_type")).alias("elomrade"), F.year("ts").alias("ar"),
    ).write.partitionBy("elomrade", "ar").json(f"{config.landing}/elpris")
    try:
        bronze.load_files(
            spark, config, name, f"{config.landing}/elpris", len(landing.PRICE_FOLDERS),
            lambda spark, root, between, within: landing.read_prices(spark, root, between, whole_files=False, within=within),
            lambda rows: rows.select("elomrade", "time_start", "SEK_per_kWh", F.col("source_file").alias("_source_file")),
        )
    except QualityError:
        pass  # expected
    loads = manifest.recorded(spark, config, name).agg(F.count("*").alias("n")).select("n").scalar()
    return spark.table(config.results_table).where("NOT passed").select(
        "check_name", "passed", "failed_rows", F.substring_index("sample", " ", 1).cast("long").alias("found"),
        loads.alias("visible_loads"),
    )


@query("label_state", """
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS code, strftime(o_orderdate, '%YM%m') AS period, o_orderpriority AS label,
                  o_orderkey % 2 AS load FROM orders)
SELECT code, label FROM o QUALIFY row_number() OVER (PARTITION BY code ORDER BY period DESC, load DESC, label DESC) = 1""")
def label_state(spark, sf_dir):
    """The newest label per code from a stored state: two loads, each merged into it on its own."""
    config = landing_config(spark, "labels")
    orders = T.table(spark, sf_dir, "orders")
    source = {"customers": labels.LabelSource("orders", "code", "label", "period")}
    for part in (0, 1):
        rows = orders.where(F.col("o_orderkey") % 2 == part).select(
            F.col("o_custkey").cast("string").alias("code"), F.date_format("o_orderdate", "yyyy'M'MM").alias("period"),
            F.col("o_orderpriority").alias("label"),
        )
        load = manifest.Load(spark, config, "orders")
        load.record(0, load.write_rows(rows)["rows"])
        newest = labels.refresh(spark, config, source)["customers"]
    return newest


def land_events(spark, sf_dir):
    """Events as landed price files: folders per type and year, one period per line."""
    root = f"{shared_folder(spark)}/landing/{uuid.uuid4().hex}"
    T.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+01:00'").alias("time_start"),
        F.col("value").alias("SEK_per_kWh"),
        F.col("event_type").alias("elomrade"),
        F.year("ts").alias("ar"),
    ).write.partitionBy("elomrade", "ar").json(root)
    return root


@query("landed_prices", """
SELECT event_type AS elomrade, count(*) AS row_count, round(sum(value), 2) AS total,
       strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+01:00' AS earliest, count(DISTINCT year(ts)) AS folders,
       CAST(0 AS BIGINT) AS with_rate
FROM events GROUP BY 1""")
def landed_prices(spark, sf_dir):
    """All events through the price reader: text columns, folder columns and file lineage."""
    prices = landing.read_prices(spark, land_events(spark, sf_dir), whole_files=False)
    folder = F.substring_index("source_file", "/", 2)
    return prices.groupBy("elomrade").agg(
        F.count("*").alias("row_count"), F.round(F.sum(F.col("SEK_per_kWh").try_cast("double")), 2).alias("total"),
        F.min("time_start").alias("earliest"), F.countDistinct(folder).alias("folders"),
        F.count("EXR").alias("with_rate"),
    )


@query("landed_files", """
SELECT DISTINCT event_type AS price_area, CAST(year(ts) AS VARCHAR) AS folder_year FROM events""")
def landed_files(spark, sf_dir):
    """The folders that hold landed event files, from the listing alone."""
    listing = landing.landed_files(spark, land_events(spark, sf_dir), 2)
    parts = F.split("source_file", "[=/]")
    return listing.select(parts[1].alias("price_area"), parts[3].alias("folder_year")).distinct()


@query("landed_days", """
SELECT DISTINCT event_type AS price_area, CAST(ts AS DATE) AS price_date FROM events""")
def landed_days(spark, sf_dir):
    """Presence by (area, day) from file paths: the path a day's events would land under, and back."""
    day = F.col("ts").cast("date")
    paths = T.table(spark, sf_dir, "events").select(
        landing.price_file(F.col("event_type"), day).alias("source_file")).distinct()
    return landing.present_days(paths)
