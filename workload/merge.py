"""Upsert and incremental loads over the driver's tables.

The stored state is the orders placed up to mid-1998, summed per customer and year; the
source is a reload of everything from 1997 on.  1995 and 1996 are only stored (kept), 1997 is
the same on both sides (unchanged), 1998 is changed where orders followed in its second half,
and later years are new.
"""

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tierwell.config import RunConfig, shared_folder
from tierwell.operators import quality, release, storage
from tierwell.operators import upsert as U
from tierwell.operators.storage import StoredBy
from tierwell.sources import manifest
from workload import tables as T
from workload.registry import query

KEYS = ["o_custkey", "year"]

SIDE_SQL = """
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
           CAST(max(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS DATE) AS last_urgent
    FROM orders WHERE {filter} GROUP BY 1, 2"""

MERGED_SQL = f"""
    SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.year, t.year) AS year,
           CASE WHEN s.o_custkey IS NULL THEN t.orders ELSE s.orders END AS orders,
           CASE WHEN s.o_custkey IS NULL THEN t.last_urgent ELSE s.last_urgent END AS last_urgent,
           CASE WHEN s.o_custkey IS NULL THEN 'kept' WHEN t.o_custkey IS NULL THEN 'inserted'
                WHEN s.orders IS DISTINCT FROM t.orders OR s.last_urgent IS DISTINCT FROM t.last_urgent
                THEN 'updated' ELSE 'unchanged' END AS action
    FROM ({SIDE_SQL.format(filter="o_orderdate >= DATE '1997-01-01'")}) s
    FULL JOIN ({SIDE_SQL.format(filter="o_orderdate < DATE '1998-07-01'")}) t
         ON s.o_custkey = t.o_custkey AND s.year = t.year"""


def yearly_state(orders):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate").cast("date"))
    return orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders"), F.max(urgent).alias("last_urgent")
    )


def sides(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    target = yearly_state(orders.where(date < F.lit("1998-07-01").cast("timestamp_ntz")))
    source = yearly_state(orders.where(date >= F.lit("1997-01-01").cast("timestamp_ntz")))
    return target, source


@query("upsert_result", f"SELECT o_custkey, year, orders, last_urgent FROM ({MERGED_SQL})")
def upsert_result(spark, sf_dir):
    target, source = sides(spark, sf_dir)
    return U.upsert(target, source, KEYS)


@query("upsert_changes", f"SELECT * FROM ({MERGED_SQL}) WHERE action IN ('inserted', 'updated')")
def upsert_changes(spark, sf_dir):
    """The rows a merge would write."""
    target, source = sides(spark, sf_dir)
    labelled = U.label_changes(target, source, KEYS)
    return labelled.where(F.col(U.ACTION) != U.UNCHANGED).withColumnRenamed(U.ACTION, "action")


@query("upsert_metrics", f"SELECT action, count(*) AS row_count FROM ({MERGED_SQL}) GROUP BY 1")
def upsert_metrics(spark, sf_dir):
    target, source = sides(spark, sf_dir)
    return U.action_counts(U.merge_rows(target, source, KEYS))


@query("unchanged_upsert", f"SELECT 'unchanged' AS action, count(*) AS row_count FROM ({MERGED_SQL}) WHERE action <> 'kept'"
       f" UNION ALL SELECT 'kept', count(*) FROM ({MERGED_SQL}) WHERE action = 'kept'")
def unchanged_upsert(spark, sf_dir):
    """Merging the same source again changes nothing."""
    target, source = sides(spark, sf_dir)
    return U.action_counts(U.merge_rows(U.upsert(target, source, KEYS), source, KEYS))


def scratch_config(spark):
    """A run of its own below the shared folder, so that a query can write tables.

    The folder is named after the application: the shared folder outlives a session, and the
    session's catalog may not.
    """
    storage_root = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}"
    return RunConfig(landing="", storage=storage_root, prefix="tierwell_check_")


@query("stored_merge", f"SELECT o_custkey, year, orders, last_urgent FROM ({MERGED_SQL})")
def stored_merge(spark, sf_dir):
    """The upsert through a stored table that is partitioned by year: create, merge, read."""
    target, source = sides(spark, sf_dir)
    first, second, name = scratch_config(spark), scratch_config(spark), f"state_{uuid.uuid4().hex}"
    storage.create_schemas(spark, first, "silver")
    storage.merge(target, first, "silver", name, KEYS, stored_by="year")
    storage.merge(storage.stage(source, second, name), second, "silver", name, KEYS, stored_by="year")
    storage.drop_stage(spark, second)
    return spark.table(second.table("silver", name)).select("o_custkey", "year", "orders", "last_urgent")


@query("stored_merge_result", f"""
SELECT CAST(count(*) FILTER (action = 'inserted') AS BIGINT) AS inserted,
       CAST(count(*) FILTER (action = 'updated') AS BIGINT) AS updated,
       CAST(count(*) FILTER (action = 'unchanged') AS BIGINT) AS unchanged,
       CAST(count(*) AS BIGINT) AS total
FROM ({MERGED_SQL})""")
def stored_merge_result(spark, sf_dir):
    """What a merge into an unpartitioned table reports, counted from the rows it stored."""
    target, source = sides(spark, sf_dir)
    first, second, name = scratch_config(spark), scratch_config(spark), f"state_{uuid.uuid4().hex}"
    storage.create_schemas(spark, first, "silver")
    storage.merge(target, first, "silver", name, KEYS)
    result = storage.merge(storage.stage(source, second, name), second, "silver", name, KEYS)
    storage.drop_stage(spark, second)
    return spark.createDataFrame([(result.inserted, result.updated, result.unchanged, result.total)],
                                 "inserted long, updated long, unchanged long, total long")


@query("published_table", """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
       CAST(max(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS DATE) AS last_urgent
FROM orders GROUP BY 1, 2""")
def published_table(spark, sf_dir):
    """A full rebuild replaces what an earlier one published under the same name."""
    target, _ = sides(spark, sf_dir)
    name = f"state_{uuid.uuid4().hex}"
    for df in (target, yearly_state(T.table(spark, sf_dir, "orders"))):
        config = scratch_config(spark)
        storage.create_schemas(spark, config, "gold")
        storage.publish(df, config, "gold", name)
    return spark.table(config.table("gold", name))


@query("merge_by_month", """
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
       strftime(o_orderdate, '%Y-%m') AS month,
       strftime(o_orderdate, '%Y-%m') = (SELECT strftime(max(o_orderdate), '%Y-%m') FROM orders) AS rewritten
FROM orders GROUP BY ALL""")
def merge_by_month(spark, sf_dir):
    """A table keyed by day and stored by month, which is computed from the day: the second load, of the last day alone,
    rewrites the files of the last month and of no other."""
    daily = T.table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("orders"))
    by_month = StoredBy("month", "day", F.date_format("day", "yyyy-MM"))
    first, second, name = scratch_config(spark), scratch_config(spark), f"daily_{uuid.uuid4().hex}"
    storage.create_schemas(spark, first, "silver")
    last = daily.agg(F.max("day").alias("d")).select("d").scalar()
    early = daily.withColumn("orders", F.when(F.col("day") == last, F.lit(0).cast("long")).otherwise(F.col("orders")))
    storage.merge(early, first, "silver", name, ["o_custkey", "day"], by_month)
    storage.merge(storage.stage(daily.where(F.col("day") == last), second, name), second, "silver", name, ["o_custkey", "day"], by_month)
    storage.drop_stage(spark, second)
    return spark.table(second.table("silver", name)).select(
        "o_custkey", "day", "orders", "month", F.col("_metadata.file_path").contains(second.version).alias("rewritten"))


@query("gated_publish", """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
       CAST(max(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS DATE) AS last_urgent
FROM orders WHERE o_orderdate < DATE '1998-07-01' GROUP BY 1, 2""")
def gated_publish(spark, sf_dir):
    """A rebuild whose check fails is written but not switched to: readers keep the table from before."""
    target, source = sides(spark, sf_dir)
    name, first, second = f"state_{uuid.uuid4().hex}", scratch_config(spark), scratch_config(spark)
    storage.create_schemas(spark, first, "gold", "ops")
    storage.publish(target, first, "gold", name)
    written, declared = quality.write_checked(
        {name: source}, lambda t: [quality.row_rule(name, "there are many orders", t[name], F.col("orders") < 1_000_000)],
        lambda _, df: storage.write_parquet(df, second.path("gold", name)),
    )
    checks = quality.QualityChecks(spark, second.results_table, second.version, "gold").add(*declared)
    try:
        checks.enforce("before write", "The new version stays unused.")
        storage.point_to(spark, second.table("gold", name), written[name], second.path("gold", name))
    except quality.QualityError:
        pass  # expected
    return spark.table(second.table("gold", name))


@query("kept_releases", """
WITH p AS (SELECT unnest(range(0, 3)) AS part)
SELECT t.name AS table_name, CAST(p.part + 1 AS BIGINT) AS number,
       CASE t.name WHEN 'by_status' THEN count(DISTINCT o_orderstatus) ELSE count(DISTINCT o_custkey) END AS row_count,
       p.part > 0 AS has_files, p.part = 2 AS is_shown
FROM p JOIN orders ON o_orderkey % 3 <= p.part CROSS JOIN (VALUES ('by_status'), ('by_customer')) t(name)
GROUP BY t.name, p.part""")
def kept_releases(spark, sf_dir):
    """Two tables are rebuilt and released three times over more and more orders; the files of the last two stay, and
    all views show the last."""
    orders, version = T.table(spark, sf_dir, "orders"), scratch_config(spark)
    storage.create_schemas(spark, version, "gold", "ops")
    for part in range(3):
        config = replace(version, version=uuid.uuid4().hex)
        new, rows = release.Release(spark, config, "gold"), orders.where(F.col("o_orderkey") % 3 <= part)
        new.write("by_status", rows.groupBy("o_orderstatus").agg(F.count("*").alias("orders")))
        new.write("by_customer", rows.groupBy("o_custkey").agg(F.count("*").alias("orders")))
        new.commit()
        release.keep_last(spark, config, "gold", 2)
    records = spark.table(version.table("ops", "releases")).select("number", "version", F.inline("tables"))
    folders = [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(f"{version.storage}/{version.schema('gold')}").select(F.element_at(F.split("path", "/"), -2).alias("version")).distinct()
        .withColumn("has_files", F.lit(True)),
        reduce(DataFrame.unionByName, (
            spark.table(version.table("gold", name)).select(
                F.element_at(F.split(F.input_file_name(), "/"), -2).alias("version"), F.lit(name).alias("name"))
            for name in ("by_status", "by_customer")
        )).distinct().withColumn("is_shown", F.lit(True)),
    ]
    return records.join(folders[0], "version", "left").join(folders[1], ["version", "name"], "left").select(
        F.col("name").alias("table_name"), "number", "row_count",
        F.coalesce("has_files", F.lit(False)).alias("has_files"), F.coalesce("is_shown", F.lit(False)).alias("is_shown"),
    )


@query("released_after_crash", """
SELECT CAST(o_orderstatus AS VARCHAR) AS o_orderstatus, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
       (SELECT count(*) FROM orders) AS all_orders
FROM orders GROUP BY 1""")
def released_after_crash(spark, sf_dir):
    """A run dies between its record and its views: readers of the release see both new tables, and views catch up."""
    orders, config = T.table(spark, sf_dir, "orders"), scratch_config(spark)
    storage.create_schemas(spark, config, "gold", "ops")
    for rows in (orders.where("o_orderkey % 2 = 0"), orders):
        config = replace(config, version=uuid.uuid4().hex)
        new = release.Release(spark, config, "gold")
        new.write("by_status", rows.groupBy("o_orderstatus").agg(
            F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers")))
        new.write("everything", rows.agg(F.count("*").alias("all_orders")))
        new.commit()
    old = release.newest(spark, config, "gold", 2)[1]["tables"]
    for entry in old:  # as the views would stand
        spark.sql(f"CREATE OR REPLACE VIEW {config.table('gold', entry['name'])} AS SELECT * FROM parquet.`{entry['path']}`")
    by_status = release.tables(spark, config, "gold")["by_status"]
    release.follow(spark, config, "gold")
    all_orders = spark.table(config.table("gold", "everything")).select("all_orders").scalar()
    return by_status.withColumn("all_orders", all_orders)


LOADED_FILES_SQL = """
    SELECT o_custkey || '_' || strftime(o_orderdate, '%YM%m') || '.json' AS source_file,
           max(o_orderdate) AS modified_at
    FROM orders WHERE o_orderdate < DATE '1998-07-15' GROUP BY 1"""


@query("incremental_new_files", f"""
SELECT o_custkey || '_' || strftime(o_orderdate, '%YM%m') || '.json' AS source_file, max(o_orderdate) AS modified_at
FROM orders GROUP BY 1
EXCEPT SELECT source_file, modified_at FROM ({LOADED_FILES_SQL})""")
def incremental_new_files(spark, sf_dir):
    """A customer's month is a landed file, its last order the time it was modified: files that are
    new, or were landed again after the last load, are still to be read."""
    date = F.col("o_orderdate")
    name = F.concat_ws("_", F.col("o_custkey").cast("string"), F.date_format(date, "yyyy'M'MM'.json'"))
    orders = T.table(spark, sf_dir, "orders").select(name.alias("source_file"), date.alias("modified_at"))

    def files(rows):
        return rows.groupBy("source_file").agg(F.max("modified_at").alias("modified_at"))

    loaded = files(orders.where(F.col("modified_at") < F.lit("1998-07-15").cast("timestamp_ntz")))
    return manifest.unseen(files(orders), loaded)
