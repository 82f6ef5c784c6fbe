"""The physical plans that the design rests on."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tierwell.operators import dedup, joins, trailing
from tierwell.sources import cube

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text, table):
    found = re.findall(rf"Location: [^\]]*{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", text)
    return {column.split(":")[0] for schema in found for column in schema.split(",") if column}


def test_newest_row_is_limited_before_the_shuffle(spark):
    text = plan(dedup.keep_newest(spark.range(9).selectExpr("id % 3 as k", "id as v", "id as w"), ["k"], ["v"]))
    partial, shuffle = text.index("1, Partial"), text.index("Exchange hashpartitioning")
    assert "1, Final" in text and shuffle < partial  # the plan is printed from the top


def test_labels_are_reduced_by_a_hash_aggregate_before_anything_is_sorted(spark):
    df = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(dedup.latest_labels(df, "o_orderpriority", "o_orderstatus", "o_custkey", "o_orderdate"))
    first = [line for line in text.splitlines() if re.search("Sort |Aggregate|Exchange", line)][::-1]
    assert ["HashAggregate" in line for line in first[:3]] == [True, False, True] and "Exchange" in first[1]


def test_flagship_reads_three_order_columns_and_shuffles_them_once(spark):
    text = plan(entry.queries()["candidates"](spark, SF_DIR))
    assert read_columns(text, "orders") == {"o_custkey", "o_orderdate", "o_orderpriority"}
    assert read_columns(text, "customer") == {"c_custkey", "c_nationkey", "c_mktsegment"}
    assert text.count("hashpartitioning(o_custkey") == 1


def test_trailing_sums_take_one_shuffle(spark):
    facts = spark.createDataFrame([], "municipality_code string, registration_month date, fuel_type_code string, registration_count int")
    text = plan(trailing.registration_measures(facts.repartition(2), "municipality_code", "120", "140"))
    assert text.count("Exchange hashpartitioning(municipality_code") == 1


def test_period_bound_prunes_a_table_stored_by_month(spark, tmp_path):
    months = spark.sql("select explode(sequence(date'2020-01-01', date'2024-12-01', interval 1 month)) as registration_month")
    facts = months.selectExpr("registration_month", "'A' as municipality_code", "'100' as fuel_type_code", "1 as registration_count")
    facts.write.partitionBy("registration_month").parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    recent, both = trailing.registration_windows(stored, "registration_month")
    window = stored.where(both)
    assert len(window.collect()) == 24
    assert re.search(r"PartitionFilters: \[[^\]]*registration_month[^\]]*Subquery", plan(window))


def test_orphans_are_looked_up_once_per_key(spark):
    facts = spark.range(99).selectExpr("'hot' as k").repartition(2)
    text = plan(joins.orphan_keys(facts, spark.createDataFrame([("cold",)], "k string"), "k"))
    assert text.index("LeftAnti") < text.index("HashAggregate")  # the join sits above the distinct


def test_cells_are_expanded_in_generated_code(spark):
    documents = spark.createDataFrame([("f", "{}")], "_source_file string, value string")
    flat = cube.flatten(documents, ["Region", "Tid"], ["Region"])
    generate = next(line for line in plan_after(flat).splitlines() if "Generate posexplode" in line)
    assert re.search(r"\*\(\d+\) Generate posexplode", generate)
    assert "BatchEvalPython" not in plan(flat)


def plan_after(df):
    """The plan with its code generation stages, which adaptive execution only shows when it is off."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan(df.select("*"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name, table, columns", [
    ("coverage_profile", "events", {"ts", "event_type"}),
    ("complete_grid", "orders", {"o_orderstatus", "o_orderpriority", "o_orderdate"}),
    ("unknown_codes", "lineitem", {"l_returnflag", "l_linestatus"}),
    ("duplicate_keys", "lineitem", {"l_orderkey", "l_linenumber"}),
])
def test_only_needed_columns_are_read(spark, name, table, columns):
    assert read_columns(plan(entry.queries()[name](spark, SF_DIR)), table) == columns


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [Not(In(l_returnflag" in plan(entry.queries()["unknown_codes"](spark, SF_DIR))
    text = plan(spark.read.parquet(f"{SF_DIR}/orders.parquet").where(F.col("o_orderpriority") == "1-URGENT"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
