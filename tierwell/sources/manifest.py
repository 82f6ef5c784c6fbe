"""Which landed files are already in a table, and which loads of it are complete.

A file is known by its name *and* its modification time: a corrected file that lands again
under the same name is a new version, is loaded, and wins as the newest load.

A load has an id of its own.  Its rows go to a partition of that id, its files are listed under
that id, and one record, written last as a single file, says that both are complete.  Readers
take the rows and files of recorded ids only, so what a crashed load left behind is never seen,
and the next load appends the same files under another id.
"""

import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tierwell.config import RunConfig
from tierwell.operators import storage
from tierwell.operators.joins import distinct_array

KEY = ["source_file", "modified_at"]
LOAD = "_load"


def unseen(landed: DataFrame, known: DataFrame) -> DataFrame:
    """Landed file versions that have not been loaded."""
    return landed.join(known.select(*KEY), KEY, "left_anti")


def read_window(fresh: DataFrame) -> tuple[int, int] | None:
    """(oldest, newest) modification time of the fresh files in microseconds of the epoch, None when nothing is new.

    Two numbers, however many files there are.  They never become a Python datetime, which has no
    place for the repeated hour of a local time.
    """
    oldest, newest = fresh.agg(F.unix_micros(F.min("modified_at")), F.unix_micros(F.max("modified_at"))).first()
    return None if oldest is None else (oldest, newest)


class Reach(NamedTuple):
    """What a read has to reach: an interval of modification times, and the folders below the landing root, if there are any."""

    between: tuple[int, int]
    folders: list[str] | None


def reach(fresh: DataFrame, folders: int) -> Reach | None:
    """The interval and the folders of the fresh files, None when nothing is new.  A late file of an old year widens the
    interval, but not the list of folders, which is at most as long as the list of all folders."""
    between = read_window(fresh)
    if between is None:
        return None
    folder = F.substring_index("source_file", "/", folders)
    return Reach(between, sorted(unquote(f) for (f,) in fresh.select(folder).distinct().collect()) if folders else None)


def only(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of fresh files.  The interval of the read may hold others; this join is what decides."""
    return rows.join(fresh.select(*KEY), KEY, "left_semi")


# --- loads --------------------------------------------------------------------------------


def files_table(config: RunConfig, name: str) -> str:
    return config.table("ops", f"loaded_{name}")


def loads_table(config: RunConfig) -> str:
    return config.table("ops", "loads")


def recorded(spark: SparkSession, config: RunConfig, name: str) -> DataFrame:
    """(load_id, files, row_count, recorded_at) of the complete loads of a table."""
    if not storage.exists(spark, loads_table(config)):
        return spark.createDataFrame([], "load_id string, files long, row_count long, recorded_at timestamp")
    return spark.table(loads_table(config)).where(F.col("table_name") == name).drop("table_name")


def _of(loads: DataFrame) -> Column:
    """Whether a row is of one of the loads.  The list is a scalar subquery, so only their partitions are read."""
    return F.array_contains(distinct_array(loads, "load_id"), F.col(LOAD))


def complete_rows(spark: SparkSession, config: RunConfig, name: str, loads: DataFrame | None = None) -> DataFrame:
    """The rows of a table's complete loads, or of some of them."""
    return spark.table(config.table("bronze", name)).where(_of(recorded(spark, config, name) if loads is None else loads))


def complete_files(spark: SparkSession, config: RunConfig, name: str) -> DataFrame:
    """The file versions of a table's complete loads."""
    return spark.table(files_table(config, name)).where(_of(recorded(spark, config, name)))


def forget(spark: SparkSession, config: RunConfig, name: str) -> None:
    """Make every file new again."""
    spark.sql(f"DROP TABLE IF EXISTS {files_table(config, name)}")


def not_used(spark: SparkSession, config: RunConfig, name: str, consumer: str) -> DataFrame:
    """(load_id) of the complete loads that ``consumer`` has not marked as used."""
    loads, used = recorded(spark, config, name).select("load_id"), config.table("ops", "used_loads")
    if not storage.exists(spark, used):
        return loads
    mine = spark.table(used).where((F.col("consumer") == consumer) & (F.col("table_name") == name))
    return loads.join(mine.select("load_id"), "load_id", "left_anti")


def mark_used(config: RunConfig, used: dict[tuple[str, str], DataFrame]) -> None:
    """Record that consumers have taken in loads: {(consumer, table): load ids}, in one append of what is not recorded yet."""
    marks = reduce(DataFrame.unionByName, [
        loads.select(F.lit(consumer).alias("consumer"), F.lit(name).alias("table_name"), "load_id")
        for (consumer, name), loads in used.items()
    ])
    table = config.table("ops", "used_loads")
    if storage.exists(marks.sparkSession, table):
        marks = marks.join(marks.sparkSession.table(table), marks.columns, "left_anti")
    storage.append(marks.coalesce(1), table)


@dataclass
class Load:
    """One load of one table: rows, then files, then the record that makes both visible."""

    spark: SparkSession
    config: RunConfig
    name: str
    load_id: str = field(default_factory=lambda: f"{time.time_ns() // 1000:016d}-{uuid.uuid4().hex[:12]}")

    def _write(self, df: DataFrame, table: str, time_column: str, counts: dict[str, Column]) -> dict[str, int]:
        """Append under this load's id; what is counted is counted by the tasks that write."""
        seen = Observation()
        stamped = df.withColumn(time_column, F.current_timestamp()).withColumn(LOAD, F.lit(self.load_id))
        watched = stamped.observe(seen, F.count("*").alias("rows"), *[F.count_if(bad).alias(key) for key, bad in counts.items()])
        watched.write.mode("append").partitionBy(LOAD).saveAsTable(table)
        return seen.get

    def write_rows(self, rows: DataFrame, required=()) -> dict[str, int]:
        """Appends the rows; the number of them, and of those without a value, by required column."""
        missing = {f"without {column}": F.col(column).isNull() for column in required}
        return self._write(rows, self.config.table("bronze", self.name), "_ingested_at", missing)

    def write_files(self, fresh: DataFrame) -> int:
        return self._write(fresh, files_table(self.config, self.name), "loaded_at", {})["rows"]

    def record(self, files: int, rows: int) -> None:
        """One row in one file: the load is complete when the file is there."""
        row = self.spark.createDataFrame(
            [(self.name, self.load_id, files, rows)], "table_name string, load_id string, files long, row_count long"
        )
        storage.append(row.coalesce(1).withColumn("recorded_at", F.current_timestamp()), loads_table(self.config))
