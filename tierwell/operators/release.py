"""Releases: rebuilt tables that readers get all at once, and the removal of versions that are no longer wanted.

The versions of all tables are written first.  One record, a single file, then names them: that is the switch.  A
reader who needs tables of the same release asks for ``tables``; the views of the tables' names follow the record, each
replaced in one step, and the next release or ``follow`` brings those along that a dead run left behind.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.config import RunConfig
from tierwell.operators import storage

RECORD = "layer string, number long, version string, tables array<struct<name: string, path: string, columns: string, row_count: long>>"


def _records(config: RunConfig) -> str:
    return config.table("ops", "releases")


class Release:
    """Write tables, check what came back, then ``commit``.  Without the last step nothing is visible."""

    def __init__(self, spark: SparkSession, config: RunConfig, layer: str):
        self.spark, self.config, self.layer = spark, config, layer
        self._written: dict[str, tuple[DataFrame, str, int]] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """The new version of a table as stored, its rows counted on the way."""
        path = self.config.path(self.layer, name)
        watched, seen = storage.counted(df)
        written = storage.write_parquet(watched, path)
        self._written[name] = (written, path, seen.get["rows"])
        return written

    def commit(self) -> dict[str, int]:
        """Switch readers to what was written; the row count per table."""
        last = newest(self.spark, self.config, self.layer, 1)
        number = last[0]["number"] + 1 if last else 1
        entries = [
            (name, path, ", ".join(f"`{column}` {kind}" for column, kind in df.dtypes), rows)
            for name, (df, path, rows) in self._written.items()
        ]
        record = self.spark.createDataFrame([(self.layer, number, self.config.version, entries)], RECORD)
        storage.append(record.coalesce(1), _records(self.config))
        follow(self.spark, self.config, self.layer)
        return {name: rows for name, (_, _, rows) in self._written.items()}


def newest(spark: SparkSession, config: RunConfig, layer: str, count: int) -> list:
    """The records of the last ``count`` releases, the newest first; runs that took the same number go by version."""
    if not storage.exists(spark, _records(config)):
        return []
    records = spark.table(_records(config)).where(F.col("layer") == layer)
    return records.orderBy(F.desc("number"), F.desc("version")).limit(count).collect()


def tables(spark: SparkSession, config: RunConfig, layer: str) -> dict[str, DataFrame]:
    """All tables of the newest release."""
    return {name: spark.read.schema(columns).parquet(path) for name, path, columns in _shown(spark, config, layer)}


def _shown(spark: SparkSession, config: RunConfig, layer: str) -> list[tuple[str, str, str]]:
    last = newest(spark, config, layer, 1)
    return [(entry["name"], entry["path"], entry["columns"]) for entry in last[0]["tables"]] if last else []


def follow(spark: SparkSession, config: RunConfig, layer: str) -> None:
    """Point the views at the newest release."""
    for name, path, columns in _shown(spark, config, layer):
        table = config.table(layer, name)
        if storage.exists(spark, table) and spark.catalog.getTable(table).tableType != "VIEW":
            spark.sql(f"DROP TABLE {table}")  # as published by storage.publish
        # Cast to their own types: a stored column may be marked as one without a name of its own, which views refuse.
        named = ", ".join(f"CAST(`{c}` AS {kind}) AS `{c}`" for c, kind in spark.read.schema(columns).parquet(path).dtypes)
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {named} FROM parquet.`{path.replace('`', '``')}`")


def keep_last(spark: SparkSession, config: RunConfig, layer: str, count: int) -> list[str]:
    """Remove the versions that only earlier releases than the last ``count`` have; the removed folders.

    Versions that no release has (a failed check, a dead run) go when they are older than the oldest one
    kept, so what a run is writing now stays.
    """
    if count < 1:
        raise ValueError("the newest release cannot be removed")
    kept = newest(spark, config, layer, count)
    hadoop, removed = spark._jvm.org.apache.hadoop.fs, []
    of_table: dict[str, list[str]] = {}
    for record in kept:
        for entry in record["tables"]:
            of_table.setdefault(entry["path"].rpartition("/")[0], []).append(entry["path"].rpartition("/")[2])
    for parent, versions in of_table.items():
        folder = hadoop.Path(parent)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        times = {status.getPath().getName(): status.getModificationTime() for status in system.listStatus(folder)}
        oldest = min(times[version] for version in versions)
        for name in sorted(times):
            if name not in versions and times[name] <= oldest:
                system.delete(hadoop.Path(parent, name), True)
                removed.append(f"{parent}/{name}")
    return removed
