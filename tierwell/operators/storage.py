"""Writing: append, versioned publish and merge into stored tables.

Nothing overwrites the files it reads.  A table is an external Parquet table; a new version is
written to its own folder and the table is pointed at it when it is complete, so a lost
executor or a failed write leaves the old version in place.
"""

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tierwell.config import RunConfig, shared_folder
from tierwell.operators import upsert as U
from tierwell.operators.dedup import duplicate_keys
from tierwell.operators.joins import distinct_array


@dataclass(frozen=True)
class MergeResult:
    inserted: int
    updated: int
    unchanged: int
    total: int
    #: All rows of the partitions (or of the table) that were written; None when nothing was.
    written: DataFrame | None = field(default=None, compare=False, repr=False)


@dataclass(frozen=True, eq=False)
class StoredBy:
    """A storage partition that is computed from a column of the key, such as the month of a day."""

    name: str
    key: str
    value: Column


def create_schemas(spark: SparkSession, config: RunConfig, *layers: str) -> None:
    """Schemas live below the storage root, so that managed tables are stored there as well."""
    for layer in layers:
        schema = config.schema(layer)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{config.storage}/{schema}'")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def write_parquet(df: DataFrame, path: str, stored_by: str | None = None) -> DataFrame:
    """Write a frame and read it back, which also cuts its lineage.

    A partitioned write is rebalanced by the partition column first: adaptive execution packs
    small partitions into one task and splits a large one over several.
    """
    if stored_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", stored_by).write.mode("overwrite").partitionBy(stored_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _stage_folder(spark: SparkSession, config: RunConfig) -> str:
    return f"{shared_folder(spark)}/stage/{config.version}"


def stage(df: DataFrame, config: RunConfig, name: str) -> DataFrame:
    """A stored copy in the shared folder: checks and writes then see the same rows."""
    return write_parquet(df, f"{_stage_folder(df.sparkSession, config)}/{name}")


def drop_stage(spark: SparkSession, config: RunConfig) -> None:
    """Remove this run's stored copies, once everything that reads them is written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_stage_folder(spark, config))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def point_to(spark: SparkSession, table: str, df: DataFrame, path: str, stored_by: str | None = None) -> None:
    """Make ``table`` show the version in ``path``; creates the table on first use.

    A table with partitions, or with other columns than before, is defined anew: its catalog
    partitions would still lead to the old version.  The files are external and stay.
    """
    if stored_by is None and exists(spark, table) and spark.table(table).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
        partitioned = f"PARTITIONED BY (`{stored_by}`)" if stored_by else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    if stored_by:
        spark.catalog.recoverPartitions(table)


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df``, and what its first action will have counted: all rows as ``rows``, and those of each condition."""
    seen = Observation()
    wanted = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    return df.observe(seen, F.count("*").alias("rows"), *wanted), seen


def publish(df: DataFrame, config: RunConfig, layer: str, name: str, stored_by: str | None = None) -> int:
    """Full rebuild: write a new version, switch to it, return its row count, which is taken while writing."""
    spark, table, path = df.sparkSession, config.table(layer, name), config.path(layer, name)
    watched, seen = counted(df)
    write_parquet(watched, path, stored_by)
    point_to(spark, table, df, path, stored_by)
    return seen.get["rows"]


def merge(source: DataFrame, config: RunConfig, layer: str, name: str, keys,
          stored_by: str | StoredBy | None = None) -> MergeResult:
    """Upsert a checked, deduplicated frame into a stored table.

    The changed rows are written to the shared folder first.  Without any, nothing is
    rewritten.  A table stored by a key column gets new versions of the affected partitions
    only; any other table gets a new version as a whole.  Rows are counted while they
    are written.
    """
    spark, table, path = source.sparkSession, config.table(layer, name), config.path(layer, name)
    of_key = stored_by
    if isinstance(stored_by, StoredBy):
        source, of_key, stored_by = source.withColumn(stored_by.name, stored_by.value), stored_by.key, stored_by.name
    if not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"{table}: source rows share a key; nothing was written")
    if not exists(spark, table):
        total = publish(source, config, layer, name, stored_by)
        return MergeResult(total, 0, 0, total, spark.read.schema(source.schema).parquet(path))

    if stored_by is not None and of_key not in keys:
        raise ValueError(f"{table} is stored by {of_key}, which is not part of its key")
    stored = spark.table(table)
    by_partition = stored_by is not None and stored_by in _partition_columns(spark, table)
    if stored_by is not None and stored_by not in stored.columns:
        raise ValueError(f"{table} has no column {stored_by}; drop the table and merge again")
    target = stored.select(*source.columns)
    labelled = U.label_changes(_only_partitions(target, source, stored_by) if by_partition else target, source, keys)
    action = F.col(U.ACTION)
    watched, seen = counted(labelled, inserted=action == U.INSERTED, updated=action == U.UPDATED)
    changes = stage(watched.where(action != U.UNCHANGED), config, f"changes_{layer}_{name}").drop(U.ACTION)
    counts = seen.get
    inserted, updated = counts["inserted"], counts["updated"]
    unchanged, written = counts["rows"] - inserted - updated, None
    if inserted + updated:
        if by_partition:
            _replace_partitions(spark, table, target, changes, keys, stored_by, path)
        else:
            write_parquet(U.apply_changes(target, changes, keys), path, stored_by)
            point_to(spark, table, target, path, stored_by)
        written = spark.read.schema(source.schema).parquet(path)
    # Without columns to read, the count comes from the footers of the files.
    return MergeResult(inserted, updated, unchanged, spark.table(table).count(), written)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _only_partitions(target: DataFrame, rows: DataFrame, stored_by: str | None) -> DataFrame:
    """The part of a partitioned table that can match ``rows``.

    Their partition values are a scalar subquery, at most as long as the list of partitions;
    Spark evaluates it first and reads only those partitions.
    """
    if stored_by is None:
        return target
    return target.where(F.array_contains(distinct_array(rows, stored_by), F.col(stored_by)))


def _written_folders(spark: SparkSession, path: str, stored_by: str) -> list[str]:
    """Names of the partition folders below ``path`` as Spark wrote them, special characters escaped its way."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return [unquote(name) for (name,) in files.select(folder).distinct().collect()]


def _replace_partitions(spark, table, target, changes, keys, stored_by, path) -> None:
    """The key holds the partition column, so a change never moves a row between partitions.

    The list of partitions that are pointed at their new folder is at most as long as the
    table's list of partitions.
    """
    if not changes.where(F.col(stored_by).isNull()).isEmpty():
        raise ValueError(f"{table} is stored by {stored_by}, and a changed row has none")
    write_parquet(U.apply_changes(_only_partitions(target, changes, stored_by), changes, keys), path, stored_by)
    for folder in _written_folders(spark, path, stored_by):
        value = unquote(folder.partition("=")[2]).replace("\\", "\\\\").replace("'", "\\'")
        partition = f"PARTITION (`{stored_by}` = '{value}')"
        location = "LOCATION '" + f"{path}/{folder}".replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} {location}")
        spark.sql(f"ALTER TABLE {table} {partition} SET {location}")
    spark.catalog.refreshTable(table)
