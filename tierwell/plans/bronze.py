"""Landed files to bronze: append-only text tables with file lineage.

Each run appends the file versions that are not in the manifest, as one load.  A load's rows and
files are visible to readers once its record is written, so a run that dies at any point leaves
nothing that counts, and the next one loads the same files once (see ``sources/manifest.py``).
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwell.config import RunConfig
from tierwell.functions import codes as C
from tierwell.operators import quality, storage
from tierwell.operators.aggregates import coverage_profile
from tierwell.sources import calendar, cube, landing, manifest

#: Bronze table -> columns that must not be NULL.
REQUIRED = {C.PRICE_TABLE: ("elomrade", "_source_file")}

#: A folder that changed less than this many milliseconds before it was listed may have changed again unseen.
SETTLED_MS = 2000


def _nothing() -> None:
    pass


def _fresh_files(spark, config: RunConfig, name: str, landed: DataFrame) -> DataFrame:
    """Landed versions that are not loaded.  Dropping the bronze table makes every file new again."""
    if not storage.exists(spark, config.table("bronze", name)):
        manifest.forget(spark, config, name)
    if not storage.exists(spark, manifest.files_table(config, name)):
        return landed
    return manifest.unseen(landed, manifest.complete_files(spark, config, name))


def _append(spark, config: RunConfig, name: str, rows: DataFrame, fresh: DataFrame, between_writes: Callable[[], None]) -> int:
    """Rows, files, record.  A required column without a value stops the load before anything is visible."""
    load = manifest.Load(spark, config, name)
    counts = load.write_rows(rows, REQUIRED.get(name, ()))
    missing = {key: n for key, n in counts.items() if key != "rows"}
    if missing:
        checks = _checks(spark, config)
        for key, n in missing.items():
            checks.condition(name, f"no row is {key}", n == 0, f"{n} rows in {load.load_id}")
        checks.enforce("before append", "The load was not recorded.")
    between_writes()
    files = load.write_files(fresh)
    load.record(files, counts["rows"])
    return files


def _load_new(spark, config: RunConfig, name: str, landed: DataFrame,
              relist: Callable[[manifest.Reach], DataFrame], read: Callable[[manifest.Reach], DataFrame],
              finish: Callable[[DataFrame], DataFrame], folders: int = 0,
              between_writes: Callable[[], None] = _nothing) -> int:
    """Read, finish and append the files that are new.  Returns their number, 0 when there are none.

    Before anything is appended, ``relist`` shows which files the read reaches: a fresh file
    that is not among them stops the load, so none can enter the manifest unread.
    """
    fresh = _fresh_files(spark, config, name, landed)
    # Kept as a file of its own: the manifest it is compared with is about to grow.
    fresh = storage.stage(fresh, config, f"fresh_{name}")
    where = manifest.reach(fresh, folders)
    if where is None:
        return 0
    unread = manifest.unseen(fresh, relist(where)).count()
    if unread:
        raise RuntimeError(f"{name}: {unread} listed files are gone, changed or outside the read; nothing was appended")
    return _append(spark, config, name, finish(manifest.only(read(where), fresh)), fresh, between_writes)


def load_files(spark: SparkSession, config: RunConfig, name: str, root: str, folders: int,
               read: Callable[..., DataFrame], finish: Callable[[DataFrame], DataFrame],
               pattern: str = landing.JSON_FILES, between_writes: Callable[[], None] = _nothing) -> int:
    """One incremental load of the files below ``root`` with ``read(spark, root, between, within)``; the number of new files.

    ``between_writes`` is called when the rows are written and the files are not yet listed.
    """
    return _load_new(
        spark, config, name, _listing(spark, config, name, root, folders, pattern),
        lambda where: landing.landed_files(spark, root, folders, pattern, where.between, where.folders),
        lambda where: read(spark, root, where.between, where.folders), finish, folders, between_writes,
    )


def _listing(spark, config: RunConfig, name: str, root: str, folders: int = 0, pattern: str = landing.JSON_FILES,
             is_open: Callable[[str], bool] = lambda folder: False, relist: bool = False) -> DataFrame:
    """The landed files.  Folders are listed again only if they have to be.

    What a folder held is kept with the time it had then.  One with the same time, that is not open, is taken from
    there: years that are closed are not listed by every run.  A file that is overwritten in place without
    changing its folder's time, and files of stores without such times, are found in open folders, or with ``relist``.
    """
    if not folders:
        return storage.stage(landing.landed_files(spark, root, 0, pattern), config, f"landed_{name}")
    kept = config.table("ops", f"listing_{name}")
    known = spark.table(kept) if storage.exists(spark, kept) and not relist else None
    now = int(time.time() * 1000)
    times = landing.folder_times(spark, root, folders)
    before = dict(known.select("folder", "folder_time").distinct().collect()) if known is not None else {}  # one row per folder
    again = sorted(f for f, at in times.items() if is_open(f) or before.get(f) != at)
    folder = F.substring_index("source_file", "/", folders)
    settled = spark.createDataFrame(
        [(f, at if now - at >= SETTLED_MS else -1) for f, at in times.items()], "folder string, folder_time long"
    )
    listed = landing.landed_files(spark, root, folders, pattern, within=again).withColumn("folder", folder)
    listed = listed.join(settled, "folder", "left").select(
        "folder", F.coalesce("folder_time", F.lit(-1).cast("long")).alias("folder_time"), "source_file", "modified_at"
    )
    if known is not None:
        stay = sorted(set(times) - set(again))
        listed = listed.unionByName(known.where(F.col("folder").isin(stay)) if stay else known.limit(0))
        if not again and set(before) == set(times):
            return known.select("source_file", "modified_at")
    path = f"{config.path('ops', f'listing_{name}')}-{now}"
    written = storage.write_parquet(listed, path)
    storage.point_to(spark, kept, written, path)
    return written.select("source_file", "modified_at")


def _checks(spark, config: RunConfig) -> quality.QualityChecks:
    storage.create_schemas(spark, config, "bronze", "ops")
    return quality.QualityChecks(spark, config.results_table, config.run_id, "bronze")


def load_cube(spark: SparkSession, config: RunConfig, name: str) -> int:
    """New cube documents, checked against the sizes they declare before anything is appended."""
    table_id, dimensions = C.CUBE_TABLES[name]
    root = f"{config.landing}/{table_id}"
    checks = _checks(spark, config)

    def flatten_and_check(documents: DataFrame) -> DataFrame:
        documents = documents.select(F.col("source_file").alias("_source_file"), "value")
        # Parsed once; outlines and members then read their own fields and not the values.
        parsed = storage.stage(cube.parse(documents), config, f"parsed_{name}")
        pieces = storage.stage(cube.chunks(parsed, text=None), config, f"chunks_{name}")
        rows = storage.stage(cube.expand(cube.spread(pieces), dimensions, C.LABELLED_DIMENSIONS), config, f"rows_{name}")
        outlines = cube.outline(parsed, text=None)
        checks.add(
            quality.declared_size(name, "cells as declared by the sizes", cube.size_report(outlines, rows)),
            quality.Check(name, "dimensions as expected", cube.unexpected_dimensions(outlines, dimensions)),
            quality.Check(name, "members as the sizes say, with codes and labels",
                          cube.wrong_members(parsed, dimensions, C.LABELLED_DIMENSIONS, text=None)),
        )
        checks.enforce("before append", "Nothing was appended.")
        columns = [c for c in rows.columns if c != "_source_file"]
        return rows.select(*columns, F.lit(table_id).alias("_source_table"), "_source_file")

    return _load_new(
        spark, config, name, _listing(spark, config, name, root),
        lambda where: landing.landed_files(spark, root, between=where.between),
        lambda where: landing.read_documents(spark, root, where.between), flatten_and_check,
    )


def price_gaps(spark: SparkSession, config: RunConfig, landed: DataFrame) -> DataFrame:
    """Past (area, day) pairs without a price file, except the accepted ones."""
    accepted = spark.createDataFrame(list(config.known_missing_days), "price_area string, day string").select(
        "price_area", F.to_date("day").alias("price_date")
    )
    return calendar.missing_days(
        landing.present_days(landed), calendar.area_frame(spark, C.PRICE_AREAS),
        F.lit(C.FIRST_PRICE_DATE), config.today(), C.PRICE_GRACE_DAYS, accepted,
    )


def load_prices(spark: SparkSession, config: RunConfig, relist: bool = False) -> int:
    """New price files, after making sure that no past day is missing.

    The folders of this year and the year before are open; older ones are listed when they change, or with ``relist``.
    """
    root, folders = f"{config.landing}/{C.PRICE_FOLDER}", len(landing.PRICE_FOLDERS)
    checks = _checks(spark, config)
    this_year = spark.range(1).select(F.year(config.today())).first()[0]

    def is_open(folder: str) -> bool:
        year = folder.rpartition("=")[2]
        return not year.isdigit() or int(year) >= this_year - 1

    landed = _listing(spark, config, C.PRICE_TABLE, root, folders, is_open=is_open, relist=relist)
    checks.add(quality.calendar_complete(C.PRICE_TABLE, "no past day without a file", price_gaps(spark, config, landed)))
    checks.enforce("before append", "Nothing was appended.")
    return _load_new(
        spark, config, C.PRICE_TABLE, landed,
        lambda where: landing.landed_files(spark, root, folders, between=where.between, within=where.folders),
        lambda where: landing.read_prices(spark, root, where.between, within=where.folders),
        # Price files are small; without the rebalance every read task would append a small file.
        lambda rows: rows.select(
            "elomrade", *landing.PRICE_FIELDS, F.col("source_file").alias("_source_file")
        ).hint("rebalance", "_source_file"),
        folders,
    )


def price_coverage(spark: SparkSession, config: RunConfig) -> DataFrame:
    return coverage_profile(manifest.complete_rows(spark, config, C.PRICE_TABLE), "elomrade", "_source_file", "time_start")


def price_landing_tally(spark: SparkSession, config: RunConfig, before: DataFrame) -> DataFrame:
    """Expected days by status, given the (source_file, modified_at) list from before files landed."""
    areas = calendar.area_frame(spark, C.PRICE_AREAS)
    days = calendar.calendar(F.lit(C.FIRST_PRICE_DATE), config.today())
    after = landing.landed_files(spark, f"{config.landing}/{C.PRICE_FOLDER}", len(landing.PRICE_FOLDERS))
    return calendar.status_tally(calendar.landing_status(
        calendar.expected_days(areas, days), landing.present_days(before), landing.present_days(after),
        ["price_area", "price_date"],
    ))


def cube_worklist(spark: SparkSession, config: RunConfig, name: str, metadata: DataFrame) -> DataFrame:
    """Published periods of the wanted years that have not landed; ``metadata`` holds documents as text."""
    published = cube.members(metadata, "Tid").withColumnRenamed("code", "period")
    landed = landing.landed_files(spark, f"{config.landing}/{C.CUBE_TABLES[name][0]}")
    return calendar.period_worklist(published, landing.present_periods(landed), C.FIRST_STATISTICS_YEAR)


def run(spark: SparkSession, config: RunConfig) -> dict[str, int]:
    """Load everything that is new; the number of files per table."""
    try:
        loaded = {name: load_cube(spark, config, name) for name in C.CUBE_TABLES}
        loaded[C.PRICE_TABLE] = load_prices(spark, config)
    finally:
        storage.drop_stage(spark, config)
    return loaded
