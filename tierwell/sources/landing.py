"""Landed JSON files: listing, lineage and reading.

Files are listed and read by executors through Spark's file sources.  ``source_file`` is the
path below the landing root, so a moved root does not make old files look new.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

JSON_FILES = "*.json"
PRICE_FIELDS = ("time_start", "time_end", "SEK_per_kWh", "EUR_per_kWh", "EXR")
PRICE_FOLDERS = ("elomrade", "ar")

#: A byte that no JSON text in UTF-8 holds: with it as the line end a file is one line, and one in UTF-16 is malformed.
NO_LINE_END = "\0"

_MODIFIED = "_metadata.file_modification_time"


def source_file(folders: int = 0) -> Column:
    """The file name with the given number of folders in front of it."""
    return F.substring_index("_metadata.file_path", "/", -(folders + 1))


def _paths(root: str, within) -> list[str]:
    return [root] if within is None else [f"{root}/{folder}" for folder in within]


def landed_files(spark: SparkSession, root: str, folders: int = 0, pattern: str = JSON_FILES,
                 between: tuple | None = None, within=None) -> DataFrame:
    """(source_file, modified_at) of every landed file, or of those in an interval and ``within`` some folders below the
    root; the contents are not read, and other folders are not listed.

    A root that does not exist yet holds no files.
    """
    nothing = spark.createDataFrame([], "source_file string, modified_at timestamp")
    if within is not None and not within:
        return nothing
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(_paths(root, within))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing
    return with_lineage(files.select("path", "_metadata"), folders, between).select("source_file", "modified_at")


def folder_times(spark: SparkSession, root: str, folders: int) -> dict[str, int]:
    """Folders at that depth below the root, with the time (milliseconds) at which a file last appeared in them or went.

    One entry per folder, however many files they hold.  Stores without real folders say 0.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{'/'.join('*' * folders)}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return {
        "/".join(status.getPath().toString().split("/")[-folders:]): status.getModificationTime()
        for status in found if status.isDirectory()
    }


def with_lineage(df: DataFrame, folders: int, between: tuple | None) -> DataFrame:
    """Adds file lineage; ``between`` limits the read to files modified in that closed interval of microseconds.

    The limit is on file metadata, so Spark drops the other files before any task reads them.
    """
    rows = df if between is None else df.where(F.col(_MODIFIED).between(*[F.timestamp_micros(F.lit(t)) for t in between]))
    return rows.select("*", source_file(folders).alias("source_file"), F.col(_MODIFIED).alias("modified_at"))


def read_prices(spark: SparkSession, root: str, between: tuple | None = None, whole_files: bool = True,
                pattern: str = JSON_FILES, within=None) -> DataFrame:
    """Price rows as text: one file holds one array of periods, missing fields become NULL.

    ``within`` limits the read to folders below the root.

    The folder columns are part of the schema, as text, so codes keep their form and no folder
    value is guessed to be a number.  ``whole_files=False`` reads one period (or array of them)
    per line instead, which lets Spark split large files.  Malformed JSON fails the job.

    A whole file is read as one line.  ``multiLine`` would open the file again for each number that is
    kept as text, and read some KB of it each time.
    """
    schema = ", ".join(f"{name} string" for name in (*PRICE_FIELDS, *PRICE_FOLDERS))
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if whole_files:
        reader = reader.option("lineSep", NO_LINE_END)
    files = reader.option("pathGlobFilter", pattern).option("basePath", root).json(_paths(root, within))
    rows = with_lineage(files, len(PRICE_FOLDERS), between)
    return rows.select("elomrade", *PRICE_FIELDS, "source_file", "modified_at")


def read_documents(spark: SparkSession, root: str, between: tuple | None = None) -> DataFrame:
    """Whole landed documents as text, one row per file."""
    texts = spark.read.option("wholetext", True).option("pathGlobFilter", JSON_FILES).text(root)
    return with_lineage(texts, 0, between)


def present_days(landed: DataFrame) -> DataFrame:
    """(price_area, price_date) that have a file, from ``elomrade=X/ar=Y/<day>.json`` paths."""
    path = F.col("source_file")
    area = F.substring_index(F.substring_index(path, "/", 1), "=", -1)
    day = F.try_to_date(F.regexp_replace(F.substring_index(path, "/", -1), r"\.json$", ""), "yyyy-MM-dd")
    return landed.select(area.alias("price_area"), day.alias("price_date")).where("price_date IS NOT NULL").distinct()


def present_periods(landed: DataFrame) -> DataFrame:
    """Period codes that have a file, from ``<table>_<period>.json`` names."""
    period = F.regexp_extract("source_file", r"^.*_([^_]+)\.json$", 1)
    return landed.select(period.alias("period")).distinct()


def price_file(area: Column, day: Column) -> Column:
    """The path a day's price file lands under."""
    return F.concat(
        F.lit("elomrade="), area, F.lit("/ar="), F.year(day).cast("string"),
        F.lit("/"), F.date_format(day, "yyyy-MM-dd"), F.lit(".json"),
    )
