"""Helpers that several operators share: stored results, components and distributed running sums."""

import os
import tempfile
import uuid
import zipfile
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tierwell.config import shared_folder
from tierwell.llm import textscan


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, through Spark's own file transfer."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tierwell-ship-"), "tierwell-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_written: list[str] = []


def drop_unused(docs: DataFrame) -> None:
    """Remove the results stored so far that ``docs`` does not read.

    For a chain of stages, each of which gets what its predecessor returned as a stored table: what the predecessor
    stored on its way is of no more use.
    """
    spark, files = docs.sparkSession, docs.inputFiles()
    read = {file.rsplit("/", 2)[-2] for file in files} | {file.rsplit("/", 3)[-3] for file in files if file.count("/") > 2}
    for path in [p for p in _written if p.rsplit("/", 1)[1] not in read]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _written.remove(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    Cuts the lineage: a lost executor costs no recomputation of what came before, and plans that
    use the result several times read it instead of computing it again.
    """
    path = f"{shared_folder(df.sparkSession)}/tierwell-llm/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, component) per node that has an edge.

    ``component`` is the smallest id that can be reached. Alternating large-star and small-star steps
    (Kiveris et al. 2014): every step points neighbours at the smallest of them, so the number of
    edges never grows, and long chains halve. Each round is stored, and a round that changes nothing ends.
    Hot nodes are met in joins only, which Spark splits, and in minima, which are combined before the shuffle.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    state = _fingerprint(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        )
        current = stored(small, "edges")
        before, state = state, _fingerprint(current)
        if before == state:
            break
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def running(df: DataFrame, keys: list[str], order: list[str], value, name: str, buckets: int = 256) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over earlier rows of the same ``keys``, this row left out.

    ``order`` starts with a column of evenly spread hexadecimal text (a digest); its first two digits deal every
    key into 256 buckets. Sums per bucket are combined before the shuffle, their running sum is over at most
    256 rows a key, and only rows of one bucket are sorted together, so a key that holds a third of all rows
    is still spread over 256 groups.
    """
    dealt = df.withColumn("_bucket", F.substring(order[0], 1, 2)).withColumn("_value", value)
    sums = dealt.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_sum"))
    over = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(before, [*keys, "_bucket"])
        .withColumn(name, F.col("_ahead") + F.coalesce(F.sum("_value").over(within), F.lit(0)))
        .drop("_bucket", "_value", "_ahead")
    )


def summed(df: DataFrame, count, size: int, union: bool = False):
    """A numpy array of ``size`` integers that all rows add to, on the driver.

    ``count(state, batch)`` adds an Arrow batch to ``state``. Every task keeps one array, tasks' arrays are added in
    slices by grouped aggregation (``union``: joined by maximum), and the driver gets ``size`` numbers however large
    the input is.
    """
    width = -(-size // 64)
    kind = np.dtype(np.uint8 if union else np.int64)

    def tasks(batches):
        state = np.zeros(width * 64, dtype=kind)
        for batch in batches:
            count(state, batch)
        for part in range(64):
            piece = state[part * width : (part + 1) * width]
            if piece.any():
                yield pa.RecordBatch.from_pydict({"part": [part], "piece": [zlib.compress(piece.tobytes(), 1)]}, schema=_PIECES)

    def add(pieces: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=kind)
        for piece in pieces["piece"]:
            piece = np.frombuffer(zlib.decompress(piece), dtype=kind)
            np.maximum(total, piece, out=total) if union else np.add(total, piece, out=total)
        return pd.DataFrame({"part": pieces["part"].iloc[:1], "piece": [zlib.compress(total.tobytes(), 1)]})

    out = np.zeros(width * 64, dtype=kind)
    pieces = df.mapInArrow(tasks, "part int, piece binary")
    for row in pieces.groupBy("part").applyInPandas(add, "part int, piece binary").collect():
        out[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(row["piece"]), dtype=kind)
    return out[:size]


FILTER_BITS = 25


def _cells(column) -> np.ndarray:
    ids = column.to_numpy(zero_copy_only=False).view(np.uint64)
    return (textscan.mixed(ids) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame):
    """A broadcast filter of fixed size (2**25 bits, hashed) of the column doc_id."""

    def mark(state, batch):
        state[_cells(batch.column(0))] = 1

    known = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    return ids.sparkSession.sparkContext.broadcast(np.packbits(summed(known, mark, 1 << FILTER_BITS, union=True)))


def only_near(df: DataFrame, marks, others: bool = False) -> DataFrame:
    """The rows of ``df`` (long doc_id first, not null) that the filter ``marks`` lets pass, or the ``others``.

    All rows of the filter's ids pass, and a few more. It drops most rows before a join would shuffle their text; with
    more ids than bits it drops fewer, and the exact join after it does the work.
    """

    def keep(batches):
        for batch in batches:
            cell = _cells(batch.column(0))
            hit = ((marks.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1).astype(bool)
            yield batch.filter(pa.array(hit != others))

    return df.mapInArrow(keep, df.schema)


_PIECES = pa.schema([("part", pa.int32()), ("piece", pa.binary())])
