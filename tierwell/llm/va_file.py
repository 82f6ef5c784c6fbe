"""Exact top-k search (operator 7): vector-approximation files (Weber, Schek and Blott 1998) for inner products.

Components become whole numbers, floor(scale * x). Every dimension's range is cut into 256 cells; a vector's
approximation is its cells, one byte per dimension, a block of vectors one row. A cell bounds its components from both
sides, so approximations bound every score.

1. Scan: each group of queries meets each tile of blocks of approximations and keeps the k largest lower bounds of each query.
   The k-th largest over all tiles is a score that k vectors reach: the query's threshold.
2. Scan again: vectors whose upper bound reaches the threshold are candidates, with their bound.
3. Read exact vectors in the order of their bounds: first the 2k candidates of the largest bounds. Their k-th exact score
   is certain to be reached, so of the other candidates only those with a larger or equal bound are read, and the k best
   of all that were read are the result. It is exact; nothing is cut off.

The queries are a stated set against all rows. Blocks go to a task once for each group, queries once for each tile; both
numbers follow from what a task should compute and hold, and neither side is ever broadcast: a plan can't know how often
rows are repeated for a meeting. Approximations, not vectors, are scanned; exact vectors are joined by id, for candidates only.

Cases: vectors that are null, empty or hold null or non-finite components take no part; vectors meet only those of their
dimension; components may be of any size (they are kept as doubles, which hold such whole numbers exactly, and bounds are
widened by what rounding can change), but a score of the result has to fit into 64 bits; ties go to the smaller
id; of rows that share an id the one of the smallest numbers counts; an empty table gives no rows. Extra
columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tierwell.llm.common import stored
from tierwell.llm.vectors import rows_of

CELLS, BLOCK, QUERY_BLOCK = 256, 4096, 256
#: Pairs of a block and a query block that a task should see, up to so many meetings; blocks and query blocks of one meeting at most.
MEETING, MEETINGS, TILE, GROUP = 64, 256, 128, 128
#: Below this all products and sums of whole numbers are exact in 64-bit integers for any usual dimension.
SMALL = float(1 << 26)

_WHOLE_SQL = "vec_id long, dim int, whole binary"


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dim, whole): floor(scale * x) of the vectors that take part, as little-endian doubles."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("whole", pa.binary())])

    def rows(batches):
        for batch in batches:
            index, found = rows_of(batch.column(1))
            sizes = np.array([len(v) for v in found], dtype=np.int32)
            out = np.floor(scale * np.concatenate(found)).astype("<f8").tobytes() if found else b""
            ends = (8 * np.append(0, np.cumsum(sizes))).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index)), pa.array(sizes), pa.array([out[a:b] for a, b in zip(ends, ends[1:])], pa.binary())],
                schema=schema,
            )

    return vectors.mapInArrow(rows, _WHOLE_SQL)


def _unpack(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f8").reshape(-1, dim)


def _by_dim(batch):
    """(dim, rows, their numbers as a matrix) for each length of the vectors in a batch."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, _unpack(b"".join(batch.column("whole").take(pa.array(rows)).to_pylist()), dim)


def _edges(ranges: tuple[bytes, bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension, the least number of each cell and one that none of its numbers exceeds. Cells are told by ``first``."""
    low, high = (np.frombuffer(x, dtype="<f8") for x in ranges)
    step = np.ceil(high / CELLS - low / CELLS + 1 / CELLS)
    first = np.minimum(low[:, None] + step[:, None] * np.arange(CELLS), high[:, None])
    first[:, 0] = low
    after = first[:, 1:]
    last = np.where(np.abs(after) <= 2.0**52, np.maximum(after - 1, first[:, :-1]), after)  # whole numbers, as far as doubles hold them
    return first, np.concatenate([last, high[:, None]], axis=1)


def dot(x: np.ndarray, y: np.ndarray) -> int:
    """The exact inner product of whole numbers that are held as doubles."""
    if max(np.abs(x).max(), np.abs(y).max()) <= SMALL and len(x) < 1 << 11:
        return int(x.astype(np.int64) @ y.astype(np.int64))
    return sum(int(a) * int(b) for a, b in zip(x.tolist(), y.tolist()))


def _ranges(whole: DataFrame) -> dict[int, tuple[bytes, bytes]]:
    """Least and largest component per dimension, for each length of vectors: tasks' extremes, then theirs."""

    def extremes(batches):
        found: dict[int, tuple] = {}
        for batch in batches:
            for dim, _, v in _by_dim(batch):
                least, most = v.min(axis=0), v.max(axis=0)
                found[dim] = (np.minimum(found[dim][0], least), np.maximum(found[dim][1], most)) if dim in found else (least, most)
        if found:
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array(list(found), pa.int32()),
                "low": pa.array([a.tolist() for a, _ in found.values()], pa.list_(pa.float64())),
                "high": pa.array([b.tolist() for _, b in found.values()], pa.list_(pa.float64())),
            })

    parts = whole.mapInArrow(extremes, "dim int, low array<double>, high array<double>")
    parts = parts.select("dim", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x"))
    ends = parts.groupBy("dim", "i").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    out: dict[int, list] = {}
    for row in ends.orderBy("dim", "i").collect():  # dimensions, not rows
        out.setdefault(row["dim"], []).append((row["low"], row["high"]))
    return {d: tuple(np.array(x, dtype="<f8").tobytes() for x in zip(*ends)) for d, ends in out.items()}


def _approximated(whole: DataFrame, ranges: dict) -> DataFrame:
    """Blocks (dim, block, ids, cells) of approximations."""

    def cells(batches):
        edges = {}
        for batch in batches:
            out = [b""] * batch.num_rows
            for dim, rows, v in _by_dim(batch):
                if dim not in edges:
                    edges[dim] = _edges(ranges[dim], dim)[0]
                told = np.empty(v.shape, dtype=np.uint8)
                for i, first in enumerate(edges[dim]):
                    told[:, i] = np.searchsorted(first[1:], v[:, i], side="right")
                for row, raw in zip(rows.tolist(), told):
                    out[row] = raw.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("dim"), pa.array(out, pa.binary())], ["vec_id", "dim", "cells"])

    counts = {row["dim"]: row["count"] for row in whole.groupBy("dim").count().collect()}
    blocks = F.lit(1)
    for dim, n in counts.items():
        blocks = F.when(F.col("dim") == dim, -(-n // BLOCK)).otherwise(blocks)
    spread = whole.mapInArrow(cells, "vec_id long, dim int, cells binary").withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "cells"), blocks.cast("long")).cast("int")
    )
    packed = spread.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "cells")).alias("members"))
    packed = packed.select("dim", "block", F.col("members.vec_id").alias("ids"), F.col("members.cells").alias("data"))
    return stored(packed, "cells"), {d: -(-n // BLOCK) for d, n in counts.items()}


def tiling(blocks: int, parts: int, dim: int) -> tuple[int, int]:
    """Blocks of a tile and query blocks of a group, so that about as little as possible is moved for the number of meetings."""
    meetings = min(max(1, blocks * parts // MEETING), MEETINGS)
    ratio = parts * QUERY_BLOCK * (8 * dim + 16) / (blocks * BLOCK * (dim + 8))
    groups = min(max(round((meetings * ratio) ** 0.5), -(-parts // GROUP), 1), parts)
    tiles = min(max(-(-meetings // groups), -(-blocks // TILE)), blocks)
    return -(-blocks // tiles), -(-parts // groups)


class Asked:
    """Queries of one group, and how far their scores with a vector may be from those with the middles of its cells."""

    def __init__(self, rows, edges, dim: int):
        self.names = np.concatenate([np.array(r[0], dtype=np.int64) for r in rows])
        q = _unpack(b"".join(x for r in rows for x in r[1]), dim)
        self.reached = np.concatenate([np.array(r[2] or [-np.inf] * len(r[0])) for r in rows])
        first, last = edges
        middle = first / 2 + last / 2
        largest = np.maximum(np.abs(first), np.abs(last)).max(axis=1)
        off, size = (np.abs(q) @ x for x in (np.maximum(middle - first, last - middle).max(axis=1), largest))
        room = size * (4 * (dim + 4))
        single = max(np.abs(q).max(), largest.max()) < 2.0**40 and (room * np.finfo(np.float32).eps <= off / 8).all()
        kind = np.float32 if single else np.float64
        self.off = off + room * np.finfo(kind).eps
        self.q, self.middle, self.dims = q.astype(kind), middle.astype(kind), np.arange(dim)

    def scores(self, cells: np.ndarray):
        """(first query, scores of some queries with all middles); what is too large for a double is not finite."""
        middles = self.middle[self.dims, cells].T
        for at in range(0, len(self.q), 512):
            with np.errstate(over="ignore", invalid="ignore"):
                yield at, self.q[at : at + 512] @ middles


def meetings(batches, ranges: dict):
    """(queries, ids, cells) of each block, in a stream sorted by meeting whose queries come first."""
    key, held, asked, edges = None, [], None, {}
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "group", "tile"))))
        kinds = batch.column("block").to_numpy()
        for i, here in enumerate(keys):
            if here != key:
                key, held, asked = here, [], None
            dim, data = here[0], batch.column("data").slice(i, 1).flatten()
            ids = batch.column("ids").slice(i, 1).flatten().to_numpy()
            if kinds[i] < 0:
                held.append((ids, data.to_pylist(), batch.column("reached")[i].as_py()))
            elif held:
                if asked is None:
                    if dim not in edges:
                        edges[dim] = _edges(ranges[dim], dim)
                    asked = Asked(held, edges[dim], dim)
                yield asked, ids, np.frombuffer(b"".join(data.to_pylist()), dtype=np.uint8).reshape(-1, dim)


def reaching(scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores that reach their row's ``least``; few rows have any."""
    some = np.flatnonzero(scores.max(axis=1) >= least)
    row, column = np.nonzero(scores[some] >= least[some, None])
    return some[row], column


def _raise(best: np.ndarray, scores: np.ndarray) -> None:
    """``best`` (k values a row, in no order) becomes the k largest of its own and those of ``scores``."""
    k, n = best.shape[1], scores.shape[1]
    if n > k and not np.isfinite(best).any():
        best[:] = np.partition(scores, n - k, axis=1)[:, n - k :]
        return
    row, column = reaching(scores, np.nextafter(best.min(axis=1), best.dtype.type(np.inf)))
    if not len(row):
        return
    changed = np.unique(row)
    value = np.concatenate([scores[row, column], best[changed].ravel()])
    row = np.concatenate([row, np.repeat(changed, k)])
    order = np.lexsort((-value, row))
    row, value = row[order], value[order]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    best[changed] = value[heads[:, None] + np.arange(k)]


def top_k(vectors: DataFrame, wanted: str, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of each query (rows where ``wanted`` holds).

    ``vectors``: vec_id, embedding.
    """
    taking_part = whole_numbers(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id IS NOT NULL"), scale)
    one_each = taking_part.groupBy("vec_id").agg(F.min(F.struct("dim", "whole")).alias("v"))
    whole = stored(one_each.select("vec_id", "v.dim", "v.whole"), "whole")
    ranges = _ranges(whole)
    blocks, counts = _approximated(whole, ranges)
    shares = {row["dim"]: -(-row["count"] // QUERY_BLOCK) for row in whole.where(wanted).groupBy("dim").count().collect()}
    tilings = {dim: tiling(counts[dim], n, dim) for dim, n in shares.items()}

    def of_dim(values: dict):
        out = F.lit(None).cast("int")
        for dim, x in values.items():
            out = F.when(F.col("dim") == dim, x).otherwise(out)
        return out

    part = F.pmod(F.xxhash64("vec_id"), of_dim(shares).cast("long")).cast("int")
    per_tile, per_group = (of_dim({d: x[i] for d, x in tilings.items()}) for i in range(2))
    tiles, groups = (of_dim({d: -(-n // tilings[d][i]) for d, n in x.items() if d in tilings}) for i, x in enumerate((counts, shares)))
    asked = whole.where(wanted).withColumn("part", part).groupBy("dim", "part")
    asked = stored(asked.agg(F.sort_array(F.collect_list(F.struct("vec_id", "whole"))).alias("queries")), "queries")

    def met(queries: DataFrame) -> DataFrame:
        ours = queries.select(
            "dim", F.floor(F.col("part") / per_group).cast("int").alias("group"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"),
            F.lit(-1).alias("block"), F.col("queries.vec_id").alias("ids"), F.col("queries.whole").alias("data"), "reached",
        )
        theirs = blocks.select(
            "dim", F.explode(F.sequence(F.lit(0), groups - 1)).alias("group"), F.floor(F.col("block") / per_tile).cast("int").alias("tile"),
            "block", "ids", "data", F.lit(None).cast("array<double>").alias("reached"),
        )
        return ours.unionByName(theirs).repartition("dim", "group", "tile").sortWithinPartitions("dim", "group", "tile", "block")

    def scan(batches):
        last, best = None, None
        for queries, ids, cells in meetings(batches, ranges):
            if queries is not last:
                if last is not None:
                    yield _lower(last, best)
                last, best = queries, np.full((len(queries.names), k), -np.inf, dtype=queries.q.dtype)
            order = np.argsort(ids)
            at = order[np.minimum(np.searchsorted(ids, queries.names, sorter=order), len(ids) - 1)]
            own = ids[at] == queries.names
            for start, scores in queries.scores(cells):
                some = slice(start, start + len(scores))
                scores[np.flatnonzero(own[some]), at[some][own[some]]] = -np.inf
                if scores.dtype == np.float64:
                    scores[~np.isfinite(scores)] = -np.inf
                _raise(best[some], scores)
        if last is not None:
            yield _lower(last, best)

    def _lower(queries: Asked, best: np.ndarray) -> pa.RecordBatch:
        low = (best.astype(np.float64) - queries.off[:, None]).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1) * k, pa.int32()), pa.array(low))
        return pa.RecordBatch.from_arrays([pa.array(queries.names), lists], ["query_id", "low"])

    lows = met(asked.withColumn("reached", F.lit(None).cast("array<double>"))).mapInArrow(scan, "query_id long, low array<double>")
    largest = F.sort_array(F.flatten(F.collect_list("low")), asc=False)
    sure = stored(lows.groupBy("query_id").agg(F.get(largest, F.lit(k - 1)).alias("reached")), "thresholds")
    flat = asked.select("dim", "part", F.explode("queries").alias("q")).join(sure, F.col("q.vec_id") == F.col("query_id"), "left")
    second = flat.groupBy("dim", "part").agg(
        F.sort_array(F.collect_list(F.struct("q.vec_id", "q.whole", F.coalesce("reached", F.lit(float("-inf"))).alias("reached")))).alias("queries")
    )
    second = stored(second.withColumn("reached", F.col("queries.reached")), "reached")

    def candidates(batches):
        for queries, ids, cells in meetings(batches, ranges):
            for start, scores in queries.scores(cells):
                some = slice(start, start + len(scores))
                least = queries.reached[some] - queries.off[some]
                if scores.dtype == np.float32:
                    a, b = reaching(scores, np.nextafter(least.astype(np.float32), np.float32(-np.inf)))
                else:
                    a, b = np.nonzero(~(scores < least[:, None]) | ~np.isfinite(scores))
                bound = scores[a, b].astype(np.float64) + queries.off[some][a]
                bound[~np.isfinite(bound)] = np.inf
                name, vec = queries.names[some][a], ids[b]
                other = name != vec
                yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (name, vec, bound)], ["query_id", "vec_id", "bound"])

    near = stored(met(second).mapInArrow(candidates, "query_id long, vec_id long, bound double"), "candidates")
    exact = whole.select("vec_id", "dim", "whole")
    asks = whole.where(wanted).select(F.col("vec_id").alias("query_id"), F.col("dim").alias("q_dim"), F.col("whole").alias("q"))

    def score(batches):
        for batch in batches:
            found = [
                dot(np.frombuffer(x, "<f8"), np.frombuffer(y, "<f8"))
                for x, y in zip(batch.column("q").to_pylist(), batch.column("whole").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(found, pa.int64())], ["query_id", "vec_id", "score"])

    def read(some: DataFrame) -> DataFrame:
        joined = some.join(exact, "vec_id").join(asks, "query_id").where("dim = q_dim")
        return joined.select("query_id", "vec_id", "q", "whole").mapInArrow(score, "query_id long, vec_id long, score long")

    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("place", F.row_number().over(by_bound))
    first = stored(read(ranked.where(F.col("place") <= 2 * k)), "first")
    kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    # As a double the k-th score may round up by a part in 2**53.
    least = F.col("kth").cast("double") - F.abs(F.col("kth").cast("double")) * F.lit(2.0**-50)
    rest = ranked.where(F.col("place") > 2 * k).join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("bound") >= least))
    every = first.unionByName(read(rest.select("query_id", "vec_id", "bound")))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
