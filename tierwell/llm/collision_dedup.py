"""Embedding near-dedup (operator 9): collision counting over one-dimensional projections (C2LSH, QALSH).

Vectors of one label link when their cosine is at least ``cosine``. Unit vectors that close lie within a distance d, and on a
random direction their projections differ by a normal variable of deviation d at most. So:

* equal vectors of a label are one representative with a weight, so that a group of copies is compared once;
* every representative is projected on ``projections`` seeded directions. Per projection the values are sorted, and a
  window of two deviations to either side of a query's own value collides with it: two ranks per query;
* collisions are counted for all queries of a block at once: windows are ranges of a sorted projection, kept as sets
  of 64 places a word, and misses are added up in bit planes. Candidates that have missed too often leave the
  count, most of them after half of the projections;
* pairs that reach the calibrated count are verified by their cosine in double precision. The count is the largest one
  that a pair at exactly the limit reaches with probability ``recall``; closer pairs reach it more often;
* the first projections also deal vectors into cells of four deviations; pairs at the limit lie in one cell or neighbouring
  ones but for one in 8,000 a projection, so cells meet their neighbours only. The number of projections that deal
  follows from the size of the label (one more for each factor of five), so the share of pairs that meet falls as the table grows.

Cells are cut into blocks of bounded size, a hot cell into many, and blocks meet blocks: a group of near copies that holds
a third of all vectors is worked on by many tasks, and none of its pairs becomes a row. A meeting of two blocks yields
each vector's number of links, and for components one edge per linked vector.

Measured recall is in the tests. Cases: vectors that are null, empty, zero or hold null or non-finite components, and
null labels, link with nothing and stay; vectors of different dimension don't link; rows that share an id are one
vector, the one of the smallest bytes; an empty table gives no rows; extra columns are ignored.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm.common import components, stored
from tierwell.llm.vectors import rows_of

PROJECTIONS, BLOCK, RECALL, SEED = 32, 2048, 0.9995, 20240301
DEALING = 6  # projections that deal into cells, at most


def distance(cosine: float) -> float:
    return math.sqrt(2 - 2 * cosine)


def calibrated_count(projections: int, recall: float, deviations: float = 2.0) -> int:
    """The largest number of collisions that a pair at the limit reaches with probability ``recall``."""
    p = math.erf(deviations / math.sqrt(2))
    reached = 0.0
    for count in range(projections, 0, -1):
        reached += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if reached >= recall:
            return count
    return 1


def directions(dim: int, projections: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((dim, projections))


def collisions(x: np.ndarray, y: np.ndarray, width: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of the pairs that collide on ``least`` projections or more.

    Windows of a projection are ranges of its sorted values; with one row of bits per rank (everything sorted before it),
    a window's members are the difference of two rows. Misses are counted in bit planes that start so that the first
    miss too many carries out of the last plane. Words without a pair left are dropped on the way.
    """
    projections, n = x.shape[1], len(y)
    words, none, every = -(-n // 64), np.uint64(0), np.uint64(2**64 - 1)
    spare = projections - least
    planes = spare.bit_length()
    start = (1 << planes) - 1 - spare
    count = [np.full((len(x), words), every if start >> i & 1 else none) for i in range(planes)]
    dead = np.zeros((len(x), words), dtype=np.uint64)
    if n % 64:
        dead[:, -1] = every ^ np.uint64((1 << n % 64) - 1)
    row = word = None  # of the words that are left, once most are gone
    rank = np.arange(1, n + 1)
    for done, j in enumerate(range(projections - 1, -1, -1)):  # those that deal last: they tell least inside a cell
        order = np.argsort(y[:, j])
        line = y[order, j]
        before = np.zeros((n + 1, words), dtype=np.uint64)
        before[rank, order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
        np.bitwise_or.accumulate(before, axis=0, out=before)
        by_value = np.argsort(x[:, j])
        own, first, last = x[by_value, j], np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.int64)
        first[by_value] = np.searchsorted(line, own - width, side="left")
        last[by_value] = np.searchsorted(line, own + width, side="right")
        if row is None:
            miss = before[last]
            miss ^= before[first]
        else:
            miss = before[last[row], word] ^ before[first[row], word]
        np.invert(miss, out=miss)
        for plane in count:
            carry = plane & miss
            plane ^= miss
            miss = carry
        dead |= miss
        if done >= 2 * spare and done % 2 == 0:
            alive = dead != every
            row, word = np.nonzero(alive) if row is None else (row[alive], word[alive])
            dead, count = dead[alive], [plane[alive] for plane in count]
            if not len(row):
                break
    if row is None:
        row, word = np.divmod(np.arange(dead.size), words)
        dead = dead.reshape(-1)
    bits = np.unpackbits((~dead).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    found, bit = np.nonzero(bits)
    return row[found], word[found] * 64 + bit


def cosines(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (x, y) of unit vectors; a share of them at a time."""
    out = np.empty(len(x))
    for at in range(0, len(x), 65536):
        part = slice(at, at + 65536)
        out[part] = np.einsum("ij,ij->i", a[x[part]], b[y[part]])
    return out


def local_components(x: np.ndarray, y: np.ndarray, ids_x: np.ndarray, ids_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) from each vector of the links (x, y) to the smallest id that links within the meeting reach."""
    left, right = ids_x.copy(), ids_y.copy()
    while len(x):
        least = np.minimum(left[x], right[y])
        new_left, new_right = left.copy(), right.copy()
        np.minimum.at(new_left, x, least)
        np.minimum.at(new_right, y, least)
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    a, b = np.concatenate([ids_x, ids_y]), np.concatenate([left, right])
    return a[a != b], b[a != b]


_UNITS = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("raw", pa.binary()), ("cells", pa.list_(pa.int64()))])
_UNITS_SQL = "vec_id long, label string, dim int, raw binary, cells array<long>"
_FOUND_SQL = "vec_id long, n long, other long"


def _placed(vectors: DataFrame, projections: int, cell: float) -> DataFrame:
    """Vectors that can link, as bytes, with their cells on the first projections."""

    def rows(batches):
        for batch in batches:
            index, found = rows_of(batch.column("embedding"))
            keep = [i for i, v in zip(index, found) if np.abs(v).max() > 0]
            found = [v / np.abs(v).max() for v in found if np.abs(v).max() > 0]
            cells = []
            for v in found:
                p = (v / np.sqrt(v @ v)) @ directions(len(v), projections)[:, :DEALING]
                cells.append(np.floor(p / cell).astype(np.int64))
            part = batch.select(["vec_id", "label"]).take(pa.array(keep, pa.int64()))
            kind = batch.column("embedding").type.value_type
            raw = batch.column("embedding").take(pa.array(keep, pa.int64())).to_pylist()
            size = "<f4" if pa.types.is_float32(kind) else "<f8"
            yield pa.RecordBatch.from_arrays([
                *part.columns, pa.array([len(v) for v in found], pa.int32()),
                pa.array([size.encode() + np.array(v, dtype=size).tobytes() for v in raw], pa.binary()),
                pa.array(cells, pa.list_(pa.int64())),
            ], schema=_UNITS)

    return vectors.mapInArrow(rows, _UNITS_SQL)


def _steps(spark, most: int) -> DataFrame:
    """(axes, step): the cell itself and half of its neighbours, for 1 to ``most`` dealing projections."""
    rows = [
        (axes, list(step)) for axes in range(1, most + 1)
        for step in itertools.product((-1, 0, 1), repeat=axes) if step >= (0,) * axes
    ]
    return spark.createDataFrame(rows, "axes int, step array<long>")


def _units(column, i: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    items = column.slice(i, 1).flatten()
    found = np.empty((len(items), dim))
    for j, raw in enumerate(items.field("raw").to_pylist()):
        v = np.frombuffer(raw[3:], dtype=raw[:3].decode()).astype(np.float64)
        v = v / np.abs(v).max()
        found[j] = v / np.sqrt(v @ v)
    return items.field("vec_id").to_numpy(), items.field("weight").to_numpy(), found


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.98, projections: int = PROJECTIONS, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector (vec_id, embedding, label)."""
    limit = distance(cosine)
    width, least = 2 * limit, calibrated_count(projections, recall)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label")
    ).where("vec_id IS NOT NULL")
    able = _placed(rows.where("label IS NOT NULL"), projections, 4 * limit)
    one_each = able.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "raw", "cells")).alias("v"))
    placed = stored(one_each.select("vec_id", "v.*", F.sha2("v.raw", 256).alias("digest")), "placed")
    # Equal vectors: the smallest id stands for all. Sums and minima are combined before the shuffle.
    unique = placed.groupBy("label", "digest").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.min(F.struct("dim", "raw", "cells")).alias("v")
    ).select("label", "vec_id", "weight", "v.*")
    unique = stored(unique, "unique")
    axes = F.least(F.lit(DEALING), F.greatest(F.lit(1), 1 + F.round(F.log(F.greatest(F.col("n") / block, F.lit(1.0))) / math.log(5)))).cast("int")
    dealt = unique.join(unique.groupBy("label", "dim").agg(F.count("*").alias("n")).select("label", "dim", axes.alias("axes")), ["label", "dim"])
    dealt = dealt.withColumn("cell", F.expr("slice(cells, 1, axes)"))
    cell = ["label", "dim", "cell"]
    sizes = stored(dealt.groupBy(*cell).agg(F.ceil(F.count("*") / block).alias("blocks")), "cells")
    packed = stored(
        dealt.join(sizes, cell).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
        .groupBy(*cell, "part").agg(F.collect_list(F.struct("vec_id", "weight", "raw")).alias("members")), "blocks",
    )
    # Meetings of blocks: within a cell each pair of blocks once, and with half of the neighbours.
    left = sizes.withColumn("axes", F.size("cell")).join(_steps(vectors.sparkSession, DEALING), "axes").select(
        *[F.col(c).alias(f"x_{c}") for c in cell], F.col("blocks").alias("x_blocks"),
        "label", "dim", F.zip_with("cell", "step", lambda c, d: c + d).alias("cell"),
        (~F.exists("step", lambda d: d != 0)).alias("inside"),
    )
    meetings = left.join(sizes, cell).withColumn(
        "x_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("x_blocks") - 1))
    ).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("NOT inside OR x_part <= part")
    x = packed.select(*[F.col(c).alias(f"x_{c}") for c in [*cell, "part"]], F.col("members").alias("x_members"))
    joined = meetings.join(packed, [*cell, "part"]).join(x, [f"x_{c}" for c in [*cell, "part"]]).select(
        "dim", (F.col("inside") & (F.col("x_part") == F.col("part"))).alias("same"), "x_members", "members"
    )

    def meet(batches):
        for batch in batches:
            for i, dim in enumerate(batch.column("dim").to_pylist()):
                ids_x, weight_x, a = _units(batch.column("x_members"), i, dim)
                same = batch.column("same")[i].as_py()
                ids_y, weight_y, b = (ids_x, weight_x, a) if same else _units(batch.column("members"), i, dim)
                to = directions(dim, projections)
                x, y = collisions(a @ to, b @ to, width, least)
                if same:
                    x, y = x[x != y], y[x != y]
                close = cosines(a, b, x, y) >= cosine
                x, y = x[close], y[close]
                if not len(x):
                    continue
                n = np.bincount(x, weights=weight_y[y], minlength=len(ids_x))
                if not same:
                    n = np.concatenate([n, np.bincount(y, weights=weight_x[x], minlength=len(ids_y))])
                ids = ids_x if same else np.concatenate([ids_x, ids_y])
                some = n > 0
                edge_a, edge_b = local_components(x, y, ids_x, ids_y)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([ids[some], edge_a])),
                    pa.array(np.concatenate([n[some].astype(np.int64), np.zeros(len(edge_a), dtype=np.int64)])),
                    pa.array(np.concatenate([np.full(int(some.sum()), -1), edge_b]), mask=np.concatenate([np.ones(int(some.sum()), bool), np.zeros(len(edge_b), bool)])),
                ], ["vec_id", "n", "other"])

    found = stored(joined.mapInArrow(meet, _FOUND_SQL), "links")
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    groups = components(found.where("other IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    same_vector = placed.groupBy("label", "digest").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
    told = same_vector.join(links, "vec_id", "left").join(groups, same_vector.vec_id == groups.id, "left").select(
        "label", "digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component"),
    )
    members = placed.select("vec_id", "label", "digest").join(told, ["label", "digest"]).drop("label", "digest")
    ids = rows.select("vec_id").distinct()
    component = F.coalesce("component", "vec_id")
    return ids.join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
