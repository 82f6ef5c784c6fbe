"""N-gram Jaccard join (operator 8): exact similarity of shingle sets by a size-aware heavy-light join.

A document's set holds its distinct k-word shingles. Two documents link when
``100 * |A & B| >= percent * |A | B|``, that is when they share ``o(a, b) = ceil(percent (a + b) / (100 + percent))``
shingles. After Deng, Tao and Li, "Overlap Set Similarity Joins with Theoretical Guarantees" (2018):

* equal sets are found by their digest, and one document stands for them from there on;
* *light* sets (up to a boundary x) enumerate their subsets of o(a, b) shingles for each partner size; two light
  sets that share such a subset link, without any check;
* *heavy* sets, and light ones that a heavy set can reach, enter inverted lists of the shingles in their prefix: the
  rarest ``a - ceil(percent a / 100) + 1`` ones, of which partners always share one. The lists are scanned for
  pairs that the length and position bounds allow, and those are verified on whole sets;
* before that, parity bitmaps of the sets bound the size of the difference from below and drop pairs that cannot link
  (shared passages, mostly): first a short one of fixed length, then one of about a bit per shingle. No link is dropped;
* x is the boundary of the least cost: subset keys against list entries times what an entry meets. That is at most the
  mean length of a list and at most ``MEETINGS``, as members meet the head of their list and not each other.

No list emits all its pairs: first every member meets only the smallest id of its list; lists whose members are then in
one component are done, and only members of different components meet each other. A group of thousands of near
copies thus costs as many pairs as it has list entries. Rarity comes from a sketch of fixed size over all documents;
it orders the shingles (any order is right, rare first is fast), it decides nothing else.

Nulls, empty texts and texts without words have an empty set and link with nothing. Texts of fewer than k words
have one shingle, the whole sequence. Extra columns are ignored; ids are expected to be unique, rows that
share an id count as one document of the smaller digest.
"""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm import textscan
from tierwell.llm.common import components, id_filter, only_near, stored, summed

#: Cells of the rarity sketch, largest set that may count as light.
SKETCH, LIGHT_LIMIT = 1 << 20, 24
#: What an entry of a long list costs, in subset keys: it meets the list's smallest id, is verified, and gets a label.
MEETINGS = 8
#: 64-bit words of a set's parity bitmap.
BITMAP = 16


def overlap(a, b, percent):
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent):
    return n - (-(-percent * n // 100)) + 1


def subset_keys(n: int, percent: int, limit: int) -> list[tuple[int, int]]:
    """(partner size, shared shingles) of the partners of a light set of ``n``, up to ``limit``."""
    return [(m, overlap(n, m, percent)) for m in range(1, limit + 1) if overlap(n, m, percent) <= min(n, m)]


def boundary(sizes: np.ndarray, sketch: np.ndarray, percent: int) -> int:
    """The light-heavy boundary of the least cost, from the number of sets of each size and the rarity sketch."""
    total = max(int(sketch.sum()), 1)
    met = max(1.0, float((sketch.astype(float) ** 2).sum() / total - total / len(sketch)))
    cost = []
    for x in range(LIGHT_LIMIT + 1):
        light = sum(
            int(sizes[n]) * sum(math.comb(n, c) for _, c in subset_keys(n, percent, x)) for n in range(1, x + 1)
        )
        lists = sum(
            int(sizes[n]) * prefix_length(n, percent) * min(met, MEETINGS)
            for n in range(1, LIGHT_LIMIT + 1) if n > x or 100 * n >= percent * (x + 1)
        )
        cost.append((light + lists, x))
    return min(cost)[1]


def _signature(shingles: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        low = textscan.mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
        high = textscan.mixed(shingles * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(low.astype(np.int64)), int(high.astype(np.int64))


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles falls on i: |A ^ B| is at least the number of bits that differ."""
    cells = (textscan.mixed(shingles + np.uint64(1)) >> np.uint64(54)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * BITMAP) & 1).astype(bool)
    return np.packbits(odd).view(np.int64)


def _sketch(shingles: np.ndarray) -> bytes:
    """A parity bitmap of 64 bits or more, about one per shingle, by the low bits of the hash."""
    cells = textscan.mixed(shingles + np.uint64(2))
    size = 1 << max(6, int(len(shingles)).bit_length() - 1)
    odd = np.bincount((cells & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _least_difference(x: bytes, y: bytes) -> int:
    """What two sketches say of the size of the difference; the longer one is folded to the shorter one's length."""
    x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def describe(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document: set size, digest of the set, subset keys if light, prefix if it enters the lists."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id IS NOT NULL")

    def count(state, batch):
        for _, buffer, offsets in textscan.chunks(batch.column(0), batch.column(1)):
            for shingles in textscan.shingle_sets(buffer, offsets, k):
                if len(shingles) <= LIGHT_LIMIT:
                    state[SKETCH + len(shingles)] += 1
                np.add.at(state, (shingles >> np.uint64(44)).astype(np.int64), 1)

    counted = summed(texts, count, SKETCH + LIGHT_LIMIT + 1)
    rarity = docs.sparkSession.sparkContext.broadcast(counted[:SKETCH].astype(np.float32))
    light = boundary(counted[SKETCH:], counted[:SKETCH], percent)

    def rows(batches):
        seen = rarity.value
        for batch in batches:
            for ids, buffer, offsets in textscan.chunks(batch.column(0), batch.column(1)):
                out = {name: [] for name in _DESCRIBED.names}
                for doc_id, shingles in zip(ids.tolist(), textscan.shingle_sets(buffer, offsets, k)):
                    n = len(shingles)
                    low, high = _signature(shingles)
                    keys, same = _subsets(shingles, percent, light) if n <= light else ([], [])
                    prefix = np.zeros(0, dtype=np.uint64)
                    if n > light or n and 100 * n >= percent * (light + 1):
                        order = np.lexsort((shingles, seen[(shingles >> np.uint64(44)).astype(np.int64)]))
                        prefix = shingles[order[: prefix_length(n, percent)]]
                    values = (doc_id, n, low, high, keys, same, prefix.view(np.int64), _sketch(shingles), *_parity(shingles).tolist())
                    for name, value in zip(_DESCRIBED.names, values):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=_DESCRIBED)

    return stored(texts.mapInArrow(rows, _DESCRIBED_SQL), "sets")


_DESCRIBED = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int32()), ("low", pa.int64()), ("high", pa.int64()),
    ("keys", pa.list_(pa.int64())), ("same", pa.list_(pa.bool_())), ("prefix", pa.list_(pa.int64())),
    ("sketch", pa.binary()), *((f"b{i}", pa.int64()) for i in range(BITMAP)),
])
_DESCRIBED_SQL = "doc_id long, n int, low long, high long, keys array<long>, same array<boolean>, prefix array<long>, sketch binary"
_DESCRIBED_SQL += "".join(f", b{i} long" for i in range(BITMAP))
_BITS = [f"b{i}" for i in range(BITMAP)]


def _subsets(shingles: np.ndarray, percent: int, limit: int) -> tuple[list[int], list[bool]]:
    """Keys of the subsets that a light set shares with its partners, and whether the key is for partners of its size."""
    keys, same = [], []
    n = len(shingles)
    spread = textscan.mixed(shingles)
    with np.errstate(over="ignore"):
        for m, c in subset_keys(n, percent, limit):
            tag = np.uint64((min(n, m) << 32) | (max(n, m) << 16) | c)
            for chosen in combinations(range(n), c):
                key = textscan.mixed(spread[list(chosen)].sum(dtype=np.uint64) + textscan.mixed(tag))
                keys.append(int(key.astype(np.int64)))
                same.append(n == m)
    return keys, same


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Whole shingle sets of the ``wanted`` documents (doc_id), as sorted binary.

    A filter of fixed size drops most other documents before their text is read; the joins that follow are exact.
    """
    def rows(batches):
        for batch in batches:
            for ids, buffer, offsets in textscan.chunks(batch.column(0), batch.column(1)):
                sets = [x.tobytes() for x in textscan.shingle_sets(buffer, offsets, k)]
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "shingles": sets}, schema=_SETS)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = only_near(texts.where("doc_id IS NOT NULL"), id_filter(wanted)).mapInArrow(rows, "doc_id long, shingles binary")
    return stored(found, "shingles")


_SETS = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])


def _verified(docs: DataFrame, described: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets are similar enough: those that their sketches allow are read and compared."""

    def allow(batches):
        for batch in batches:
            keep = []
            for x, y, a, b in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "x_n", "y_n"))):
                keep.append(_least_difference(x, y) <= a + b - 2 * overlap(a, b, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sketched = described.select("doc_id", "sketch", "n")
    x = sketched.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("x_n"))
    y = sketched.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("y_n"))
    pairs = stored(pairs.join(x, "a").join(y, "b").mapInArrow(allow, "a long, b long"), "pairs")
    sets = _sets(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), k)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return stored(joined.mapInArrow(check, "a long, b long"), "links")


def _need(a_n, b_n, percent):
    return F.ceil((F.lit(percent) * (a_n + b_n)) / F.lit(100 + percent) - F.lit(1e-9))


def _close(x: str, y: str, percent):
    """The parity bitmaps of the sides ``x`` and ``y`` allow a difference small enough."""
    differ = sum((F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _BITS), F.lit(0))
    x, y = F.col(f"{x}.n"), F.col(f"{y}.n")
    return differ <= x + y - 2 * _need(x, y, percent)


def _possible(a_n, a_pos, b_n, b_pos, percent):
    """What lengths and positions of one shared shingle allow: enough room for the overlap."""
    need = _need(a_n, b_n, percent)
    room = 1 + F.least(a_pos, b_pos) + F.least(a_n - a_pos, b_n - b_pos) - 1
    return (100 * F.least(a_n, b_n) >= percent * F.greatest(a_n, b_n)) & (room >= need)


def link_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links reach, its own without any."""
    spark = docs.sparkSession
    described = describe(docs, k, percent)
    digests = described.where("n > 0").groupBy("n", "low", "high").agg(F.min("doc_id").alias("first"))
    member = described.where("n > 0").join(digests, ["n", "low", "high"]).select("doc_id", "first")
    copies = member.where("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    chosen = described.join(digests.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")

    keys = chosen.select("doc_id", "n", F.explode(F.arrays_zip("keys", "same")).alias("s")).select("doc_id", "n", "s.*")
    met = keys.groupBy("keys").agg(
        F.min("doc_id").alias("b"), F.count("*").alias("c"),
        F.max(F.col("same") | F.lit(False)).alias("same"), F.min("n").alias("low"), F.max("n").alias("high"),
    ).where("c > 1 AND (same OR low < high)")
    light = keys.join(met.select("keys", "b"), "keys").where("doc_id != b").select(F.col("doc_id").alias("a"), "b")

    lists = chosen.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token"))
    heads = lists.groupBy("token").agg(F.min(F.struct("doc_id", "n", "pos")).alias("head"), F.count("*").alias("c"))
    shared = stored(lists.join(heads.where("c > 1").drop("c"), "token"), "lists")
    nearest = shared.where("doc_id != head.doc_id").where(
        _possible(F.col("n"), F.col("pos"), F.col("head.n"), F.col("head.pos"), percent)
    )
    bits = chosen.select("doc_id", "n", *_BITS)
    met = nearest.select(F.col("doc_id").alias("a"), F.col("head.doc_id").alias("b")).distinct()
    pairs = stored(
        met.join(bits.alias("x"), F.col("a") == F.col("x.doc_id")).join(bits.alias("y"), F.col("b") == F.col("y.doc_id"))
        .where(_close("x", "y", percent)).select("a", "b"), "pairs",
    )
    first = _verified(docs, chosen, pairs, k, percent).unionByName(stored(light.distinct(), "light"))

    labels = stored(components(first), "labels")
    labelled = shared.join(labels, shared.doc_id == labels.id, "left").select(
        "token", "doc_id", "n", "pos", F.coalesce("component", "doc_id").alias("label")
    )
    open_lists = labelled.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    rest = stored(
        labelled.join(open_lists.select("token"), "token", "left_semi").join(bits.drop("n"), "doc_id"), "open"
    )
    x, y = rest.alias("x"), rest.alias("y")
    crossed = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") < F.col("y.label")) & _possible(
        F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent
    ) & _close("x", "y", percent))
    more = crossed.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    more = stored(more.join(pairs, ((more.a == pairs.a) & (more.b == pairs.b)), "left_anti")
                  .join(pairs.select(F.col("a").alias("c"), F.col("b").alias("d")),
                        (F.col("a") == F.col("d")) & (F.col("b") == F.col("c")), "left_anti"), "pairs")
    links = first.unionByName(_verified(docs, chosen, more, k, percent)).unionByName(copies)
    found = components(links)
    ids = described.groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    return ids.join(found, ids.doc_id == found.id, "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
