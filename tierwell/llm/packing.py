"""Packing (operator 4): documents into token sequences by cutting-stock column generation.

Every document is encoded once, gets the end id, and is cut at multiples of the capacity into full pieces and one rest.
Pieces are classed by length in steps of ``step`` tokens. The counts per class (at most capacity / step numbers, however
many documents there are) are the demands of a cutting-stock problem: a linear program over patterns (how many
pieces of each class one sequence holds), solved by the revised simplex method; new columns are priced by a knapsack
dynamic program; Farley's bound ends it. Solutions are rounded down, and what they leave over is filled
greedily, largest first. Patterns are then assigned to documents by their rank within the class: pattern p takes the
next ``multiplicity * uses`` ranks of each of its classes, so a piece finds its sequence by one search in a table of
bounded size, and no sequence is ever built in one place.

Ranks are drawn in 256 slices per class, so a class that holds most pieces is still spread.

Cases: null text is empty and gives a piece of the end id alone; rows that repeat an id are packed each; a text longer
than the capacity gives several pieces; an empty table gives no pieces. Extra columns are ignored.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tierwell.llm.common import running, stored
from tierwell.llm.tokens import encoder

CAPACITY, STEP, END = 2048, 16, 1

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
])
_PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The documents' pieces; ``tokenizer``: path of the tokenizer file, which the driver reads and ships."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    last = np.array([end], dtype="<u4").tobytes()

    def rows(batches):
        words = encoder(definition.value)
        encode = words.encode
        for batch in batches:
            out = {name: [] for name in _PIECES.names}
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encode(text.as_py() or "") + last
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for name, value in zip(_PIECES.names, (doc_id.as_py(), start, len(piece) // 4, zlib.crc32(piece), total)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_PIECES)
        words.forget()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, _PIECES_SQL)


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the uses of each size that are worth most within ``capacity``."""
    worth, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fits = np.searchsorted(sizes, room, side="right")
        if fits:
            gain = worth[room - sizes[:fits]] + values[:fits]
            best = int(gain.argmax())
            if gain[best] > worth[room] + 1e-12:
                worth[room], choice[room] = gain[best], best
    uses, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            uses[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(worth[capacity]), uses


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4) -> list[tuple[int, np.ndarray]]:
    """(multiplicity, uses of each size) of patterns that hold every demanded piece exactly once.

    ``sizes`` ascend and are at most ``capacity``; demands are positive.
    """
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(patterns))
    amounts = inverse @ demand
    for _ in range(40 * m):
        duals = inverse.sum(axis=0)
        worth, uses = best_pattern(duals, sizes, capacity)
        if worth <= 1 + 1e-9 or amounts.sum() <= duals @ demand / worth * (1 + gap):
            break
        entering = inverse @ uses
        steps = np.full(m, np.inf)
        np.divide(np.maximum(amounts, 0), entering, out=steps, where=entering > 1e-9)
        leaves = int(steps.argmin())
        if not np.isfinite(steps[leaves]):
            break
        inverse[leaves] /= entering[leaves]
        others = np.arange(m) != leaves
        inverse[others] -= np.outer(entering[others], inverse[leaves])
        amounts = inverse @ demand
        patterns[:, leaves] = uses
    whole = np.floor(np.maximum(amounts, 0) + 1e-7).astype(np.int64)
    left = demand.astype(np.int64).copy()
    plan = []
    for p in np.argsort(-whole, kind="stable"):
        uses = patterns[:, p].astype(np.int64)
        used = uses > 0
        times = min(int(whole[p]), int((left[used] // uses[used]).min()))
        if times:
            plan.append((times, uses))
            left -= times * uses
    while left.any():
        room, uses = capacity, np.zeros(m, dtype=np.int64)
        for i in range(m - 1, -1, -1):
            uses[i] = min(left[i], room // sizes[i])
            room -= uses[i] * sizes[i]
        used = uses > 0
        times = int((left[used] // uses[used]).min())
        plan.append((times, uses))
        left -= times * uses
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, step: int = STEP, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    cut = stored(pieces(docs, tokenizer, capacity, end), "pieces")
    size = F.ceil(F.col("length") / step).cast("int")
    counts = sorted(tuple(row) for row in cut.groupBy(size.alias("size")).count().collect())
    sizes, demand = np.array([s for s, _ in counts], dtype=np.int64), np.array([n for _, n in counts], dtype=float)
    table: dict[int, list[tuple]] = {int(s): [] for s in sizes}
    taken, sequences = dict.fromkeys(table, 0), 0
    for times, uses in cutting_stock(sizes, demand, capacity // step) if counts else []:
        for s, n in zip(sizes.tolist(), uses.tolist()):
            if n:
                table[s].append((taken[s], n, sequences))
                taken[s] += times * n
        sequences += times
    lookup = {s: np.array(rows, dtype=np.int64).reshape(-1, 3) for s, rows in table.items()}

    def place(batches):
        for batch in batches:
            size, rank = batch.column("_size").to_numpy(), batch.column("_rank").to_numpy()
            sequence = np.zeros(len(size), dtype=np.int64)
            for s in np.unique(size).tolist():
                mine = size == s
                first, uses, base = lookup[s][np.searchsorted(lookup[s][:, 0], rank[mine], side="right") - 1].T
                sequence[mine] = base + (rank[mine] - first) // uses
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], [*batch.schema.names, "sequence_id"])

    spread = cut.withColumn("_size", size).withColumn("_digest", F.md5(F.col("doc_id").cast("string")))
    ranked = running(spread, ["_size"], ["_digest", "doc_id", "start", "ids_crc32"], F.lit(1), "_rank").select(
        *_PIECES.names, "_size", F.col("_rank").cast("long").alias("_rank")
    )
    placed = ranked.mapInArrow(place, _PIECES_SQL + ", _size int, _rank long, sequence_id long")
    within = Window.partitionBy("sequence_id").orderBy(F.desc("_size"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *_PIECES.names, "sequence_id", F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long").alias("offset")
    )
