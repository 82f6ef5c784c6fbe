"""Passages that several places share: what the suffix-array and the suffix-tree operators have in common.

Texts are sequences of units (bytes or words). A window is L consecutive units of one text. Of its L - k + 1 runs of k units
the one of the smallest hash (the leftmost of equals) is its anchor; equal windows have equal anchors at the same
place. Consecutive windows with one anchor are a *segment*; every window lies in exactly one. So equal windows lie in
segments of the same anchor key, and instead of every unit only 2 / (L - k + 2) of them are dealt out.

1. Segments (key, fingerprint of the whole segment, doc_id, place) are dealt out by key and sorted. Equal segments are
   settled there: all but the first are repeats (pre-aggregated per batch before the shuffle).
2. Only keys with several different segments go on: their first segments are read again from the texts, with content.
3. A key with more than ``crowd`` different segments (a passage that stands in very many texts) is split first: its single
   windows are dealt out by their own content and settled as segments are, without their content.
4. The operator's index (suffix arrays or trees) finds the windows that the others share, group by group.

A place is one long: start of the segment's first window, anchor's distance from it (8 bits), windows - 1 (8 bits).
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm import textscan
from tierwell.llm.common import id_filter, only_near, stored

_PLACE = 1 << 23


@dataclass(frozen=True)
class Windows:
    """What is looked for: windows of ``length`` units, anchors of ``gram`` units.

    ``words``: units are words, else bytes. ``same_text``: a window may repeat within its own text; otherwise only
    texts of smaller ids count.
    """

    length: int
    gram: int
    words: bool
    same_text: bool


def sequence(spec: Windows, buffer: np.ndarray, offsets: np.ndarray):
    """(values, bounds, spans): hash per unit, first unit of each text, and (starts, ends) of units in the buffer."""
    if spec.words:
        starts, ends, hashes, row = textscan.words(buffer, offsets)
        return hashes, np.searchsorted(row, np.arange(len(offsets))), (starts, ends)
    return textscan.byte_values(buffer), offsets, None


def segments(spec: Windows, values: np.ndarray, bounds: np.ndarray, buffer: np.ndarray):
    """(row, anchor, first, last, key, fingerprint) of the segments of a chunk; positions count from its start."""
    n, width = len(values), spec.length - spec.gram + 1
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found = []
    for at in range(0, max(n - spec.length + 1, 0), _PLACE):
        grams = textscan.grams_of(values[at : at + _PLACE + spec.length - 1], spec.gram)
        least = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        row = row_of[at : at + len(anchor)]
        good = row == row_of[at + spec.length - 1 : at + spec.length - 1 + len(anchor)]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (good[1:] != good[:-1])
        end = np.append(new[1:], True)
        first, last = np.flatnonzero(new & good), np.flatnonzero(end & good)
        found.append((row[first], anchor[first] + at, first + at, last + at, grams[anchor[first]]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=np.uint64),) * 2
    row, anchor, first, last, key = (np.concatenate(x) for x in zip(*found))
    if spec.words:
        content = textscan.value_digests(values, first, last + spec.length)
    else:
        content = textscan.byte_digests(buffer, first, last + spec.length)
    shape = ((anchor - first).astype(np.uint64) << np.uint64(8)) | (last - first).astype(np.uint64)
    return row, anchor, first, last, key, textscan.mixed(content + textscan.mixed(shape + np.uint64(1)))


def place(first, off, span):
    return (first << 16) | (off << 8) | span


def windows_of(place_: np.ndarray):
    """(first window, anchor's distance, windows - 1)."""
    return place_ >> 16, (place_ >> 8) & 255, place_ & 255


_ROWS = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("known", pa.bool_())])
_ROWS_SQL = "key long, fp long, doc_id long, place long, known boolean"
_FOUND = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])
_FOUND_SQL = "kind int, key long, doc_id long, place long"
REPEAT, OPEN, CROWDED = 0, 1, 2


def _rows(spec: Windows, key, fp, doc, at) -> pa.RecordBatch:
    """Rows of one batch to be settled; those of one key and fingerprint are settled here but for the first."""
    order = np.lexsort((at, doc, fp, key))
    key, fp, doc, at = key[order], fp[order], doc[order], at[order]
    head = np.ones(len(key), dtype=bool)
    head[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    leader = np.flatnonzero(head)[np.cumsum(head) - 1]
    # Rows that share id and text start at one place, which is not earlier than itself.
    apart = head | (doc != doc[leader]) | (at != at[leader])
    key, fp, doc, at, head, leader = key[apart], fp[apart], doc[apart], at[apart], head[apart], doc[leader][apart]
    known = ~head & (spec.same_text | (doc != leader))
    # Settled rows only pass through: any key will do, and theirs spreads them.
    key = np.where(known, textscan.mixed(doc.view(np.uint64) + at.view(np.uint64)), key).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, fp.view(np.int64), doc, at, known)], schema=_ROWS)


def _dealt(spec: Windows, texts: DataFrame) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for ids, buffer, offsets in textscan.chunks(batch.column(0), batch.column(1)):
                values, bounds, _ = sequence(spec, buffer, offsets)
                row, anchor, first, last, key, fp = segments(spec, values, bounds, buffer)
                yield _rows(spec, key, fp, ids[row], place(first - bounds[row], anchor - first, last - first))

    return texts.mapInArrow(rows, _ROWS_SQL)


def settle(spec: Windows, crowd: int):
    """Streams rows sorted by (key, fp, doc_id, place); see the module's step 1. Holds one batch and a few rows."""

    def run(batches):
        state = {"key": None, "fp": None, "leader": (0, -1), "kinds": 0, "wait": []}
        for batch in batches:
            known = batch.column("known").to_numpy(zero_copy_only=False)
            if known.any():
                yield _found(REPEAT, *(batch.column(c).to_numpy()[known] for c in ("key", "doc_id", "place")))
            key, fp, doc, at = (batch.column(c).to_numpy()[~known] for c in ("key", "fp", "doc_id", "place"))
            if len(key):
                yield from _settled(key, fp, doc, at, state, spec, crowd)

    return run


def _found(kind: int, key, doc, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(key), pa.array(doc), pa.array(at)], schema=_FOUND
    )


def _settled(key, fp, doc, at, state, spec, crowd):
    new_key, new_fp = np.ones(len(key), dtype=bool), np.ones(len(key), dtype=bool)
    new_key[1:] = key[1:] != key[:-1]
    new_fp[1:] = new_key[1:] | (fp[1:] != fp[:-1])
    goes_on = state["key"] is not None and key[0] == state["key"]
    new_key[0] = not goes_on
    new_fp[0] = not (goes_on and fp[0] == state["fp"])
    heads = np.flatnonzero(new_fp)
    group = np.cumsum(new_fp)
    leader = np.concatenate([[state["leader"][0]], doc[heads]])[group]
    leader_at = np.concatenate([[state["leader"][1]], at[heads]])[group]
    # Rows that share id and text start at one place, which is not earlier than itself.
    itself = ~new_fp & (doc == leader) & (at == leader_at)
    repeat = ~new_fp & ~itself & (spec.same_text | (doc != leader))
    if repeat.any():
        yield _found(REPEAT, key[repeat], doc[repeat], at[repeat])
    # Different segments of each row's key so far, and in the whole batch.
    starts = np.flatnonzero(new_key)
    part = np.cumsum(new_key)  # 0: the key that goes on from the last batch
    counts = np.bincount(part, weights=new_fp, minlength=part[-1] + 1).astype(np.int64)
    counts[0] += state["kinds"] if goes_on else 0
    if not goes_on or counts[0] > 1:
        if goes_on and state["wait"]:
            yield _found(OPEN, *(np.array(x, dtype=np.int64) for x in zip(*state["wait"])))
        state["wait"] = []
    open_ = ~repeat & ~itself & (counts[part] > 1)
    if open_.any():
        yield _found(OPEN, key[open_], doc[open_], at[open_])
    crowded = counts > crowd
    if goes_on and state["kinds"] > crowd:
        crowded[0] = False
    if crowded.any():
        names = np.concatenate([[key[0]], key[starts]])[: len(counts)] if len(counts) == len(starts) + 1 else key[starts]
        chosen = names[crowded]
        yield _found(CROWDED, chosen, np.zeros_like(chosen), np.zeros_like(chosen))
    last = part == part[-1]
    if counts[part[-1]] == 1:
        last &= ~repeat & ~itself
        state["wait"] += [(int(k), int(d), int(p)) for k, d, p in zip(key[last], doc[last], at[last])]
    state.update(key=key[-1], fp=fp[-1], leader=(leader[-1], leader_at[-1]), kinds=int(counts[part[-1]]))


def _settled_rows(spec: Windows, dealt: DataFrame, crowd: int, name: str) -> DataFrame:
    sorted_ = dealt.repartition("key").sortWithinPartitions("key", "fp", "doc_id", "place")
    return stored(sorted_.mapInArrow(settle(spec, crowd), _FOUND_SQL), name)


def shared_segments(spec: Windows, texts: DataFrame, crowd: int) -> DataFrame:
    """(kind, key, doc_id, place) of repeated segments and of those that stay open, stored."""
    return _settled_rows(spec, _dealt(spec, texts), crowd, "segments")


def _asked(spec: Windows, texts: DataFrame, places: DataFrame, pick, kinds: str) -> DataFrame:
    """``pick(doc_id, key, place, at, values, buffer)`` of the segments ``places`` (key, doc_id, place), for a chunk of texts at a time.

    ``at``: first unit of each segment in the chunk.
    """
    asked = stored(places.groupBy("doc_id").agg(F.collect_list(F.struct("key", "place")).alias("asked")), "asked")

    def rows(batches):
        for batch in batches:
            asked, doc = batch.column("asked"), batch.column("doc_id").to_numpy()
            for some, buffer, offsets in textscan.chunks(pa.array(np.arange(batch.num_rows)), batch.column("text")):
                values, bounds, _ = sequence(spec, buffer, offsets)
                mine = asked.slice(some[0], len(some))
                of = np.repeat(np.arange(len(some)), pa.compute.list_value_length(mine).to_numpy())
                key, at = (mine.flatten().field(i).to_numpy() for i in range(2))
                yield pick(doc[some][of], key, at, windows_of(at)[0] + bounds[of], values, buffer)

    return only_near(texts, id_filter(asked)).join(asked, "doc_id").mapInArrow(rows, kinds)


def crowded_windows(spec: Windows, texts: DataFrame, places: DataFrame, crowd: int) -> DataFrame:
    """The same as ``shared_segments`` for the single windows of the segments ``places``.

    A crowded key's segments hold one passage with different text around it, so nearly all of their windows are equal to
    many others or to none: only keys and fingerprints are dealt out, and the windows of a passage are combined before the shuffle.
    """

    def windows(doc, key, at, first, values, buffer):
        count = windows_of(at)[2] + 1
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        begin = np.repeat(first, count) + step
        digests = textscan.value_digests(values, begin, begin + spec.length) if spec.words else textscan.byte_digests(buffer, begin, begin + spec.length)
        # The anchor may lie before the window: only its place in the text matters here.
        where = place(np.repeat(windows_of(at)[0], count) + step, 0, 0)
        return _rows(spec, digests, textscan.span_hashes(values, begin, begin + spec.length), np.repeat(doc, count), where)

    return _settled_rows(spec, _asked(spec, texts, places, windows, _ROWS_SQL), crowd, "windows")


_CONTENT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("content", pa.binary())])
_CONTENT_SQL = "key long, doc_id long, place long, content binary"


def open_segments(spec: Windows, texts: DataFrame, places: DataFrame) -> DataFrame:
    """The segments ``places`` with content: bytes, or 64-bit hashes of words."""

    def contents(doc, key, at, first, values, buffer):
        content = values if spec.words else buffer
        ends = first + windows_of(at)[2] + spec.length
        found = [content[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(at), pa.array(found, pa.binary())], schema=_CONTENT)

    return _asked(spec, texts, places, contents, _CONTENT_SQL)


def groups(batches, limit: int):
    """Arrays (key, doc_id, place, contents) of a stream sorted by key, cut after about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        at = 0
        sizes = pa.compute.binary_length(batch.column("content")).to_numpy().cumsum()
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + limit - size, side="right")))
            piece = batch.slice(at, end - at)
            held.append(piece)
            size += int(sizes[min(end, batch.num_rows) - 1]) - before
            at = end
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    table = pa.Table.from_batches(held)
    return (*(table.column(c).to_numpy() for c in ("key", "doc_id", "place")), table.column("content").to_pylist())


_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
SPANS_SQL = "doc_id long, start long, end long"


def spans_batch(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (doc, start, end)], schema=_SPANS)


def repeated_spans(spec: Windows, texts: DataFrame, resolve, crowd: int) -> DataFrame:
    """(doc_id, start, end) of units that repeated windows cover; spans may overlap.

    ``resolve(frame)``: the operator's index over open segments (key, doc_id, place, content) to such spans.
    """
    found = shared_segments(spec, texts, crowd)
    places = found.where(F.col("kind") == OPEN).select("key", "doc_id", "place")
    equal = found.where(F.col("kind") == REPEAT)
    crowded = found.where(F.col("kind") == CROWDED).select("key").distinct()
    if not crowded.isEmpty():
        windows = crowded_windows(spec, texts, places.join(crowded, "key", "left_semi"), crowd)
        equal = equal.unionByName(windows.where(F.col("kind") == REPEAT))
        rest = windows.where(F.col("kind") == OPEN).select("key", "doc_id", "place")
        places = places.join(crowded, "key", "left_anti").unionByName(rest)
    first = F.shiftright("place", 16)
    equal = equal.select("doc_id", first.alias("start"), (first + F.col("place").bitwiseAND(255) + spec.length).alias("end"))
    return equal.unionByName(resolve(open_segments(spec, texts, places)))


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return starts[heads], reach[np.append(heads[1:] - 1, len(starts) - 1)] if len(starts) else reach


def rewritten(texts: DataFrame, spans: DataFrame, rewrite, schema: str, out: pa.Schema) -> DataFrame:
    """``rewrite(doc_id, text bytes, run starts, run ends)`` of every text; those without spans aren't shuffled."""
    runs = stored(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("runs")), "runs")
    marks = id_filter(runs)
    none = np.zeros(0, dtype=np.int64)

    def rows(batches):
        for batch in batches:
            made = []
            has = batch.schema.get_field_index("runs") >= 0
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id"), batch.column("text"))):
                starts, ends = none, none
                if has and batch.column("runs")[i].is_valid:
                    items = batch.column("runs").slice(i, 1).flatten()
                    starts, ends = covered(items.field(0).to_numpy(), items.field(1).to_numpy())
                made.append(rewrite(doc_id.as_py(), (text.as_py() or "").encode(), starts, ends))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made), out)] if made else [pa.array([], t.type) for t in out], schema=out)

    with_runs = only_near(texts, marks).join(runs, "doc_id", "left")
    return only_near(texts, marks, others=True).mapInArrow(rows, schema).unionByName(with_runs.mapInArrow(rows, schema))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id IS NOT NULL"
    )
