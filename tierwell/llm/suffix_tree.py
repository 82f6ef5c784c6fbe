"""Substring dedup (operator 6): words that a window of another, earlier text covers go, by partitioned suffix trees.

A word is removed if a window of ``length`` consecutive words covers it whose words also start in a text of smaller
doc_id. Windows are judged on the input. Words are runs of other bytes than the six ASCII white space ones, unchanged.

Texts are cut to the segments that can hold a shared window (module ``repeats``). Of those, every suffix that starts a
window goes into the tree. After Mansour et al., "ERA: Efficient Serial and Parallel Suffix Tree Construction" (2011), the
tree is never built as a whole: suffixes are split by prefixes of variable length. All prefixes of ``prefixes[0]`` words are
counted; those with more than ``group`` suffixes are split by the next longer prefix, and so on, until a group fits
into memory. A group that cannot be split further, of one whole window, is read as a stream in pieces of bounded size;
equal segments were merged before, so it has few rows.

In each group the sorted suffixes and the words that neighbours share give the subtree: its internal nodes are found
with a stack. Nodes at ``length`` words or deeper are the repeats; all suffixes below such a node but those of its
smallest doc_id are covered.

Cases: null and empty text have no words; texts shorter than the window lose nothing; rows that repeat an id are
one text's (they cannot remove each other's words); null ids take no part; an empty table gives no rows; extra
columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm import repeats, textscan
from tierwell.llm.common import stored
from tierwell.llm.repeats import Windows

#: Words of the prefixes that split suffixes, suffixes of a group, segments of one key before it is split, bytes at a time.
PREFIXES, GROUP, CROWD, HELD = (3, 6, 13), 100_000, 20_000, 1 << 22

_SUFFIXES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("suffix", pa.binary()), *((f"p{i}", pa.int64()) for i in range(3)),
])
_SUFFIXES_SQL = "doc_id long, start long, suffix binary, p0 long, p1 long, p2 long"


def _suffixes(length: int, prefixes: tuple[int, int, int]):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, at = batch.column("doc_id").to_numpy(), batch.column("place").to_numpy()
            contents = batch.column("content").to_pylist()
            sizes = np.array([len(c) // 8 for c in contents], dtype=np.int64)
            values = np.frombuffer(b"".join(contents), dtype=np.uint64)
            base, windows = np.cumsum(sizes) - sizes, sizes - length + 1
            segment = np.repeat(np.arange(len(sizes)), windows)
            step = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
            first = base[segment] + step
            suffix = np.stack([values[first + i] for i in range(length)], axis=1).astype(">u8")
            raw = suffix.tobytes()
            names = [textscan.span_hashes(values, first, first + min(p, length)).view(np.int64) for p in prefixes]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[segment]), pa.array((at >> 16)[segment] + step),
                pa.array([raw[i * 8 * length : (i + 1) * 8 * length] for i in range(len(first))], pa.binary()), *map(pa.array, names),
            ], schema=_SUFFIXES)

    return run


def internal_nodes(shared: np.ndarray) -> list[tuple[int, int, int]]:
    """(depth, first, last + 1) of a suffix tree's internal nodes, from what each sorted suffix shares with the one before.

    Linear, with a stack of open nodes; ``shared[0]`` is not read.
    """
    nodes, open_ = [], [(0, 0)]
    for i in range(1, len(shared)):
        start = i - 1
        while open_[-1][0] > shared[i]:
            depth, start = open_.pop()
            nodes.append((depth, start, i))
        if open_[-1][0] < shared[i]:
            open_.append((int(shared[i]), start))
    while len(open_) > 1:
        depth, start = open_.pop()
        nodes.append((depth, start, len(shared)))
    return nodes


def _trees(length: int, limit: int):
    """Spans below deep nodes, from suffixes sorted by (group, suffix, doc_id); holds about ``limit`` bytes at a time."""

    def run(batches):
        before, smallest = None, None
        for batch in batches:
            rows = max(1, limit // (8 * length))
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, min(rows, batch.num_rows - at))
                doc, start = piece.column("doc_id").to_numpy(), piece.column("start").to_numpy()
                group = piece.column("grp").to_numpy()
                words = np.frombuffer(b"".join(piece.column("suffix").to_pylist()), dtype=">u8").reshape(-1, length)
                differ = np.ones((len(words), length), dtype=bool)
                differ[1:] = words[1:] != words[:-1]
                shared = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
                shared[1:][group[1:] != group[:-1]] = 0
                # A node that was open at the end of the last piece goes on here.
                first_doc = np.array(doc)
                goes_on = before is not None and before[0] == group[0] and (before[1] == words[0]).all()
                shared[0] = 0
                nodes = [(d, a, b) for d, a, b in internal_nodes(shared) if d >= length]
                for _, a, b in nodes:
                    first_doc[a:b] = doc[a]
                if goes_on:
                    end = next((b for _, a, b in nodes if a == 0), 1)
                    first_doc[:end] = smallest
                repeat = doc > first_doc
                if repeat.any():
                    yield repeats.spans_batch(doc[repeat], start[repeat], start[repeat] + length)
                before, smallest = (group[-1], words[-1]), first_doc[-1]

    return run


def removed_spans(
    docs: DataFrame, length: int = 13, gram: int = 7, prefixes: tuple[int, int, int] = PREFIXES, group: int = GROUP,
    crowd: int = CROWD, held: int = HELD,
) -> DataFrame:
    """(doc_id, start, end) of words to remove, counted from 0; spans may overlap."""
    spec = Windows(length=length, gram=gram, words=True, same_text=False)

    def resolve(segments: DataFrame) -> DataFrame:
        suffixes = stored(segments.mapInArrow(_suffixes(length, prefixes), _SUFFIXES_SQL), "suffixes")
        named = suffixes.withColumn("grp", F.col("p0"))
        for shorter, longer in (("p0", "p1"), ("p1", "p2")):
            large = suffixes.groupBy(F.col(shorter).alias("grp")).count().where(F.col("count") > group).select("grp", F.lit(True).alias("large"))
            named = named.join(stored(large, "prefixes"), "grp", "left").withColumn(
                "grp", F.when(F.col("large"), F.col(longer)).otherwise(F.col("grp"))
            ).drop("large")
        dealt = named.select("grp", "suffix", "doc_id", "start").repartition("grp").sortWithinPartitions("grp", "suffix", "doc_id", "start")
        return dealt.mapInArrow(_trees(length, held), repeats.SPANS_SQL)

    return repeats.repeated_spans(spec, repeats.texts_of(docs), resolve, crowd)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _cut(doc_id, text, starts, ends):
    words = text.split()
    kept, last = [], 0
    for start, end in zip(starts.tolist(), ends.tolist()):
        kept += words[last:start]
        last = end
    kept += words[last:]
    return doc_id, len(words), len(words) - len(kept), b" ".join(kept)


def dedup_words(docs: DataFrame, length: int = 13, gram: int = 7, **limits) -> DataFrame:
    """doc_id, n_words, n_removed and what is ``kept`` (words joined by blanks) of every text."""
    spans = removed_spans(docs, length, gram, **limits)
    kinds = "doc_id long, n_words long, n_removed long, kept binary"
    return repeats.rewritten(repeats.texts_of(docs), spans, _cut, kinds, _OUT)
