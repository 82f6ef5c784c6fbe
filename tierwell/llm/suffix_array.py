"""Suffix-array dedup (operator 5): every byte that an earlier occurrence of a long passage covers goes.

A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a text of smaller doc_id, or
before it in the same text. Strings are judged on the input, and overlaps count.

Texts are cut to the segments that can hold a shared string (module ``repeats``); only those go on. Segments of one key
come to one task in order of their texts, and in shards of bounded size:

* each shard's suffix array is made by Larsson and Sadakane's refinement: suffixes are sorted by 8 bytes, and groups of
  equal rank are sorted again by the rank of what follows, at twice the depth each time, until none is left;
* common prefixes of neighbours by Kasai's bound, that the next suffix of the text shares at most one byte less;
  neighbours with ``length`` bytes in common are one string;
* strings of a key that goes on over several shards are merged by binary search in the sorted strings of its
  earlier shards.

Cases: null text is empty; texts shorter than ``length`` lose nothing; removal may cut UTF-8 characters, so what is left
is bytes; rows that repeat an id are rewritten each, as one text would be (places of both count as that id's); null ids
take no part; an empty table gives no rows; extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierwell.llm import repeats
from tierwell.llm.repeats import Windows

#: Bytes of a shard, and different segments of one key beyond which it is dealt out window by window.
SHARD, CROWD = 1 << 20, 20_000


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each position, big-endian; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; what lies past the end is smallest."""
    n = len(data)
    words = words_at(data)
    order = np.argsort(words)
    head = words[order]
    new = np.ones(n, dtype=bool)
    new[1:] = head[1:] != head[:-1]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = 0
    # A group's rank is its first slot: when groups are split, only the ranks of their own suffixes change.
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    h = 8
    while len(slots):
        at = order[slots]
        group = rank[at]
        follows = np.where(at + h <= n, rank[np.minimum(at + h, n)], n - at - h)
        again = np.argsort(group * (2 * n + 2) + (follows + n))  # both fit: a shard's n is far below 2**31
        at, group, follows = at[again], group[again], follows[again]
        order[slots] = at
        start = np.ones(len(at), dtype=bool)
        start[1:] = (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])
        rank[at] = slots[np.flatnonzero(start)[np.cumsum(start) - 1]] + 1
        slots = slots[~(start & np.append(start[1:], True))]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Bytes that each suffix shares with its predecessor in ``order``, up to ``limit``.

    Every eighth position of the text is compared from its start, the others from Kasai's bound on.
    """
    n = len(data)
    before = np.empty(n, dtype=np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, dtype=np.int64)
    if n < 2:
        return shared[order]
    none = order[0]
    text = np.concatenate([data.astype(np.int16), np.full(limit + 8, -1, dtype=np.int16)])
    big = words_at(np.concatenate([data, np.zeros(limit + 8, dtype=np.uint8)]))
    for phase in range(8):
        at = np.arange(phase, n, 8)
        at = at[at != none]
        other = before[at]
        got = np.zeros(len(at), dtype=np.int64) if phase == 0 else np.maximum(shared[at - 1] - 1, 0)
        active = np.flatnonzero(got < limit)
        while len(active):  # whole words first
            x, y = at[active] + got[active], other[active] + got[active]
            equal = (big[x] == big[y]) & (np.maximum(x, y) + 8 <= n)
            got[active[equal]] += 8
            active = active[equal]
            active = active[got[active] < limit]
        active = np.flatnonzero(got < limit)
        while len(active):
            x, y = at[active] + got[active], other[active] + got[active]
            equal = (text[x] == text[y]) & (np.maximum(x, y) < n)
            got[active[equal]] += 1
            active = active[equal]
            active = active[got[active] < limit]
        shared[at] = np.minimum(got, limit)
    return shared[order]


def find(sorted_words: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each row of ``wanted`` is among the sorted rows: binary search, all rows at once."""
    low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(sorted_words), dtype=np.int64)
    while (low < high).any():
        middle = (low + high) // 2
        here = sorted_words[np.minimum(middle, len(sorted_words) - 1)]
        differ = here != wanted
        where = differ.argmax(axis=1)
        rows = np.arange(len(wanted))
        less = (here[rows, where] < wanted[rows, where]) & differ.any(axis=1)
        open_ = low < high
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    inside = low < len(sorted_words)
    out = np.zeros(len(wanted), dtype=bool)
    out[inside] = (sorted_words[low[inside]] == wanted[inside]).all(axis=1)
    return out


def matrix(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes at each position as rows of big-endian words."""
    n = -(-length // 8)
    rows = np.zeros((len(at), n * 8), dtype=np.uint8)
    for i in range(length):
        rows[:, i] = data[at + i]
    return rows.view(">u8").astype(np.uint64)


def shards(length: int, limit: int):
    """Spans of repeated strings among segments in the order of (key, doc_id, place), shard by shard."""

    def run(batches):
        open_key, earlier = None, []
        for key, doc, at, contents in repeats.groups(batches, limit):
            sizes = np.array([len(c) for c in contents], dtype=np.int64)
            data = np.frombuffer(b"".join(contents), dtype=np.uint8)
            base = np.cumsum(sizes) - sizes
            order = suffix_array(data)
            shared = common_prefixes(data, order, length)
            text_class = np.empty(len(data), dtype=np.int64)
            text_class[order] = np.cumsum(shared < length)
            windows = sizes - length + 1
            segment = np.repeat(np.arange(len(sizes)), windows)
            step = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
            position = base[segment] + step
            start = (at >> 16)[segment] + step
            group = text_class[position]
            sorting = np.lexsort((start, doc[segment], group))
            repeat = np.ones(len(segment), dtype=bool)
            heads = np.ones(len(segment), dtype=bool)
            heads[1:] = group[sorting][1:] != group[sorting][:-1]
            # One of the same document and start (of another row of that id) is not earlier.
            first = sorting[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
            repeat[sorting] = ~heads & ((doc[segment[sorting]] != doc[segment[first]]) | (start[sorting] != start[first]))
            if open_key is not None and key[0] == open_key and earlier:
                mine = np.flatnonzero(key[segment] == open_key)
                wanted = matrix(data, position[mine], length)
                for other in earlier:
                    repeat[mine] |= find(other, wanted)
            if key[-1] != open_key:
                open_key, earlier = key[-1], []
            mine = sorting[heads]
            mine = mine[(key[segment[mine]] == open_key) & ~repeat[mine]]
            earlier.append(matrix(data, position[mine], length))
            if repeat.any():
                yield repeats.spans_batch(doc[segment[repeat]], start[repeat], start[repeat] + length)

    return run


def removed_spans(docs: DataFrame, length: int = 100, gram: int = 32, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """(doc_id, start, end) of bytes to remove; spans may overlap."""
    spec = Windows(length=length, gram=gram, words=False, same_text=True)

    def resolve(segments: DataFrame) -> DataFrame:
        dealt = segments.repartition("key").sortWithinPartitions("key", "doc_id", "place")
        return dealt.mapInArrow(shards(length, shard), repeats.SPANS_SQL)

    return repeats.repeated_spans(spec, repeats.texts_of(docs), resolve, crowd)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
])


def _cut(doc_id, text, starts, ends):
    kept, last = [], 0
    for start, end in zip(starts.tolist(), ends.tolist()):
        kept.append(text[last:start])
        last = end
    kept.append(text[last:])
    return doc_id, len(text), int((ends - starts).sum()), len(starts), b"".join(kept)


def dedup_substrings(docs: DataFrame, length: int = 100, gram: int = 32, shard: int = SHARD, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and what is ``kept`` (bytes) of every text."""
    spans = removed_spans(docs, length, gram, shard, crowd)
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return repeats.rewritten(repeats.texts_of(docs), spans, _cut, kinds, _OUT)
