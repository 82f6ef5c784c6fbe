"""Words and k-grams of many texts at once, as numpy arrays over one byte buffer.

Everything here works on one Arrow batch inside a task; batches are cut so that the arrays stay small.
A 64-bit hash stands for a word or k-gram. Only hashes of the same corpus are compared.
"""

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPREAD = _RNG.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text that are held as arrays at a time.
CHUNK = 1 << 19

_powers: dict[str, np.ndarray] = {}


def _power(n: int, base: np.uint64, name: str) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK + 65536), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[name] = np.multiply.accumulate(steps)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACE = np.uint64(0xD6E8FEB86659FD93)


def _digests(lanes: np.ndarray, place: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each run of ``lanes``: every lane is mixed with its place in the run before lanes are added up, so that no
    pattern of the content cancels itself, as it does in polynomials modulo a power of two. Runs are not empty."""
    total = np.add.reduceat(mixed(lanes + _PLACE * (place.astype(np.uint64) + np.uint64(1))), first) if len(first) else lanes[:0]
    return mixed(total + sizes.astype(np.uint64))


def byte_digests(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``buffer[start:end]`` of each pair, eight bytes a lane; at most one lane: no two alike."""
    sizes = ends - starts
    n_lanes = (sizes + 7) >> 3
    first = np.cumsum(n_lanes) - n_lanes
    place = np.arange(int(n_lanes.sum())) - np.repeat(first, n_lanes)
    padded = np.concatenate([buffer, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray((len(buffer) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    lanes = eights[np.repeat(starts, n_lanes) + 8 * place].astype(np.uint64)
    rest = np.repeat(sizes, n_lanes) - 8 * place
    short = np.flatnonzero(rest < 8)
    lanes[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
    return _digests(lanes, place, first, sizes)


def value_digests(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for runs of 64-bit values."""
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    return _digests(values[np.repeat(starts, sizes) + place], place, first, sizes)


def chunks(ids: pa.Array, texts: pa.Array):
    """(ids, buffer, offsets) of runs of rows with about CHUNK bytes of text; a longer text comes alone.

    ``buffer`` holds the UTF-8 bytes of the texts, row i at ``offsets[i]:offsets[i + 1]``; null is empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    keys = ids.to_numpy(zero_copy_only=False)
    start = 0
    while start < len(keys):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK, side="right")) - 1)
        end = min(end, len(keys))
        yield keys[start:end], data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def words(buffer: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """(starts, ends, hashes, row) of the words ``[^\\x20\\x09-\\x0D]+``; no word crosses a row."""
    if lower:
        buffer = _LOWER[buffer]
    n = len(buffer)
    inside = np.empty(n + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[buffer], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = byte_digests(buffer, starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, hashes, row


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * _SPREAD[i]
    return mixed(out)


def byte_values(buffer: np.ndarray) -> np.ndarray:
    """A random odd number for each byte."""
    return _BYTE[buffer]


def grams_of(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values, by differences of a running sum: the cost doesn't depend on k."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(n)
    return span_hashes(values, starts, starts + k)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair. Some patterns collide: it deals rows out, and never says that two are equal."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power(len(values), _BASE, "up"), out=total[1:])
    return mixed((total[ends] - total[starts]) * _power(len(values) + 1, _INVERSE, "down")[starts])


def shingle_sets(buffer: np.ndarray, offsets: np.ndarray, k: int, lower: bool = True):
    """Per row, the sorted distinct hashes of its k-word shingles.

    A row with fewer than k words, but one at least, has its whole word sequence as its one shingle.
    """
    _, _, hashes, row = words(buffer, offsets, lower)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    all_grams = grams(hashes, k)
    for i in range(len(offsets) - 1):
        first, last = bounds[i], bounds[i + 1]
        if last - first >= k:
            yield np.unique(all_grams[first : last - k + 1])
        elif last > first:
            yield grams(hashes[first:last], last - first) ^ np.uint64(last - first)
        else:
            yield np.zeros(0, dtype=np.uint64)
