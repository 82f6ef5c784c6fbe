"""Alignment of two tokenizers' ids over the same texts: byte-level BPE (A) and BPE pieces with byte fallback (B).

Both read space+text. Where a token of A and one of B end at the same byte, a group ends; tokens whose bytes overlap are
linked. The corpus-wide count of a pair of ids tells how good a link is.

Method: after full tokenisation, shared ends in front of a token that starts with a space on both sides (checked on the
byte offsets) split a document into windows. A window's groups and links depend on its ids alone, so they are worked out
once for each different (A ids, B ids) and looked up by them afterwards.

On Spark: a task handles blocks of documents and writes, once, one row per document (its windows as places in the block's
list of different windows) and one row per block (that list's links, and the block's pairs with their numbers). Pairs are
summed over blocks, asked for by block, and the answers meet the block's rows in a cogroup of bounded size. A pair that
every document holds is one row per block. Nothing is broadcast but the highest count of each id of B (65,536 at most).

Hard cases: a text that is null or empty, or whose joined A or B bytes are not those of space+text (U+2581 in it), has no
tokens: zeros and ''. Rows that share an id, or have none, are documents of their own. Very long texts are cut into parts
in front of a space, which is an anchor. Other columns are ignored; an empty table gives no rows.
"""

import hashlib
import json
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tierwell.llm.common import stored

#: Bytes of text, rows and different windows of a block; a block ends when one is reached.
BLOCK_BYTES, BLOCK_ROWS, BLOCK_WINDOWS = 16 << 20, 50_000, 300_000
#: Tokens of A that are aligned at a time, and characters of a long text that are tokenised at a time.
TOKENS, PART = 1 << 19, 1 << 20
#: Different parts of texts, and ids of them, that a process keeps; a block ends when one is reached.
PARTS, PART_IDS = 500_000, 8_000_000

# Fixed value: the pattern that cuts texts before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GAP = re.compile(r"\s[ \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_ROWS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "windows binary, times binary, pairs binary, totals binary, sizes binary, links binary"
)
_SCHEMA = pa.schema([
    *[(name, pa.int64()) for name in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")],
    ("groups_sha256", pa.string()), *[(name, pa.binary()) for name in ("windows", "times", "pairs", "totals", "sizes", "links")],
])
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_RESULT = pa.schema([*[(name, pa.int64()) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                     ("groups_sha256", pa.string())])


def _unprintable() -> dict[str, int]:
    """Byte of each printable stand-in of a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Ids of both tokenizers as unsigned 16-bit integers, encoded by parts that no token crosses.

    A part starts at a blank or line end that follows something else. No piece of A crosses that border (its pattern takes
    white space at the front only), and none of B as long as its vocabulary has no piece with a blank behind another sign
    and none with a line end, which is looked up; otherwise texts are encoded whole.
    """

    def __init__(self, byte_level: str, pieces: bytes):
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        back = _unprintable()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        if max(len(self.b), *(i + 1 for i in vocabulary.values())) > 1 << 16:
            raise ValueError("ids of both tokenizers have to fit in 16 bits")
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(back[sign] for sign in token)
        shown = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(shown)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.a_space = np.array([x.startswith(b" ") for x in self.a_bytes])
        self.b_space = np.array([x.startswith(b" ") for x in self.b_bytes])
        self.blank = self.b.piece_to_id("▁")
        before = json.loads(byte_level).get("pre_tokenizer") or {}
        self.apart = (
            before.get("type") == "ByteLevel" and before.get("use_regex", False) and self.blank != self.b.unk_id()
            and not any(re.search("[^▁]▁|\n", piece) for piece in shown)
        )
        # Merges in the order of their ids can be done by rank, which is faster. Both libraries cut characters below U+0250
        # alike; others are left to the tokenizer of the file, as their classes depend on the Unicode version.
        merges = [m if isinstance(m, str) else " ".join(m) for m in json.loads(byte_level)["model"]["merges"]]
        self.ranked = None
        if self.apart and all(vocabulary.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges)):
            special = set(self.a.get_added_tokens_decoder())
            ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in special}
            self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        """Drop the encoded parts; their places are no longer valid."""
        self.known: dict[str, int] = {}
        self.wrong: set[int] = set()
        self.a_ids, self.b_ids = array("H"), array("H")
        self.a_ends, self.b_ends = array("q", [0]), array("q", [0])

    def full(self) -> bool:
        return len(self.known) >= PARTS or len(self.a_ids) >= PART_IDS

    def _learn(self, keys: list[str]) -> None:
        """Encode parts that are not known. A key is a part, without its blank if just one is in front."""
        parts = [key if key[:1] in (" ", "\n") else " " + key for key in keys]
        without = [part[1:] if part[0] == " " else part for part in parts]
        for key, part, b in zip(keys, parts, self.b.encode(without, num_threads=1)):
            if part[0] != " ":
                b = b[1:]  # the blank that B puts in front
            elif part == " ":
                b = [self.blank]
            plain = self.ranked is not None and max(part) < "ɐ"
            a = self.ranked.encode_ordinary(part) if plain else self.a.encode(part, add_special_tokens=False).ids
            place = self.known[key] = len(self.known)
            want = part.encode()
            if b"".join([self.a_bytes[i] for i in a]) != want or b"".join([self.b_bytes[i] for i in b]) != want:
                self.wrong.add(place)
            self.a_ids.extend(a)
            self.b_ids.extend(b)
            self.a_ends.append(len(self.a_ids))
            self.b_ends.append(len(self.b_ids))

    def parts(self, text: str) -> list[np.ndarray]:
        """Places of the parts of space+text, by segment; [] if a tokenizer does not give the text back."""
        if not text:
            return []
        out = []
        for piece in _pieces(" " + text):
            if not self.apart:
                keys = [piece]
            elif _GAP.search(piece):
                keys = _CUT.split(piece)
            else:
                keys = piece.replace("\n", " \n").split(" ")[1:]
            known = self.known
            found = [known.get(key, -1) for key in keys]
            if -1 in found:
                self._learn(list({key for key, place in zip(keys, found) if place < 0}))
                found = [known[key] for key in keys]
            if not self.wrong.isdisjoint(found):
                return []
            out.append(np.array(found, dtype=np.int32))
        return out


def _pieces(text: str):
    """``text`` in parts of about PART characters, cut in front of a blank between two other signs."""
    start, at = 0, PART
    while at < len(text):
        at = text.find(" ", at)
        if at < 0 or at + 1 >= len(text):
            break
        if text[at - 1].isspace() or text[at + 1].isspace():
            at += 1
            continue
        yield text[start:at]
        start, at = at, at + PART
    yield text[start:]


def align(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
    """(group of each token of A, of B, links, the group each link is in) of two runs of ids over the same bytes.

    Between two neighbouring ends of either side lies one token of each, so every end is one link.
    """
    ends = np.union1d(ends_a, ends_b)
    in_a, in_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    shared = ends[(ends_a[in_a] == ends) & (ends_b[in_b] == ends)]
    return (np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b),
            (a[in_a] << 16 | b[in_b]).astype("<u4"), np.searchsorted(shared, ends))


def _texts(a, b, group_a, group_b, window_of_group, n_windows) -> list[str]:
    """The groups of each window as text: ids of A, a bar, ids of B; groups are parted by semicolons."""
    groups = np.arange(len(window_of_group))
    before_b = np.searchsorted(group_b, groups)
    until_a = np.searchsorted(group_a, groups, side="right")
    ids = np.empty(len(a) + len(b), dtype=np.int64)
    marks = np.zeros(len(ids), dtype=np.int64)
    place_a, place_b = np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + until_a[group_b]
    ids[place_a], ids[place_b] = a, b
    marks[place_a[until_a - 1]] = 1
    marks[place_b[np.searchsorted(group_b, groups, side="right") - 1]] = 2
    shown = _SHOWN[marks * 65536 + ids]
    window = np.empty(len(ids), dtype=np.int64)
    window[place_a], window[place_b] = window_of_group[group_a], window_of_group[group_b]
    cuts = np.searchsorted(window, np.arange(n_windows + 1)).tolist()
    return ["".join(shown[start:end])[:-1] for start, end in zip(cuts, cuts[1:])]


_SHOWN = np.array([f"{i}{mark}" for mark in ",|;" for i in range(65536)], dtype=object)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    ahead = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - ahead, sizes)


class Block:
    """Documents of a task, aligned in batches of tokens, and the different windows seen so far."""

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.places: dict[bytes, int] = {}
        self.groups: list[int] = []
        self.texts: list[str] = []
        self.sizes: list[int] = []
        self.links: list[np.ndarray] = []
        self.uses: list[np.ndarray] = []
        self.docs: list[list] = []
        self.place_of_part = np.full(0, -1, dtype=np.int64)
        self.waiting: list[tuple[int, np.ndarray]] = []
        self.tokens = self.bytes = 0

    def add(self, doc_id, text: str | None) -> None:
        segments = self.t.parts(text or "")
        self.docs.append([doc_id, 0, 0, 0, 0, hashlib.sha256() if segments else None, []])
        for parts in segments:
            self.waiting.append((len(self.docs) - 1, parts))
            self.tokens += 3 * len(parts)
            if self.tokens >= TOKENS:
                self.work()
        self.bytes += len(text or "")

    def full(self) -> bool:
        """True when the block has to be written; the tokenizers may then forget their parts."""
        return (self.bytes >= BLOCK_BYTES or len(self.docs) >= BLOCK_ROWS or len(self.groups) >= BLOCK_WINDOWS
                or self.t.full())

    def _places(self, a, b, at_a, n_a, at_b, n_b, parts, starts_a) -> np.ndarray:
        """The place of every window in this block's list. One that is a single known part is found by that part."""
        part = np.minimum(np.searchsorted(starts_a, at_a), len(parts) - 1)
        single = (starts_a[part] == at_a) & (starts_a[part + 1] == at_a + n_a)
        out = np.empty(len(at_a), dtype=np.int64)
        if len(self.place_of_part) < len(self.t.known):
            more = np.full(2 * len(self.t.known) - len(self.place_of_part), -1, dtype=np.int64)
            self.place_of_part = np.r_[self.place_of_part, more]
        at = np.flatnonzero(single)
        mine = parts[part[at]]
        new, first = np.unique(mine[self.place_of_part[mine] < 0], return_index=True)
        if len(new):
            first = at[np.flatnonzero(self.place_of_part[mine] < 0)[first]]
            self.place_of_part[new] = len(self.groups) + np.arange(len(new))
            self._align(a, b, at_a[first], n_a[first], at_b[first], n_b[first])
        out[at] = self.place_of_part[mine]
        at = np.flatnonzero(~single)
        out[at] = self._windows(a, b, at_a[at], n_a[at], at_b[at], n_b[at])
        return out

    def _windows(self, a, b, at_a, n_a, at_b, n_b) -> np.ndarray:
        """The place of every window in this block's list.

        Windows of one shape are compared as rows of ids, so equal places mean equal ids. Those that are new to the block
        are aligned together.
        """
        out = np.empty(len(at_a), dtype=np.int64)
        shape = n_a * (1 << 30) + n_b
        order = np.argsort(shape, kind="stable")
        cuts = np.flatnonzero(np.diff(shape[order], prepend=-1))
        known, new, base = self.places, [], len(self.groups)
        for start, end in zip(cuts, [*cuts[1:], len(order)]):
            mine = order[start:end]
            wide_a, wide_b = int(n_a[mine[0]]), int(n_b[mine[0]])
            rows = np.empty((len(mine), 2 + wide_a + wide_b), dtype="<u2")
            rows[:, 0], rows[:, 1] = wide_a & 65535, wide_a >> 16
            rows[:, 2 : 2 + wide_a] = a[at_a[mine][:, None] + np.arange(wide_a)]
            rows[:, 2 + wide_a :] = b[at_b[mine][:, None] + np.arange(wide_b)]
            if len(mine) > 1:
                _, first, same = np.unique(_sums(rows), return_index=True, return_inverse=True)
                if (rows != rows[first[same]]).any():  # two windows of one sum: compare them all
                    _, first, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            else:
                first = same = np.zeros(1, dtype=np.int64)
            data, size = rows[first].tobytes(), 2 * rows.shape[1]
            places = []
            for i, key in enumerate([data[k : k + size] for k in range(0, len(data), size)]):
                place = known.get(key)
                if place is None:
                    place = known[key] = base + len(new)
                    new.append(mine[first[i]])
                places.append(place)
            out[mine] = np.array(places, dtype=np.int64)[same.reshape(-1)]
        if new:
            self._align(a, b, *[x[np.array(new)] for x in (at_a, n_a, at_b, n_b)])
        return out

    def _align(self, a, b, at_a, n_a, at_b, n_b) -> None:
        """Groups and links of windows, laid end to end."""
        take_a, take_b = _runs(at_a, n_a), _runs(at_b, n_b)
        a, b = a[take_a], b[take_b]
        ends_a, ends_b = np.cumsum(self.t.a_size[a]), np.cumsum(self.t.b_size[b])
        group_a, group_b, links, group_of_link = align(a, b, ends_a, ends_b)
        last_group = group_a[np.cumsum(n_a) - 1]
        window_of_group = np.searchsorted(last_group, np.arange(int(last_group[-1]) + 1))
        window_of_link = window_of_group[group_of_link]
        self.groups += np.diff(last_group, prepend=-1).tolist()
        self.sizes += np.bincount(window_of_link, minlength=len(n_a)).tolist()
        self.links.append(links)
        self.texts += _texts(a, b, group_a, group_b, window_of_group, len(n_a))

    def work(self) -> None:
        """Align the documents that wait."""
        if not self.waiting:
            return
        docs, parts = [doc for doc, _ in self.waiting], np.concatenate([x for _, x in self.waiting])
        stops = np.cumsum([len(x) for _, x in self.waiting])
        self.waiting, self.tokens = [], 0
        ids, starts = [], []
        for held, held_ends in ((self.t.a_ids, self.t.a_ends), (self.t.b_ids, self.t.b_ends)):
            held_ends = np.array(held_ends)
            sizes = held_ends[parts + 1] - held_ends[parts]
            ids.append(np.array(held)[_runs(held_ends[parts], sizes)].astype(np.int64))
            starts.append(np.r_[0, np.cumsum(sizes)])
        (a, b), lengths_a, lengths_b = ids, np.diff(starts[0][stops], prepend=0), np.diff(starts[1][stops], prepend=0)
        ends_a, ends_b = np.cumsum(self.t.a_size[a]), np.cumsum(self.t.b_size[b])
        last_a = np.searchsorted(ends_a, ends_b)
        last_b = np.flatnonzero(ends_a[last_a] == ends_b)
        last_a = last_a[last_b]
        # A shared end is an anchor in front of tokens that start with a space, and at the end of a segment.
        anchor = np.zeros(len(last_a), dtype=bool)
        inner = np.flatnonzero(last_a + 1 < len(a))
        anchor[inner] = self.t.a_space[a[last_a[inner] + 1]] & self.t.b_space[b[last_b[inner] + 1]]
        segment_ends = np.searchsorted(last_a, np.cumsum(lengths_a) - 1)
        anchor[segment_ends] = True
        stop_a, stop_b = last_a[anchor] + 1, last_b[anchor] + 1
        at_a, at_b = np.r_[0, stop_a[:-1]], np.r_[0, stop_b[:-1]]
        places = self._places(a, b, at_a, stop_a - at_a, at_b, stop_b - at_b, parts, starts[0])
        bounds = np.r_[0, np.cumsum(anchor)[segment_ends]]
        groups = np.r_[0, np.cumsum(np.array(self.groups, dtype=np.int64)[places])]
        links = np.r_[0, np.cumsum(np.array(self.sizes, dtype=np.int64)[places])]
        self.uses.append(np.bincount(places, minlength=len(self.groups)))
        for k, doc in enumerate(docs):
            start, end = bounds[k], bounds[k + 1]
            state, mine = self.docs[doc], places[start:end]
            text = ";".join([self.texts[i] for i in mine.tolist()])
            state[5].update((";" + text if state[1] else text).encode())
            state[1] += int(lengths_a[k])
            state[2] += int(lengths_b[k])
            state[3] += int(groups[end] - groups[start])
            state[4] += int(links[end] - links[start])
            state[6].append(mine)

    def rows(self) -> pa.RecordBatch:
        """A row per document, and one that holds what is common to the block."""
        self.work()
        block, columns = uuid.uuid4().int >> 65, [[] for _ in _SCHEMA]
        for doc_id, n_a, n_b, n_groups, n_links, digest, windows in self.docs:
            found, times = np.unique(np.concatenate(windows) if windows else np.zeros(0, np.int64), return_counts=True)
            values = (block, doc_id, n_a, n_b, n_groups, n_links, digest.hexdigest() if digest else "",
                      _packed(np.diff(found, prepend=0)), _packed(times), None, None, None, None)
            for column, value in zip(columns, values):
                column.append(value)
        sizes, uses = np.array(self.sizes, dtype=np.int64), np.zeros(len(self.sizes), dtype=np.int64)
        for part in self.uses:
            uses[: len(part)] += part
        pairs, inverse = np.unique(np.concatenate([np.zeros(0, "<u4"), *self.links]), return_inverse=True)
        totals = _summed(inverse, np.repeat(uses, sizes), len(pairs))
        for column, value in zip(columns, (block, *[None] * 8, _packed(pairs), _packed(totals), _packed(sizes), _packed(inverse))):
            column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


_FACTORS = np.random.default_rng(20240311).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sums(rows: np.ndarray) -> np.ndarray:
    """A number per row; equal rows have equal numbers."""
    out = np.zeros(len(rows), dtype=np.uint64)
    for i in range(rows.shape[1]):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (rows[:, i].astype(np.uint64) + np.uint64(1)) * _FACTORS[i % len(_FACTORS)]
    return out


def _summed(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of integers by key."""
    order = np.argsort(keys, kind="stable")
    total = np.r_[0, np.cumsum(values[order])]
    return np.diff(total[np.searchsorted(keys[order], np.arange(size), side="right")], prepend=0)


def _packed(values: np.ndarray) -> bytes:
    """Integers as compressed 32- or 64-bit numbers; the first byte tells which."""
    wide = len(values) > 0 and int(values.max()) >= 1 << 32
    return (b"8" if wide else b"4") + zlib.compress(values.astype("<u8" if wide else "<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), dtype="<u8" if data[:1] == b"8" else "<u4").astype(np.int64)


_loaded: dict[int, Tokenizers] = {}


def _tokenizers(byte_level: str, pieces: bytes) -> Tokenizers:
    """The tokenizers of this process."""
    key = hash((byte_level, pieces))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(byte_level, pieces)
    return _loaded[key]


def encoded(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows of all documents and blocks; ``byte_level`` and ``pieces`` are the paths of the vocabulary files."""
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def blocks(batches):
        tokenizers = _tokenizers(*files.value)
        block = Block(tokenizers)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py())
                if block.full():
                    yield block.rows()
                    if tokenizers.full():
                        tokenizers.forget()
                    block = Block(tokenizers)
        if block.docs:
            yield block.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(blocks, _ROWS)


def _asked(batches):
    """(block, pair, n) of the rows of blocks."""
    for batch in batches:
        for block, pairs, totals in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            pairs = _unpacked(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(_unpacked(totals))], names=["block", "pair", "n"]
            )


def _finish(answers: pa.Table, rows: pa.Table) -> pa.Table:
    """Sums over the links of every document of a block, by its different windows."""
    rows = rows.to_pylist()
    common = next(row for row in rows if row["pairs"] is not None)
    pair = answers.column("pair").to_numpy()
    order = np.argsort(pair, kind="stable")
    if not np.array_equal(pair[order], _unpacked(common["pairs"])):
        raise RuntimeError("a block has to get an answer for every pair it asks for")
    links, sizes = _unpacked(common["links"]), _unpacked(common["sizes"])
    per_window = []
    for name in ("is_best", "count"):
        value = answers.column(name).to_numpy(zero_copy_only=False).astype(np.int64)[order]
        total = np.r_[0, np.cumsum(value[links])]
        per_window.append(np.diff(total[np.cumsum(sizes)], prepend=0))
    out = {name: [] for name in _RESULT.names}
    for row in rows:
        if row["pairs"] is None:
            windows, times = np.cumsum(_unpacked(row["windows"])), _unpacked(row["times"])
            for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
                out[name].append(row[name])
            for name, value in zip(("n_best", "count_sum"), per_window):
                out[name].append(int((value[windows] * times).sum()))
    return pa.Table.from_pydict(out, schema=_RESULT)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, is_best): links of each pair of ids in the corpus, and whether no other pair of its B id has more."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = stored(counts.withColumn("_b", F.col("pair").bitwiseAND(65535)), "alignment-pairs")
    best = counts.groupBy("_b").agg(F.max("count").alias("_most"))  # 65,536 rows at most
    return counts.join(F.broadcast(best), "_b").select("pair", "count", (F.col("count") == F.col("_most")).alias("is_best"))


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, links of the highest count, counts summed over links."""
    rows = stored(encoded(docs, byte_level, pieces), "alignment-rows")
    asked = rows.where("pairs IS NOT NULL").select("block", "pairs", "totals").mapInArrow(_asked, "block long, pair long, n long")
    answers = asked.select("block", "pair").join(pair_counts(asked), "pair")
    return answers.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(_finish, RESULT)
