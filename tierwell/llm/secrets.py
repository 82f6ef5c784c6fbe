"""Secrets in texts: fixed patterns, and values in a credential's place that are hard to guess.

The fixed patterns (assignments, access keys, hexadecimal strings) are found as they are. Beside them stand values that
follow a credential's name ("passphrase: ...", "Bearer ...", "user:...@host"), which may be anything: placeholders, words,
or secrets. What tells them apart is how many guesses they would take.

Method: password guess-cost dynamic programming. A value is cut into words, dates, repeats, keyboard walks and single
signs so that the sum of the logarithms of their guesses is least; a value of 10**10 guesses or more is a secret. A word
takes as many guesses as there are words in the corpus for one occurrence of it: counts cover all texts (without the
values themselves) and grow with them.

On Spark: one pass finds spans and values, one counts words, combined per task before the shuffle; the substrings of the
different values meet the word counts in a join, and each different value is priced once. Only values, never texts, are
shuffled; a value that a third of all rows repeat is one row of the pricing.

Hard cases: a null text is empty; empty texts have no spans; rows that share an id, or have none, are documents of their
own and get a row each; values of any length are priced whole; other columns are ignored; an empty table gives no rows.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm.common import stored
from tierwell.llm.terms import Counts, terms

# The patterns of the base spans, in the order of their kinds.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: A value behind a credential's name and a sign of assignment, behind "Bearer", or between a user and a host.
CONTEXT = re.compile(
    r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private|secret|auth|encryption)[_ -]?key)
        ["']?\ {0,4}(?::=|=>|[:=]|is\ )\ {0,4}["'`]?([^\s"'`<>,;]{6,})
      | \bbearer\ {1,4}([^\s"'`<>,;]{6,})
      | ://[^\s/:@"']{1,64}:([^\s/@"']{6,})@""", re.IGNORECASE | re.ASCII | re.VERBOSE
)
#: Without one of these, in lower case, neither CONTEXT nor ASSIGN can match.
NAMES = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key", b"bearer", b"://")
_HEXADECIMAL = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))

#: Logarithm of the guesses from which on a value is a secret.
HARD = 10.0
#: Lengths of words, dates and of blocks that may repeat.
SHORTEST_WORD, LONGEST_WORD, LONGEST_BLOCK = 3, 24, 8

_LEET = str.maketrans("013457@$!", "oleastasi")
_DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
_YEAR = re.compile(r"(?:19|20)\d\d")
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_KEYS = {key: (column + row / 2, row) for row, keys in enumerate(_ROWS) for column, key in enumerate(keys)}


def spans(data: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, bool]]]:
    """Base spans (start, kind, end), sorted, and values (start, end, value, whether a base span covers some of it)."""
    lower = data.lower()
    named = any(name in lower for name in NAMES)
    long_hex = bytes([1]) * LEAST_HEX in data.translate(_HEXADECIMAL)
    if not (named or long_hex or b"AKIA" in data):
        return [], []
    text = data.decode("utf-8", "replace")
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE] if named else []
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    values = []
    for match in CONTEXT.finditer(text) if named else ():
        start, end = match.span(match.lastindex)
        values.append((start, end, match[match.lastindex], any(a < end and start < b for a, _, b in _near(base, start, end))))
    return base, values


def _near(base, start, end):
    """Base spans that may touch [start, end): sorted by start, and those of one kind do not overlap."""
    low, high = 0, len(base)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if base[middle][0] < end else (low, middle)
    behind = set()
    for i in range(low - 1, -1, -1):
        if base[i][1] not in behind:
            yield base[i]
            if base[i][2] <= start:
                behind.add(base[i][1])
        if len(behind) == 3:
            return


_FOUND = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("found", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("covered", pa.bool_())]))),
])
_FOUND_SQL = ("doc_id long, base array<struct<start:int,kind:int,end:int>>, "
              "found array<struct<start:int,end:int,value:string,covered:boolean>>")


def _find(batches):
    for batch in batches:
        base, found = [], []
        for text in batch.column(1).cast(pa.large_binary()):
            spans_of, values = spans(text.as_py())
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans_of])
            found.append([{"start": a, "end": b, "value": v, "covered": c} for a, b, v, c in values])
        columns = [pa.array(x, field.type) for x, field in zip((base, found), list(_FOUND)[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=_FOUND)


def _count(batches):
    """Terms of the texts without their values and base spans."""
    state = Counts([])
    for batch in batches:
        for text in batch.column(1).cast(pa.large_binary()):
            data = text.as_py()
            base, values = spans(data)
            if base or values:
                shown, at, kept = data.decode("utf-8", "replace"), 0, []
                for start, end in sorted([(a, b) for a, _, b in base] + [(a, b) for a, b, _, _ in values]):
                    kept.append(shown[at:start])
                    at = max(at, end)
                data = " ".join([*kept, shown[at:]]).encode()
            if state.add((), data):
                yield from state.flush()
    yield from state.flush()


def readings(value: str) -> tuple[str, str]:
    """The value in lower case (A-Z only, so that places stay), and with digits and signs read as letters."""
    lower = "".join([chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value])
    return lower, lower.translate(_LEET)


def _substrings(batches):
    """(id, term): the different stretches of letters in each value that may be a word."""
    for batch in batches:
        for value_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen: set[str] = set()
            for reading in dict.fromkeys(readings(value)):
                for run in (run.decode() for found in terms(reading.encode()) for run in found):
                    for start in range(len(run)):
                        stop = min(len(run), start + LONGEST_WORD)
                        seen.update([run[start:end] for end in range(start + SHORTEST_WORD, stop + 1)])
                        if len(seen) > 50_000:  # repeats across two lots do no harm
                            yield _lot(value_id, seen)
                            seen = set()
            if seen:
                yield _lot(value_id, seen)


def _lot(value_id, seen):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), value_id)), pa.array(list(seen), pa.string())], names=["id", "term"])


def sign_cost(sign: str) -> float:
    """Logarithm of the number of signs of one's kind."""
    return math.log10(10 if sign.isdigit() else 26 if sign.isascii() and sign.isalpha() else 33 if sign.isascii() else 100)


def _case_cost(word: str) -> float:
    """All small letters take no more guesses, a capital in front or all capitals twice as many, others by their choice."""
    capitals = sum("A" <= c <= "Z" for c in word)
    if not capitals:
        return 0.0
    if capitals == len(word) or capitals == 1 and "A" <= word[0] <= "Z":
        return math.log10(2)
    return math.log10(sum(math.comb(len(word), k) for k in range(1, min(capitals, len(word) - capitals) + 1)) + 1)


def _walks(lower: str):
    """(start, end, cost) of the longest runs of four and more neighbouring keys, with their turns, and of alphabetic runs."""
    def direction(a, b):
        if a in _KEYS and b in _KEYS:
            dx, dy = _KEYS[b][0] - _KEYS[a][0], _KEYS[b][1] - _KEYS[a][1]
            if abs(dx) <= 1 and abs(dy) <= 1 and (dx or dy):
                return dx, dy
        step = ord(b) - ord(a)
        return step if abs(step) == 1 and a.isalnum() and b.isalnum() else None

    start, turns, last = 0, 0, None
    for i in range(1, len(lower) + 1):
        step = direction(lower[i - 1], lower[i]) if i < len(lower) else None
        if step is None:
            if i - start >= 4:
                yield start, i, math.log10(47 * (i - start)) + turns * math.log10(4.6)
            start, turns, last = i, 0, None
        else:
            turns += last is not None and step != last
            last = step


def _repeats(value: str):
    """(start, end, cost) of blocks that follow themselves, three times and more for single signs."""
    for size in range(1, min(LONGEST_BLOCK, len(value) // 2) + 1):
        start = 0
        while start + 2 * size <= len(value):
            end = start + size
            while end < len(value) and value[end] == value[end - size]:
                end += 1
            times = (end - start) // size
            if times >= (3 if size == 1 else 2):
                block = sum(sign_cost(c) for c in value[start : start + size])
                yield start, start + times * size, block + math.log10(times)
                start = start + times * size - size + 1
            else:
                start += 1


def guesses(value: str, words: dict[str, int], total: int) -> float:
    """Logarithm of the guesses of the cheapest segmentation. ``words``: occurrences of words, ``total``: of all."""
    lower, leet = readings(value)
    jumps: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in [*_walks(lower), *_repeats(value)]:
        jumps.setdefault(end, []).append((start, cost))
    for pattern, cost in ((_DATE, math.log10(365 * 120)), (_YEAR, math.log10(120))):
        for match in pattern.finditer(value):
            jumps.setdefault(match.end(), []).append((match.start(), cost))
    best = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        least = best[end - 1] + sign_cost(value[end - 1])
        for start, cost in jumps.get(end, ()):
            least = min(least, best[start] + cost)
        for start in range(max(0, end - LONGEST_WORD), end - SHORTEST_WORD + 1):
            for reading, more in ((lower, 0.0), (leet, math.log10(2))):
                count = words.get(reading[start:end])
                if count and (not more or lower[start:end] != leet[start:end]):
                    least = min(least, best[start] + math.log10(max(total / count, 1)) + _case_cost(value[start:end]) + more)
        best[end] = least
    return best[-1]


def _price(batches):
    for batch in batches:
        values, words, totals = [batch.column(i).to_pylist() for i in range(3)]
        cost = [guesses(value, {w["term"]: w["n"] for w in known or ()}, total or 0) for value, known, total in zip(values, words, totals)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.float64())], names=["value", "guesses"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(term, n) of all texts, values left out."""
    return docs.mapInArrow(_count, "term string, n long, n_docs long").groupBy("term").agg(F.sum("n").alias("n"))


def priced_values(values: DataFrame, words: DataFrame) -> DataFrame:
    """(value, guesses) of different values; ``guesses`` is a logarithm to base 10."""
    values = stored(values.withColumn("id", F.monotonically_increasing_id()), "secret-values")
    found = values.select("id", "value").mapInArrow(_substrings, "id long, term string").join(words, "term")
    per_value = found.groupBy("id").agg(F.collect_set(F.struct("term", "n")).alias("words"))
    total = words.agg(F.sum("n").alias("total")).select("total").scalar()
    return values.join(per_value, "id", "left").select("value", "words", total.alias("total")).mapInArrow(
        _price, "value string, guesses double"
    )


def scan(docs: DataFrame, hard: float = HARD) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``findings`` (start, kind, end; sorted), ``priced`` (start, end, guesses).

    ``findings`` are the base spans and the values of ``hard`` guesses or more that no base span touches; ``priced`` are
    all values in a credential's place. ``kind`` is a place in KINDS; ends are exclusive, in code points.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(_find, _FOUND_SQL).withColumn("_row", F.monotonically_increasing_id()), "secret-spans")
    values = rows.where(F.size("found") > 0).select("_row", F.inline("found"))
    words = stored(word_counts(texts), "secret-words")
    priced = priced_values(values.select("value").distinct(), words)
    judged = values.join(priced, "value").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "guesses"))).alias("priced"),
        F.collect_list(F.when((F.col("guesses") >= hard) & ~F.col("covered"), F.struct(
            "start", F.lit(KINDS.index("guess")).alias("kind"), "end"
        ))).alias("added"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(judged, "_row", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("findings"),
        F.coalesce("priced", F.array().cast("array<struct<start:int,end:int,guesses:double>>")).alias("priced"),
    )


def listed(spans_column: str):
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
