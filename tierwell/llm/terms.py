"""Terms (runs of letters and of everything beyond ASCII) and their counts, combined per task before any shuffle."""

from collections import Counter

import pyarrow as pa

#: Bytes of one text that are split at a time.
PIECE = 1 << 20
#: Distinct (group, term) entries a task gathers before it passes them on.
ENTRIES = 300_000

_CLASS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(data: bytes):
    """Lists of the terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes, A-Z in lower case.

    The cuts are at ASCII bytes only, so every term is whole UTF-8.
    """
    data = data.translate(_CLASS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Counts:
    """Occurrences of terms, and how many rows hold them, per group; emptied into Arrow batches."""

    def __init__(self, groups: list[str]):
        self.groups = groups
        self.held: dict[tuple, tuple[Counter, Counter]] = {}
        self.fresh = 0

    def add(self, group: tuple, data: bytes) -> bool:
        """True when it is time for ``flush``."""
        n, rows = self.held.setdefault(group, (Counter(), Counter()))
        before = len(n)
        seen: set[bytes] = set()
        for found in terms(data):
            n.update(found)
            seen.update(found)
        rows.update(seen)
        self.fresh += len(n) - before
        return self.fresh >= ENTRIES

    def flush(self):
        for group, (n, rows) in self.held.items():
            if not n:
                continue
            found = list(n)
            columns = [pa.array([value] * len(found), pa.string()) for value in group]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([rows[term] for term in found], pa.int64())],
                names=[*self.groups, "term", "n", "n_docs"],
            )
        self.held, self.fresh = {}, 0


def group_counts(batches, groups: list[str], text: str = "text"):
    """(groups..., term, n, n_docs) of Arrow batches that hold the group columns and the text, nothing null."""
    state = Counts(groups)
    for batch in batches:
        keys = zip(*[batch.column(name).to_pylist() for name in groups])
        for group, value in zip(keys, batch.column(text).cast(pa.large_binary())):
            if state.add(group, value.as_py()):
                yield from state.flush()
    yield from state.flush()
