"""What the two vector operators share: reading vectors into numpy."""

import numpy as np
import pyarrow as pa


def rows_of(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(index, vector as float64) of the rows that are not null, not empty and hold finite numbers only."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(values)
    if flat.null_count:
        bad |= flat.is_null().to_numpy(zero_copy_only=False)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    good = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & (offsets[1:] > offsets[:-1])
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    index = np.flatnonzero(good)
    return index, [values[offsets[i] : offsets[i + 1]] for i in index]
