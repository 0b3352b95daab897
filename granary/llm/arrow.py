"""Between Arrow columns and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def slices(batches, rows: int = 1024):
    """Smaller batches, so that a batch of texts is never held as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def longs(col) -> np.ndarray:
    return _one(col).to_numpy(zero_copy_only=False)


def matrix(col, dtype=np.float64) -> np.ndarray:
    """A list column without nulls as rows; shorter lists are filled up with zeros."""
    col = _one(col)
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    wide = int(sizes.max(initial=0))
    if (sizes == wide).all():
        return flat.reshape(len(col), wide)
    out = np.zeros((len(col), wide), dtype)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def _one(col):
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
