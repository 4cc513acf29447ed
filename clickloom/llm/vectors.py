"""Vectors of Arrow batches as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def finite_rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values (rows, ``width``) of the lists of ``width`` numbers, none NULL, NaN or infinite."""
    size = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == width)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), width)
    good = np.isfinite(values).all(axis=1)
    return rows[good], values[good]
