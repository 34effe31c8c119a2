"""Arrow list columns as numpy arrays, without a Python object a sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as arrays of doubles that share its memory; NaN for a null, nothing for a null list."""
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [values[lo:hi] if ok else values[:0] for lo, hi, ok in zip(ends, ends[1:], valid, strict=False)]


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0)))
