from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out a single time, however often ``body`` names it.

    A column named several times, or inside the lambda of an array function, is evaluated at each of these places; a lambda's own
    variable isn't.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def cuts(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` values, one row at least; ``ends`` are an Arrow array's offsets."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1)
        yield i, j
        i = j


def offsets_of(a: pa.Array) -> np.ndarray:
    """Offsets of the rows of a list, string or binary array, one more than it has rows."""
    return np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int32)


def list_array(rows: list, kind: pa.DataType) -> pa.ListArray:
    """Numpy arrays (None: null) as one Arrow list array, without a Python object per value."""
    ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)], dtype=np.int32)
    held = [r for r in rows if r is not None]
    flat = pa.array(np.concatenate(held) if held else [], kind)
    return pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array([r is None for r in rows], pa.bool_()))
