"""Arrow batches of long texts: worked on in slices of bounded size, their memory given back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # text that a step of a task turns into Python objects


def give_back() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable) -> Callable:
    """``run`` over the batches of a task; what it freed then goes back to the system. Python workers are used again by other
    stages, and what they keep adds up in an executor's memory."""

    def whole_task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole_task


def tidied_group(run: Callable) -> Callable:
    """As ``tidied``, for a function of the two tables of a cogroup."""

    def whole_group(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    return whole_group


def bounds(texts: pa.Array, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Where slices of a text column begin and end: less than ``most`` bytes and one more text each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
    return [(a, b) for a, b in pairwise([0, *ends.tolist(), len(texts)]) if b > a]


def text_rows(batches: Iterable[pa.RecordBatch], key: str = "paper_id", text: str = "text") -> Iterator[list[tuple]]:
    """``(key, text)`` of the rows, in lists of bounded bytes whatever the size of a batch."""
    for batch in batches:
        for a, b in bounds(batch.column(text)):
            part = batch.slice(a, b - a)
            yield list(zip(part.column(key).to_pylist(), part.column(text).to_pylist()))


def to_batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    """Rows as an Arrow batch with these columns."""
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))
