"""Batches of a task's Python worker: smaller ones, and memory given back at its end."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows of an Arrow batch that a task works on at once.
SLICE = 512

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of them stays small."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def tidy(run: Batches) -> Batches:
    """``run``, and then the memory that it has freed goes back to the machine.

    Python workers outlive their task; without this, each keeps the largest batch that it ever saw.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # not every C library has it

    return tidied
