"""Memory that a Python worker is done with goes back to the system.

Workers wait for the next task, and several of one executor stand side by side; what their
allocators keep of a finished task would count against the executor as long as they wait.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others need it less
    if trim is not None:
        trim(0)


def released(task: Task) -> Task:
    """The same task; at its end the worker's free memory is given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
