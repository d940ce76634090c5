"""Memory that a task has used goes back to the system when the task ends.

Python workers outlive tasks, and what their allocators keep is missing to the executor in later stages.
"""
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidy(task: Callable) -> Callable:
    """A task on batches that gives memory back at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()
    return run
