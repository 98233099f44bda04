"""Memory that a Python worker gives back."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system.

    Workers outlive their tasks and wait beside the stages that follow. What a task has
    freed would else stay with them: Arrow and the C library keep it for the next one.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def giving_back(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` of the batches of a task; what it leaves behind goes back to the system."""

    @functools.wraps(function)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return task


def given_back(result: pa.Table) -> pa.Table:
    """``result`` as it is; what was freed on the way to it goes back to the system."""
    give_back()
    return result
