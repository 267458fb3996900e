"""Shipping of the package to Python workers, and what workers do between tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa

from panelweave.workers import ship

__all__ = ["release", "releasing", "remembered", "ship"]

_remembered: list[Callable] = []


def remembered(build: Callable) -> Callable:
    """Keep what a function builds for the next tasks of a worker, until another operator's task begins there."""
    cached = lru_cache(maxsize=2)(build)
    _remembered.append(cached)
    return cached


def release(*kept: Callable) -> None:
    """Give the memory that a worker no longer uses back to the system.

    Of what ``remembered`` functions hold, only that of the ``kept`` ones stays.
    """
    for cached in _remembered:
        if not any(cached is own for own in kept):
            cached.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable, *kept: Callable) -> Callable:
    """A function for ``mapInArrow`` whose task begins and ends without what is no longer used.

    Workers go on to the next stage; only what the ``kept`` functions remember stays.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(*kept)
        try:
            yield from run(batches)
        finally:
            release(*kept)

    return released
