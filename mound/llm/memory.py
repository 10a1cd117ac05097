"""Memory that a Python worker gives back when it is done with a partition.

Spark reuses workers, so what one stage leaves behind counts while the next
one runs: garbage, Arrow's pool, and pages that the allocator keeps.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa


#: Thresholds of Python's collector while a partition runs.
SELDOM = (100_000, 20, 50)


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library, whose allocator has no such call
        return lambda _: 0


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function over the batches of a partition, that gives its memory back at the end.

    Meanwhile garbage is collected more seldom: memos of many strings and
    lists hold no cycles, but each collection walks over all of them."""
    @wraps(run)
    def wrapped(batches):
        before = gc.get_threshold()
        gc.set_threshold(*SELDOM)
        try:
            yield from run(batches)
        finally:
            gc.set_threshold(*before)
            release()

    return wrapped


def lean_group(answer: Callable) -> Callable:
    """``answer``, a function of one group, that gives its memory back after each."""
    @wraps(answer)
    def wrapped(group):
        out = answer(group)
        release()
        return out

    return wrapped
