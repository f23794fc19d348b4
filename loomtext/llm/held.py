"""One large object at a time in a Python worker, and memory given back at a task's end.

Spark reuses its Python workers from stage to stage, so what a module keeps for later batches (a tokenizer and its
cache, a table of words) and what allocators keep for later use would stay beside what the next stage needs.
An operator holds such an object by a key; whatever else was held before is dropped. ``lean`` wraps the
function of a mapInArrow: nothing of another operator is held when it begins, free memory is returned when it ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa

_held: dict[Hashable, Any] = {}


def hold(key: Hashable, make: Callable[[], Any]) -> Any:
    """The object of ``key``, made if it isn't the one that is held."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def trim() -> None:
    """Returns what the allocators have free; where the C library can't, only Arrow's does."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def lean(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` that begins with nothing held, unless it ``keeps`` something itself, and ends with free memory returned."""

    @wraps(run)
    def lean_run(batches: Iterator) -> Iterator:
        if not keeps:
            _held.clear()
        try:
            yield from run(batches)
        finally:
            trim()

    return lean_run
