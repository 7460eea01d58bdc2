"""What a Python worker holds between tasks.

Workers outlive tasks and serve all operators in turn. Without care an executor pays, all at once, for what each operator kept in
them and for freed memory that was not handed back. So a worker keeps things of one owner at a time, and hands freed memory
back to the system after each task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_kept: dict[str, object] = {}


def kept(owner: str, make: Callable[[], T]) -> T:
    """What ``make`` returned for this owner in this worker; things of another owner are dropped."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def drop_kept() -> None:
    _kept.clear()


def give_back() -> None:
    """Hand freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, giving memory back at its end; unless it ``keeps`` things, those of others go first."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        # by functions of this module, so that a pickled task reaches the worker's own state
        if not keeps:
            drop_kept()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
