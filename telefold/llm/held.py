"""What a Python worker keeps from task to task.

Spark reuses workers and keeps several idle ones beside each core, so what each of them still holds adds up. Here a
worker holds the tables of one operator: as soon as another operator's are asked for, the others go. What a task has
freed goes back to the system when it ends.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable

import pyarrow as pa

_FORGET: list[tuple[str, Callable[[], None]]] = []
_AFTER_TASK: list[Callable[[], None]] = []
_now: list[str] = [""]


def give_back() -> None:
    """Returns freed memory to the system; the allocators would keep it."""
    for forget in _AFTER_TASK:
        forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than GNU's


def only(operator: str) -> None:
    """Drops what other operators hold in this process."""
    if _now[0] == operator:
        return
    _now[0] = operator
    for whose, forget in _FORGET:
        if whose != operator:
            forget()
    give_back()


def for_task(make: Callable) -> Callable:
    """Keeps the results of ``make`` while a task runs."""
    kept = functools.cache(make)
    _AFTER_TASK.append(kept.cache_clear)
    return kept


def tidy(work: Callable) -> Callable:
    """For a task's generator: gives memory back when it has ended."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def held(make: Callable) -> Callable:
    """Keeps the last two results of ``make`` until another module's function of this kind is called."""
    kept = functools.lru_cache(2)(make)
    _FORGET.append((make.__module__, kept.cache_clear))

    @functools.wraps(make)
    def get(*args):
        only(make.__module__)
        return kept(*args)

    return get
