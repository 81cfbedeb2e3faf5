"""What a Python worker keeps between tasks: one model or cache at a time.

Spark uses its workers again for later stages. A stage that needs another object drops the
one before and gives its memory back, so the stages of a pipeline do not add up.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

Kept = TypeVar("Kept")

_kept: dict[Hashable, object] = {}


def keep(key: Hashable, build: Callable[[], Kept]) -> Kept:
    """The object kept under ``key``, built if another or none is kept."""
    if key not in _kept:
        release()
        _kept[key] = build()
    return _kept[key]


def release() -> None:
    """Drop what is kept."""
    if _kept:
        _kept.clear()
        trim()


def trim() -> None:
    """Give memory that is no longer in use back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps it otherwise
    if give_back:
        give_back(0)
