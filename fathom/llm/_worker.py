"""What a Python worker keeps between tasks: one model at most, which goes when a task with another one begins."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

import pyarrow as pa

from fathom.llm._text import slices

#: Bytes of text that are worked on at once: numpy's intermediate arrays take some fifty times as much.
SLICE = 1 << 20
_HELD: dict[Any, Any] = {}


def trim() -> None:
    """Gives freed memory back to the system, so that idle workers stay small beside the next step."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def model(name: Any, make: Callable[[], Any]) -> Any:
    """The worker's copy of a model, so that what it has learnt of units outlives a task."""
    if name not in _HELD:
        _HELD.clear()
        trim()
        _HELD[name] = make()
    return _HELD[name]


def parts(batches: Iterator[pa.RecordBatch], column: str, models: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches of a task in slices of bounded text. Tasks without ``models`` of their own free those of others."""
    if not models and _HELD:
        _HELD.clear()
        trim()
    for whole in batches:
        yield from slices(whole, column, SLICE)
    trim()
