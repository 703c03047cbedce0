"""Cutting Arrow batches by text volume, so that a worker's memory does not follow the number of rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


_held: dict[str, Callable[[], None]] = {}


def hold(name: str, drop: Callable[[], None]) -> None:
    """Say whose cache a worker process holds from now on; any other one, also an older one of that name, is dropped."""
    others = [other for other, drop_other in _held.items() if drop_other != drop]
    for other in others:
        _held.pop(other)()
    _held[name] = drop
    if others:
        give_back()


def nothing_held() -> None:
    """For operators without a cache: what others of this worker hold is dropped."""
    hold("", give_back)


def give_back() -> None:
    """Return freed memory to the machine, which the allocators of a worker that lives on would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def only(name: str) -> Callable[[Callable[..., Iterator[pa.RecordBatch]]], Callable[..., Iterator[pa.RecordBatch]]]:
    """For a task with a cache of that name: it begins without those of others, and leaves its worker with its own cache alone."""

    def wrap(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
        @wraps(work)
        def run(*args, **named) -> Iterator[pa.RecordBatch]:
            others = [other for other in _held if other != name]
            for other in others:
                _held.pop(other)()
            if others:
                give_back()
            try:
                yield from work(*args, **named)
            finally:
                give_back()

        return run

    return wrap


def lean(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """For a task without a cache: it begins without those of others, and leaves its worker, which lives on, without its own memory."""

    @wraps(work)
    def run(*args, **named) -> Iterator[pa.RecordBatch]:
        nothing_held()
        try:
            yield from work(*args, **named)
        finally:
            give_back()

    return run


def by_volume(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of the text column (a longer text makes a slice of its own); no row is split."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), "i8") + 64
        group = (np.cumsum(size) - size) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(int(a), int(b - a))
