"""Task functions that hand memory back when their task ends."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release() -> None:
    """Return freed memory of this process to the system. Python workers live on from stage to stage, and the allocators keep
    what the largest task so far took unless they are asked."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(task):
    """The task function (batches -> batches), followed by ``release``."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()

    return run
