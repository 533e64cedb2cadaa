"""Python workers of executors."""

from __future__ import annotations

import contextlib


def trimmed(run):
    """run(batches) that gives the memory it has used back to the system at its end: Python workers are kept for later tasks,
    and what each of them holds on to counts for its executor."""

    def whole(batches):
        yield from run(batches)
        _release()

    return whole


def _release() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such function
        ctypes.CDLL(None).malloc_trim(0)
