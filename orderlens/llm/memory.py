"""Give freed memory back when a task ends: Python workers live on, and idle ones count."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def trimmed(run: Callable[[Batches], Batches], encodes: bool = False) -> Callable[[Batches], Batches]:
    """``run``, after which the allocators return what they hold but do not use.  A task that
    does not encode texts drops the encoders and aligners that an earlier stage left in its worker."""
    def wrapped(batches: Batches) -> Batches:
        for module in ("orderlens.llm.encode", "orderlens.llm.align"):
            if not encodes and module in sys.modules:
                sys.modules[module].forget()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return wrapped
