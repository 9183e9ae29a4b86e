"""Small helpers for Arrow-batched functions."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa


def align(results: Iterable, inputs: pd.Series) -> pd.Series:
    """Results of the non-null inputs, in order, put back at their places; null elsewhere."""
    values = iter(results)
    return pd.Series([next(values) if known else None for known in inputs.notna()], dtype=object)


def give_back() -> None:
    """Return a Python worker's freed memory to the system. Workers outlive their tasks, and what their allocators
    keep for themselves counts against the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
