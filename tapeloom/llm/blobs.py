"""Arrays of integers as binary cells that shuffle files compress well."""

from __future__ import annotations

import numpy as np


def pack_planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes, and so on: bytes that are mostly zero lie together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpack_planes(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences."""
    return pack_planes(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(blob, np.uint64), dtype=np.uint64)
