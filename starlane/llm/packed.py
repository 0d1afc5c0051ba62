"""Arrays of numbers as small binary values."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte plane by byte plane, compressed; high planes are mostly zeros."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()
