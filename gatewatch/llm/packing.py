"""Number arrays as compact binary values, for rows that stand for many records."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(sorted_numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, byte plane by byte plane."""
    return pack_counts(np.diff(sorted_numbers, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_counts(data).view(np.uint64), dtype=np.uint64)


def pack_counts(numbers: np.ndarray) -> bytes:
    """Any 64-bit numbers, byte plane by byte plane."""
    planes = numbers.astype("<i8" if numbers.dtype.kind == "i" else "<u8").view(
        np.uint8).reshape(-1, 8).T.copy()
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def range_ends(ranges: int) -> np.ndarray:
    """Ends of the ranges that share the 64-bit numbers evenly, from 0 on; the last is open."""
    ends = [(b << 64) // ranges for b in range(ranges)]
    return np.array([*ends, (1 << 64) - 1], np.uint64)


def range_slices(sorted_numbers: np.ndarray, ranges: int) -> list[slice]:
    """The part of ascending numbers that falls into each range."""
    cuts = np.searchsorted(sorted_numbers, range_ends(ranges))
    cuts[-1] = len(sorted_numbers)
    return [slice(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]
