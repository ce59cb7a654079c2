"""Compressed blobs of number arrays, and runs of equal rows."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed blob of byte planes."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        out += [len(a).to_bytes(8, "little"), a.dtype.itemsize.to_bytes(8, "little"), np.ascontiguousarray(planes).tobytes()]
    return zstandard.compress(b"".join(out), 3)


def expand(blob: bytes, *types: type) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(blob), 0, []
    for kind in types:
        n, width = (int.from_bytes(data[at + i:at + i + 8], "little") for i in (0, 8))
        planes = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1) if n else np.zeros(0, kind))
        at += 16 + n * width
    return out


def runs(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and size of each run; ``change`` is true where one begins."""
    first = np.flatnonzero(change)
    return first, np.diff(np.r_[first, len(change)])


def differs(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out
