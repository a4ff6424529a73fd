"""Arrays of unsigned integers as short binary columns."""

from __future__ import annotations

import numpy as np
import zstandard

_PRESS, _FREE = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second bytes and so on, compressed: small or alike numbers take little room."""
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return bytes([used]) + _PRESS.compress(np.ascontiguousarray(planes[:used]).tobytes() if used else str(len(numbers)).encode())


def unpack(data: bytes) -> np.ndarray:
    used, told = data[0], _FREE.decompress(memoryview(data)[1:])
    if not used:
        return np.zeros(int(told), np.uint64)
    planes = np.frombuffer(told, np.uint8).reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :used] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(numbers, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_flags(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)
