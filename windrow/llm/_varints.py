"""Variable-length integers of whole arrays: seven bits a byte, low bits first, the high bit set on all bytes but a number's last."""

from __future__ import annotations

import numpy as np


def encode(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of non-negative ``numbers``, and where each begins, with the total at the end."""
    rest = numbers.astype(np.uint64)
    widths = np.ones(len(rest), np.int64)
    for k in range(1, 10):
        more = rest >= np.uint64(1 << (7 * k))
        if not more.any():
            break
        widths += more
    starts = np.concatenate([[0], np.cumsum(widths)])
    out = np.zeros(int(starts[-1]), np.uint8)
    for k in range(int(widths.max(initial=0))):
        held = widths > k
        digit = (rest[held] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[:-1][held] + k] = digit | np.where(widths[held] > k + 1, 128, 0).astype(np.uint64)
    return out, starts


def decode(data: bytes | np.ndarray) -> np.ndarray:
    """The numbers of ``data``, as :func:`encode` wrote them."""
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    if not len(raw):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(ends) == len(raw):
        return raw.astype(np.int64)
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)
