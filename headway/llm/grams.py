"""N-grams of many texts at once as hashed numbers in numpy arrays."""

from __future__ import annotations

import numpy as np

_MIX = np.uint32(0x9E3779B1)
_STEP = np.uint32(0x01000193)


def joined(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by ``pad`` zeros; where each begins and ends."""
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"".join(x + b"\0" * pad for x in raw), dtype=np.uint8)
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + pad)[:-1])) if len(raw) else np.zeros(0, np.int64)
    return buffer, starts, starts + sizes


def hashed(codes: np.ndarray, n: int, bits: int, seed: int = 0) -> np.ndarray:
    """For each position the hash, below 2^bits, of the n codes from there on; zeros follow the last."""
    h = codes.astype(np.uint32) + np.uint32(seed * 7919 + 1)
    for k in range(1, n):
        h *= _STEP
        h[: len(codes) - k] += codes[k:]
    h ^= h >> np.uint32(15)
    h *= _MIX
    h ^= h >> np.uint32(13)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - bits)


def word_shapes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word (run without ASCII white space or zeros) begins, and a code below 256 for how it looks.

    The code says: length, capitals, digits, other signs, and whether the word is the one before again.
    """
    gap = (buffer == 32) | (buffer == 0) | ((buffer >= 9) & (buffer <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
        return total[end] - total[begin]

    length = end - begin
    upper = count((buffer >= 65) & (buffer <= 90))
    digit = count((buffer >= 48) & (buffer <= 57))
    sign = count((buffer > 32) & (buffer < 128)) - upper - digit - count((buffer >= 97) & (buffer <= 122))
    size = np.digitize(length, (3, 6, 12))
    capital = np.where(upper == 0, 0, np.where(upper > 1, 2, 1))
    # A word is the one before again if length and a checksum of its bytes agree.
    power = np.cumprod(np.full(len(buffer) or 1, 0x100000001B3, dtype=np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(buffer * power[: len(buffer)], dtype=np.uint64)))
    mark = total[end] - total[begin]
    same = np.zeros(len(begin), dtype=np.int64)
    if len(begin) > 1:
        # The sum of the earlier word, moved on by the distance between both.
        distance = begin[1:] - begin[:-1]
        moved = mark[:-1] * power[np.minimum(distance - 1, len(power) - 1)]
        same[1:] = (length[1:] == length[:-1]) & (moved == mark[1:])
    return begin, (1 + size + 4 * capital + 12 * (digit > 0) + 24 * np.minimum(sign, 3) + 96 * same).astype(np.uint8)
