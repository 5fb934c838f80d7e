"""Words of many texts at once as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import unicodedata

import numpy as np

_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Beginnings of the names of characters in scripts without blanks.
UNSPACED = ("CJK ", "IDEOGRAPHIC ", "HIRAGANA", "KATAKANA", "HALFWIDTH KATAKANA", "BOPOMOFO", "THAI ", "LAO ", "KHMER ", "MYANMAR ", "YI ", "NUSHU ", "TANGUT ")


class _Signs(dict):
    """What stands for a character: a blank for a sign or blank, nothing for an invisible one, itself between blanks in a script without them."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        kind = unicodedata.category(c)
        if point < 128 or kind[0] in "LMN":
            name = unicodedata.name(c, "") if point >= 128 else ""
            out = f" {c} " if name.startswith(UNSPACED) else c
        else:
            out = "" if kind == "Cf" and point != 0x200B else " "
        self[point] = out
        return out


_signs = _Signs()


def separated(text: str) -> str:
    """The text with ASCII blanks wherever signs or blanks of any script, or characters without blanks, part words."""
    return text if text.isascii() else text.translate(_signs)


#: Bytes of words where signs separate, in a text that is ``separated``: ASCII letters, digits, underscore, and all of other scripts.
WORD_BYTES = np.zeros(256, dtype=bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (95, 96), (128, 256)):
    WORD_BYTES[_a:_b] = True
#: Bytes of words where white space separates.
DARK_BYTES = np.ones(256, dtype=bool)
DARK_BYTES[[0, 9, 10, 11, 12, 13, 32]] = False

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(20, n.bit_length())
        tables = []
        for base in (_BASE, _INVERSE):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            tables.append(np.cumprod(row, dtype=np.uint64))
        _powers[:] = tables
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers in which every bit depends on all."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(texts: list[str], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in turn, and where each text's words begin (one entry more than texts).

    A word is a longest run of bytes of ``kind``; its hash depends on its bytes alone.
    """
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"\0".join(raw) + b"\0", dtype=np.uint8)
    ends = np.cumsum([len(x) + 1 for x in raw])
    inside = kind[buffer]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    begin, end = edge[0::2], edge[1::2]
    power, inverse = _power_tables(len(buffer) + 1)
    total = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer + np.uint64(1)) * power[: len(buffer)], dtype=np.uint64, out=total[1:])
    hashes = mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return hashes, np.concatenate(([0], np.searchsorted(begin, ends)))


def run_hashes(hashes: np.ndarray, places: tuple[int, ...], seed: int = 0) -> np.ndarray:
    """For each start the hash of the words at the given places from there; as many as fit."""
    count = len(hashes) - places[-1]
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(count, np.uint64(seed * 2 + 1), dtype=np.uint64)
    for p in places:
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[p : p + count]
    return mixed(out)
