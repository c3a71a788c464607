"""Numeric views of text that several operators share. Runs inside tasks, on NumPy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@lru_cache(maxsize=4)
def _folding(digits: bool) -> np.ndarray:
    """For each code point of the first plane its lower case, or a space if it is no letter
    (or digit)."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalnum() if digits else ch.isalpha():
            out[c] = ord(ch.lower()[0])
    return out


def folded(text: str | None, digits: bool = True, rim: int = 0) -> np.ndarray:
    """Lower-case words of a text as code points, with one space between.

    Everything but letters (and digits) is a space.
    ``rim`` adds so many spaces at both ends of a text that has a word.
    """
    points = code_points(text or "")
    table = _folding(digits)
    out = table[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        known, back = np.unique(points[far], return_inverse=True)
        kept = [c if (c.isalnum() if digits else c.isalpha()) else " " for c in map(chr, known)]
        out[far] = np.array([ord(c.lower()[0]) for c in kept], np.uint32)[back]
    solid = out != 32
    if not solid.any():
        return np.zeros(0, np.uint32)
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # one space after a word
    out = out[keep]
    if out[-1] == 32:
        out = out[:-1]
    return np.pad(out, rim, constant_values=32) if rim else out


def gram_codes(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code of each run of ``n`` code points (empty if there are fewer)."""
    return next(gram_codes_of(points, (n,)))


def gram_codes_of(points: np.ndarray, lengths: Sequence[int]) -> Iterator[np.ndarray]:
    """The codes of the runs of each of some ascending lengths."""
    wide = points.astype(np.uint64)
    out, have = wide.copy(), 1
    for n in lengths:
        while have < n and len(out):
            out = out[:-1] * _BASE
            out += wide[have:]
            have += 1
        yield (out + np.uint64(n)) * _MIX


class CodeTable:
    """Exact lookup of many 64-bit codes in a set of known ones."""

    def __init__(self, codes: np.ndarray):
        known = np.unique(np.asarray(codes, np.uint64))
        bits = max(8, len(known).bit_length() + 3)
        self._shift = np.uint64(64 - bits)
        slot = self._slots(known)
        order = np.argsort(slot, kind="stable")
        self.codes = known[order]
        self._start = np.searchsorted(slot[order], np.arange(2**bits + 1)).astype(np.int32)
        self._used = np.diff(self._start) > 0
        self._deepest = int(np.diff(self._start).max(initial=0))

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes * _MIX >> self._shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``codes`` that are known, and where they are in ``self.codes``."""
        slot = self._slots(codes)
        at = np.flatnonzero(self._used[slot])
        slot = slot[at]
        codes, first, last = codes[at], self._start[slot], self._start[slot + 1]
        origin, at = at, np.arange(len(at))
        places, found = [], []
        for r in range(self._deepest):
            at = at[first[at] + r < last[at]]
            hit = self.codes[first[at] + r] == codes[at]
            places.append(origin[at[hit]])
            found.append(first[at[hit]].astype(np.int64) + r)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)


def pieces(text: np.ndarray, size: int, overlap: int) -> Iterator[np.ndarray]:
    """Cut a long sequence into pieces that share ``overlap`` items: every run of
    ``overlap + 1`` characters lies in exactly one piece."""
    if len(text) <= size:
        yield text
        return
    for i in range(0, max(1, len(text) - overlap), size - overlap):
        yield text[i : i + size]


def word_blocks(text: str, carry: int, size: int = 1 << 20, lower: bool = True) -> Iterator[list[bytes]]:
    """The words of a text (UTF-8, A-Z lowered unless told otherwise, split at ASCII white space)
    in blocks of bounded size; each block starts with the last ``carry`` words of the one before."""
    raw = text.encode("utf-8", "surrogatepass")
    raw = raw.lower() if lower else raw
    if len(raw) <= size:
        yield raw.split()
        return
    kept: list[bytes] = []
    i = 0
    while i < len(raw):
        j = min(len(raw), i + size)
        while j < len(raw) and raw[j] not in b" \t\n\x0b\x0c\r":
            j += 1
        block = kept + raw[i:j].split()
        yield block
        kept = block[-carry:] if carry else []
        i = j
