"""Words, their hashes and word n-grams of whole texts, a million bytes at a time.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z became a-z: digits, letters a-z and
everything beyond ASCII. In UTF-8 those are exactly the bytes below, so words are found on bytes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CHUNK_BYTES = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator: spreads 64 bits over 64 bits, one to one."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def randoms(seed: int, n: int) -> np.ndarray:
    """n 64-bit numbers that follow from the seed alone."""
    return splitmix(splitmix(np.arange(n, dtype=np.uint64) + np.uint64(seed << 32)))


_BYTE = randoms(1, 256) * _WORD
_PLACES = 1 << 12
_PLACE = randoms(2, _PLACES) | np.uint64(1)
_GRAM = randoms(3, 64) | np.uint64(1)


@dataclass
class Words:
    """Words of several texts. `first[d]:first[d + 1]` are those of text d."""

    raw: np.ndarray  # bytes of all texts, lower case, a line feed after each text
    begin: np.ndarray  # of each text in raw, one more at the end
    start: np.ndarray  # of each word in raw
    end: np.ndarray
    first: np.ndarray
    doc: np.ndarray

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        place = np.arange(len(self.raw)) - np.repeat(
            np.concatenate([[0], self.start]), np.diff(np.concatenate([[0], self.start, [len(self.raw)]]))
        )
        value = _BYTE[self.raw] * _PLACE[place & (_PLACES - 1)]
        if place.max() >= _PLACES:
            value *= ((place // _PLACES) * 2 + 1).astype(np.uint64)
        return splitmix(np.add.reduceat(value, self.start))

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (not included) with single spaces."""
        return b" ".join(self.raw[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b]))

    def normal(self) -> list[bytes]:
        """Each text as its words, one space after each."""
        keep = _WORD[self.raw]
        keep[self.end] = True
        kept, spaces = np.where(_WORD[self.raw], self.raw, np.uint8(32)), np.cumsum(keep)
        bounds = np.concatenate([[0], spaces])[self.begin]
        flat = kept[keep].tobytes()
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they lie in one text."""
    n = max(0, len(hashes) - k + 1)
    value = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        value += hashes[j : j + n] * _GRAM[j]
    return splitmix(value), doc[:n] == doc[k - 1 :][:n]


def words(texts: list[str | None]) -> Words:
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    raw = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)])
    inside = np.concatenate([[False], _WORD[raw]]).view(np.int8)
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    first = np.searchsorted(start, begin)
    return Words(raw, begin, start, end, first, np.repeat(np.arange(len(parts)), np.diff(first)))


def chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of about that many characters; a longer text is a slice of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t or "") + 1
    if begin < len(texts):
        yield slice(begin, len(texts))
