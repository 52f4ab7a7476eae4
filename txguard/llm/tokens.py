"""Token ids of whole texts, by the `tokenizers` library, one piece between white space at a time.

No token of the two supported kinds spans the border between a character that is not white space and
one that is, nor between letters and the `.`, `,`, `!` or `?` that ends a piece, so a text's ids are those of its
pieces in turn. A task encodes each distinct piece once while it
is in a table of about PIECES of them, whose keys are the pieces' bytes; where the vocabulary lower-cases, they are in lower
case. Texts with zeros or rarer kinds of white space, on which the libraries' notions differ, are encoded
whole. Strings of special tokens in a text are ordinary text.
"""

import os
import re

import numpy as np

from txguard.llm.text import splitmix

PIECES = 1_600_000
_PLAIN_TEXT = re.compile("[^\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏ -  　﻿\ud800-\udfff]*")
_UPPER = "".join(map(chr, [*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]))
_WORD_END = "</w>"
_SPACES = " \t\n\r"  # all that plain texts have
_ODD = bytes([0, 11, 12, 28, 29, 30, 31])
#: Of a byte: 0 white space or the end of a text, 1 letter, 2 one of `.,!?`, 3 all else.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[0, *_SPACES.encode()]] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[list(b".,!?")] = 2
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # of the first n bytes of eight
_open: dict = {}


class Encoder:
    """`spaces`: white space before a piece belongs to it (byte-level kind); else it is dropped (word kind)."""

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes = np.array([len(n) for n in names], dtype=np.int64)
        self.last = np.array([n.endswith(_WORD_END) for n in names])
        self.spaces, normal = spaces, self.tokenizer.normalizer
        self.lower = not spaces and normal is not None and normal.normalize_str(_UPPER) == _UPPER.lower()
        self.clear()

    def clear(self) -> None:
        """Forgets all pieces."""
        self.number, self.long = Table(), {}
        self.flat, self.filled, self.known = np.zeros(1 << 16, dtype=np.uint32), 0, 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one behind the other, and how many each has."""
        ids = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64)

    def _in_a_row(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that begin with white space and end without: they may follow one another."""
        ids = self._ids("".join(pieces))  # an id stands for as many bytes as its name has characters
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, pieces)), dtype=np.int64, count=len(pieces)))
        place = np.cumsum(self.bytes[ids]) - self.bytes[ids]
        return ids, np.bincount(np.searchsorted(ends, place, side="right"), minlength=len(pieces))

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces of letters: each is one word at least, whose last id says so in its name."""
        ids = self._ids(" ".join(pieces))
        ends = np.flatnonzero(self.last[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(pieces) else self._spaced(pieces)

    def _spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that have a space between them."""
        one = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1)
        place = np.fromiter((a for a, _ in one.offsets), dtype=np.int64, count=len(one.ids))
        return np.array(one.ids, dtype=np.uint32), np.bincount(np.searchsorted(ends, place, side="right"), minlength=len(pieces))

    def _add(self, new: list[str]) -> np.ndarray:
        """The numbers of new pieces, whose ids are kept."""
        if self.spaces:
            kinds, other = (self._in_a_row, self._alone), [p[0] not in _SPACES or p[-1] in _SPACES for p in new]
        else:
            kinds, other = (self._words, self._spaced), [not p.isalpha() for p in new]
        number = np.argsort(np.argsort(other, kind="stable")) + self.known
        parts = [[p for p, x in zip(new, other) if x == kind] for kind in (False, True)]
        ids, sizes = (np.concatenate(x) for x in zip(*(f(part) for f, part in zip(kinds, parts) if part)))
        n, end = self.known + len(new), self.filled + len(ids)
        while len(self.flat) < end:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.size) < n:
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.filled : end] = ids
        self.size[self.known : n] = sizes
        self.begin[self.known : n] = self.filled + np.cumsum(sizes) - sizes
        self.known, self.filled = n, end
        return number

    def _numbers(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each piece; new ones get one."""
        low, high = keys(raw, begin, end)
        which = self.number.find(low, high)
        data = raw.tobytes()
        longer = np.flatnonzero(end - begin > 16)
        long = [data[a:b] for a, b in zip(begin[longer].tolist(), end[longer].tolist())]
        which[longer] = [self.long.get(p, -1) for p in long]
        unseen = np.flatnonzero(which < 0)
        if len(unseen):
            place = dict(zip((data[a:b] for a, b in zip(begin[unseen].tolist(), end[unseen].tolist())), unseen.tolist()))
            new, place = list(place), np.fromiter(place.values(), np.int64, len(place))
            for a in range(0, len(new), 5000):
                at, some = place[a : a + 5000], new[a : a + 5000]
                number = self._add([p.decode() for p in some])
                short = end[at] - begin[at] <= 16
                self.number.add(low[at[short]], high[at[short]], number[short])
                self.long.update((some[i], int(number[i])) for i in np.flatnonzero(~short).tolist())
            which[unseen] = self.number.find(low[unseen], high[unseen])
            which[longer] = [self.long[p] for p in long]
        return which

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text; a null text has none."""
        out: list = [None] * len(texts)
        plain = []
        if self.known > PIECES:
            self.clear()
        for i, t in enumerate(texts):
            data = _plain(t or "")
            if data is None:
                out[i] = self._ids(t.encode("utf-8", "replace").decode("utf-8"))
                data = b""
            plain.append(data)
        raw = np.frombuffer(b"\0".join([b"", *plain, bytes(16)]), dtype=np.uint8)
        first = np.cumsum([1] + [len(p) + 1 for p in plain])  # place of each text, one more at the end
        if self.lower:
            raw = _lower(raw)
        begin, end = pieces(raw, self.spaces)
        which = self._numbers(raw, begin, end)
        sizes = self.size[which]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.begin[which] - total[:-1], sizes) + np.arange(total[-1])]
        edge = total[np.searchsorted(begin, first)].tolist()
        return [ids[a:b] if own is None else own for own, a, b in zip(out, edge, edge[1:])]


def _plain(text: str) -> bytes | None:
    """UTF-8 of a text whose white space is of the usual kinds; else None."""
    if not text.isascii() and not _PLAIN_TEXT.fullmatch(text):
        return None
    data = text.encode()
    return data if len(data.translate(None, _ODD)) == len(data) else None


def _lower(raw: np.ndarray) -> np.ndarray:
    """A-Z and the letters from U+00C0 to U+00DE in lower case, but where a character from U+0100 on follows: a mark may join them."""
    after = raw[1:] < 0xC4
    out = raw.copy()
    out[:-1] += np.where((raw[:-1] - np.uint8(65) < 26) & after, np.uint8(32), np.uint8(0))
    lead = np.flatnonzero(raw == 0xC3)
    upper = (raw[lead + 1] < 0x9F) & (raw[lead + 1] != 0x97) & after[lead + 1]
    out[lead[upper] + 1] += 32
    return out


def pieces(raw: np.ndarray, spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of texts begin and end. raw: UTF-8 with a zero before and after each text.

    What stands between white space is a piece, but letters before one of `.,!?` are a piece without the rest.
    """
    kind = _KIND[raw]
    lead = np.flatnonzero(raw == 0xC3)
    kind[lead] = kind[lead + 1] = np.where((raw[lead + 1] | 0x20) == 0xB7, 3, 1)
    inside = kind > 0
    begins, ends = np.zeros(len(raw), dtype=bool), np.zeros(len(raw), dtype=bool)
    begins[1:], ends[1:] = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    split = np.flatnonzero((kind[1:] == 2) & (kind[:-1] == 1)) + 1
    other = np.flatnonzero(kind != 1)
    split = split[kind[other[np.searchsorted(other, split) - 1]] == 0]
    begins[split] = ends[split] = True
    if not spaces:
        return np.flatnonzero(begins), np.flatnonzero(ends)
    end = np.flatnonzero(ends | (raw == 0))[1:]
    begin = np.concatenate([[1], end[:-1] + (raw[end[:-1]] == 0)])
    real = begin < end
    return begin[real], end[real]


def keys(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each piece as two numbers. raw: has no zero in a piece and 16 more bytes at the end."""
    eight = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=1)
    size = end - begin
    return eight[begin] & _MASK[np.minimum(size, 8)], eight[begin + 8] & _MASK[np.clip(size - 8, 0, 8)]


class Table:
    """The numbers of pieces of up to 16 bytes, by their `keys`: open addressing in arrays, many pieces at once."""

    def __init__(self):
        self.slots = np.full(1 << 16, -1, dtype=np.int32)
        self.low, self.high = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, np.uint64)
        self.used = 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = splitmix(low ^ high * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
        return x.astype(np.int64) & (len(self.slots) - 1)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """-1 for a piece that is not there."""
        slot = self._slot(low, high)
        number = self.slots[slot]
        wrong = np.flatnonzero((number >= 0) & ((self.low[number] != low) | (self.high[number] != high)))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (len(self.slots) - 1)
            number[wrong] = n = self.slots[slot[wrong]]
            wrong = wrong[(n >= 0) & ((self.low[n] != low[wrong]) | (self.high[n] != high[wrong]))]
        return number

    def add(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> None:
        """Pieces that are not there yet."""
        if not len(number):
            return
        while len(self.low) <= number.max():
            self.low, self.high = (np.concatenate([x, np.zeros_like(x)]) for x in (self.low, self.high))
        self.low[number], self.high[number] = low, high
        self.used += len(number)
        if 2 * self.used > len(self.slots):
            number = np.concatenate([self.slots[self.slots >= 0], number])
            size = len(self.slots)
            while 2 * self.used > size:
                size *= 2
            self.slots = np.full(size, -1, dtype=np.int32)
        slot = self._slot(self.low[number], self.high[number])
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]  # of several in one slot the last stays
            left = self.slots[slot] != number
            number, slot = number[left], (slot[left] + 1) & (len(self.slots) - 1)


def encoder(path: str, spaces: bool) -> Encoder:
    """The encoder of this Python process, read once."""
    if (path, spaces) not in _open:
        _open[path, spaces] = Encoder(path, spaces)
    return _open[path, spaces]
