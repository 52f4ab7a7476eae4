"""Byte-level BPE encoding and decoding, with a segment tree over the ranks of adjacent pairs.

A text is cut into words by the byte-level pattern, a word into its bytes. The leaves of a word's segment tree are its
adjacent pairs, each with (rank of its merge, place) or nothing; an inner node holds the lesser of its two
children, so that the root is the leftmost pair of the lowest rank. A merge changes three leaves (the pair itself, the one
before it and the one after it), each with one path to the root, and the next merge is at the root again, until no pair is
left there: n log n steps for n bytes. The trees of many words are the rows of one array and
are updated together; a long word has a tree of its own. A task merges each distinct word once while it is in
a table of at most WORDS words.

`encoded` and `decoded` work on any DataFrame; they shuffle nothing. The vocabulary file is read by the driver and
sent to the executors (its size is that of the vocabulary). Only vocabularies of this kind are taken: no normaliser, the
byte-level pattern, merges by rank, added tokens that match exactly.

Null and empty texts have no ids and decode to an empty text. Long texts are cut between words, a million characters
at a time; a single word of any length is merged as a whole. Repeated rows, and ties between ids, are encoded each. Strings
of special tokens in a text become their id, as in the library's own defaults. An empty table gives no rows. All
columns but `text` are kept, whatever their names; only `ids` (encoding) and `text` (decoding) are replaced.
"""

import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txguard.llm.text import chunks

WORDS = 400_000
PART = 1_000_000  # characters of a text at a time
ROWS = 1 << 20  # leaves of trees at a time
SHORT = 64  # bytes of words whose trees always share an array
NONE = np.int64(1) << 62

# The pattern of byte-level vocabularies, white space as it understands it, and the letters and numbers of
# `regex` that are younger than Unicode 16, which the library's pattern does not know as such.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^SPACE\p{L}\p{N}]+|[SPACE]+(?![^SPACE])|[SPACE]+"
).replace("SPACE", SPACE)
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
_newer = "".join("-".join(f"\\U{x:0>8}" for x in span.split("-")) for span in NEWER.split())
# The pattern once more for texts without characters from U+0250 on, whose letters and numbers are few ranges.
_LETTERS, _NUMBERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_words_of_latin = re.compile(PATTERN.replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS)).findall
_has_others = re.compile("[\u0250-\U0010ffff]").search
_has_newer = re.compile(f"[{_newer}]").search
_words_of = regex.compile(PATTERN).findall
_words_of_newer = regex.compile(
    PATTERN.replace(r"[\p{L}]", rf"[\p{{L}}--[{_newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{_newer}]]")
    .replace(r"\p{L}\p{N}]", rf"[[\p{{L}}\p{{N}}]--[{_newer}]]]"), regex.V1
).findall


def words_of(text: str) -> list[str]:
    if text.isascii() or not _has_others(text):
        return _words_of_latin(text)
    return (_words_of_newer if _has_newer(text) else _words_of)(text)


_border = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])")
_open: dict = {}


def byte_names() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Codec:
    """A vocabulary with its merges. source: the text of a vocabulary file."""

    def __init__(self, source: str):
        held = json.loads(source)
        model = held["model"]
        if held.get("normalizer") or model.get("ignore_merges") or (held.get("pre_tokenizer") or {}).get("add_prefix_space"):
            raise ValueError("not a plain byte-level vocabulary")
        vocabulary = model["vocab"]
        added = held.get("added_tokens") or []
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens must match exactly")
        self.special = {a["content"]: a["id"] for a in added}
        names = byte_names()
        self.byte_id = np.array([vocabulary[n] for n in names], dtype=np.int64)

        value = {n: b for b, n in enumerate(names)}
        texts = {i: n for n, i in vocabulary.items()} | {i: n for n, i in self.special.items()}
        self.top = max(texts) + 1
        pieces = [
            bytes(value[c] for c in texts[i]) if all(c in value for c in texts.get(i, "")) else texts[i].encode()
            if i in texts else b"" for i in range(self.top)
        ]
        self.token_size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.token_begin = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        keys = np.array([vocabulary[a] * self.top + vocabulary[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = np.append(keys[order], NONE), np.append(order, NONE)
        self.rank_of = dict(zip(keys[::-1].tolist(), range(len(keys) - 1, -1, -1)))
        self._clear()

    def _clear(self) -> None:
        self.number: dict = {}
        self.flat = np.zeros(1 << 16, dtype="<u4")
        self.begin, self.size, self.filled = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.top + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge_together(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one behind the other, and how many each has. symbols: a row of ids per word, as wide as a power of two;
        sizes: how many of them."""
        n, width = symbols.shape
        if width == 1:
            return symbols.reshape(-1), sizes
        levels = width.bit_length() - 1
        place = np.arange(width)
        tree = np.full((n, 2 * width), NONE)
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        real = (place[None, :-1] < sizes[:, None] - 1) & (ranks < NONE)
        tree[:, width : 2 * width - 1] = np.where(real, (ranks << levels) | place[:-1], NONE)
        for k in range(levels - 1, -1, -1):
            w = 1 << k
            tree[:, w : 2 * w] = tree[:, 2 * w : 4 * w].reshape(n, w, 2).min(axis=2)
        tree, sym = tree.reshape(-1), symbols.astype(np.int64).reshape(-1)
        after = np.tile(place + 1, n)
        before = np.tile(np.arange(-1, width), n)  # one more place a row, behind the last symbol
        alive = (place[None, :] < sizes[:, None]).reshape(-1)
        rows = np.flatnonzero(tree[1 :: 2 * width] < NONE)
        while len(rows):
            root = tree[rows * 2 * width + 1]
            i = root & (width - 1)
            s, b = rows * width, rows * (width + 1)
            j = after[s + i]
            k = after[s + j]
            sym[s + i] = self.merged[root >> levels]
            after[s + i] = k
            before[b + k] = i
            alive[s + j] = False
            h = before[b + i]
            inside = k < sizes[rows]
            follows = np.where(inside, self._ranks(sym[s + i], sym[s + np.minimum(k, width - 1)]), NONE)
            first = h < 0
            h = np.where(first, 0, h)
            leads = np.where(first, NONE, self._ranks(sym[s + h], sym[s + i]))
            t = rows * 2 * width
            tree[t + width + j] = NONE
            tree[t + width + i] = np.where(follows < NONE, (follows << levels) | i, NONE)
            some = ~first
            tree[(t + width + h)[some]] = np.where(leads < NONE, (leads << levels) | h, NONE)[some]
            t3 = np.concatenate([t, t, t])
            p = np.concatenate([i, j, np.where(first, i, h)]) + width
            for _ in range(levels):
                p >>= 1
                c = t3 + 2 * p
                tree[t3 + p] = np.minimum(tree[c], tree[c + 1])
            rows = rows[tree[t + 1] < NONE]
        kept = np.add.reduceat(alive.astype(np.int64), np.arange(0, n * width, width))
        return sym[alive], kept

    def merge_one(self, symbols: list[int]) -> list[int]:
        """Ids of one word, of any length, by a tree of its own."""
        n = len(symbols)
        width = 1 << (n - 1).bit_length()
        sym, none, rank_of, top = list(symbols), int(NONE), self.rank_of, self.top
        tree = [none] * (2 * width)

        def key(i: int, k: int) -> int:
            rank = rank_of.get(sym[i] * top + sym[k])
            return none if rank is None else rank * width + i

        for i in range(n - 1):
            tree[width + i] = key(i, i + 1)
        for p in range(width - 1, 0, -1):
            tree[p] = min(tree[2 * p], tree[2 * p + 1])

        def put(i: int, value: int) -> None:
            p = width + i
            tree[p] = value
            while p > 1:
                p >>= 1
                a, b = tree[2 * p], tree[2 * p + 1]
                least = a if a < b else b
                if tree[p] == least:
                    break
                tree[p] = least

        after, before = list(range(1, n + 1)), list(range(-1, n))
        while tree[1] != none:
            rank, i = divmod(tree[1], width)
            j = after[i]
            k = after[j]
            sym[i] = int(self.merged[rank])
            after[i] = k
            before[k] = i
            put(j, none)
            put(i, key(i, k) if k < n else none)
            if before[i] >= 0:
                put(before[i], key(before[i], i))
        out, i = [], 0
        while i < n:
            out.append(sym[i])
            i = after[i]
        return out

    def merged_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words in another order, how many ids each has, and the ids of all in that order."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        widths = np.left_shift(1, np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        order = np.argsort(widths, kind="stable")
        borders = np.flatnonzero(np.diff(widths[order])) + 1
        counts, ids = [], []
        for members in np.split(order, borders) if len(words) else ():
            width = int(widths[members[0]])
            if width > SHORT and len(members) < 32:
                for i in members.tolist():
                    found = self.merge_one(self.byte_id[np.frombuffer(words[i], dtype=np.uint8)].tolist())
                    counts.append([len(found)])
                    ids.append(found)
                continue
            step = max(1, ROWS // width)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                raw = b"".join([words[i].ljust(width, b"\0") for i in part.tolist()])
                symbols = self.byte_id[np.frombuffer(raw, dtype=np.uint8)].reshape(-1, width)
                found, kept = self.merge_together(symbols, lengths[part])
                counts.append(kept)
                ids.append(found)
        none = np.zeros(0, dtype=np.int64)
        return order, np.concatenate([none, *counts]).astype(np.int64), np.concatenate([none, *ids]).astype("<u4")

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        order, counts, ids = self.merged_words(words)
        out: list = [None] * len(words)
        for i, found in zip(order.tolist(), np.split(ids, np.cumsum(counts)[:-1])):
            out[i] = found
        return out

    def _add(self, new: list[str]) -> None:
        order, sizes, ids = self.merged_words([w.encode("utf-8", "replace") for w in new])
        first, n, end = len(self.number), len(new), self.filled + len(ids)
        while len(self.flat) < end:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.size) < first + n:
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.filled : end] = ids
        self.size[first + order] = sizes
        self.begin[first + order] = self.filled + np.cumsum(sizes) - sizes
        self.filled = end
        self.number.update(zip(new, range(first, first + n)))

    def _segments(self, text: str) -> Iterator[str | int]:
        """The parts of a text that words do not span, and ids of special tokens."""
        if any(s in text for s in self.special):
            found = re.finditer("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))), text)
            found = [(m.start(), m[0]) for m in found] + [(len(text), "")]
        else:
            found = [(len(text), "")]
        begin = 0
        for at, special in found:
            while at - begin > PART:
                cut = _border.search(text, begin + PART, at)
                if not cut:
                    break
                yield text[begin : cut.start()]
                begin = cut.start()
            if at > begin:
                yield text[begin:at]
            if special:
                yield self.special[special]
            begin = at + len(special)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Little-endian uint32 ids of each text."""
        out: list[list] = [[] for _ in texts]
        words: list[str] = []
        ends: list[tuple[int, int]] = []

        def flush() -> None:
            if len(self.number) > WORDS:
                self._clear()
            which = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            unseen = np.flatnonzero(which < 0).tolist()
            if unseen:
                self._add(list(dict.fromkeys(words[i] for i in unseen)))
                which[unseen] = [self.number[words[i]] for i in unseen]
            sizes = self.size[which]
            total = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.flat[np.repeat(self.begin[which] - total[:-1], sizes) + np.arange(total[-1])]
            begin = 0
            for text, end in ends:
                out[text].append(ids[total[begin] : total[end]])
                begin = end
            words.clear()
            ends.clear()

        for i, text in enumerate(texts):
            for part in self._segments(text or ""):
                if isinstance(part, int):
                    flush()
                    out[i].append(np.array([part], dtype="<u4"))
                    continue
                words += words_of(part)
                ends.append((i, len(words)))
                if len(words) > PART:
                    flush()
        flush()
        none = np.zeros(0, dtype="<u4")
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else none for parts in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; those that are not in the vocabulary are left out, broken UTF-8 is replaced."""
        out = []
        rest = np.zeros(0, dtype=np.uint8)
        ids = ids[ids < self.top].astype(np.int64)
        for a in range(0, len(ids), PART):
            part = ids[a : a + PART]
            sizes = self.token_size[part]
            total = np.cumsum(sizes)
            at = np.repeat(self.token_begin[part] - total + sizes, sizes) + np.arange(total[-1])
            out.append(self.token_bytes[at])
        return np.concatenate(out or [rest]).tobytes().decode("utf-8", "replace")


def _codec(source: str) -> Codec:
    """The codec of this Python process, built once; that of another vocabulary goes."""
    if source not in _open:
        _open.clear()
        _open[source] = Codec(source)
    return _open[source]


def _held(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as file:
        source = file.read()
    Codec(source)  # what cannot be used fails here
    return spark.sparkContext.broadcast(source)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """All columns of `docs` but `text`, and `ids`: the ids of the whole text, little-endian, 4 bytes each."""
    source = _held(docs.sparkSession, path)
    kept = [f for f in docs.drop("ids", "text").schema.fields]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            for part in chunks(texts):
                ids = [x.tobytes() for x in codec.encode(texts[part])]
                columns = [batch.column(i).slice(part.start, len(ids)) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], [*names, "ids"])

    return docs.select(*[f"`{n}`" for n in names], "text").mapInArrow(
        run, T.StructType([*kept, T.StructField("ids", T.BinaryType())])
    )


def decoded(found: DataFrame, path: str) -> DataFrame:
    """All columns of `found`, as `encoded` gives them, and `text`. Null ids are an empty text."""
    source = _held(found.sparkSession, path)
    kept = [f for f in found.drop("ids", "text").schema.fields]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            ids = batch.column(len(names))
            for a in range(0, batch.num_rows, 256):
                part = ids.slice(a, 256)
                texts = [codec.decode(np.frombuffer(x.as_buffer() or b"" if x.is_valid else b"", dtype="<u4")) for x in part]
                columns = [batch.column(i).slice(a, 256) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, part, pa.array(texts, pa.string())], [*names, "ids", "text"])

    return found.select(*[f"`{n}`" for n in names], "ids").mapInArrow(
        run, T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())])
    )
