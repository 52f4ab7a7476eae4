"""Packing of token ids into sequences, in order, by dynamic programming.

Documents are taken in the order of their ids, whatever kind the ids are of (null first; rows with one id by a hash of their
texts), and cut into ranges of about RANGE documents: a range begins where a hash of id and text says so, so that ranges follow
from the rows, however far apart ids lie, and a common id is cut too. In a range every DOCS successive documents (a block) are
packed together. Where the ranges begin is known to all tasks: a table of about MOST places at most, as larger tables
get longer ranges. Each document's ids, and END after them, follow one another.
A sequence is a window of at most LENGTH of them. Of all ways to cut the block, the one with the least
total cost is taken: the padding of each window to LENGTH (none at a power of two), OPENING for each window,
and a truncation penalty for each cut: none at the end of a document, SENTENCE at the end of a sentence, and MIDDLE
at every STEP ids inside a longer sentence. The best last cut comes from a queue of cuts whose costs
increase, so that a block takes time in proportion to its cuts. Blocks of over UNIT ids are cut in
units of whole documents (a longer document is a unit by itself), which bounds memory.

A null or empty text is the single id END. Rows that repeat are packed each, and an empty table gives no pieces. Only doc_id and
text are read, so other columns may have any name.
"""

import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.llm.tokens import encoder

LENGTH, END = 1024, 0
RANGE, MOST = 1024, 1 << 18
DOCS, UNIT = 512, 1 << 20
OPENING, SENTENCE, MIDDLE, STEP = 2, 2, 16, 64
_POWERS = [1 << k for k in range(LENGTH.bit_length() - 1)]


def best_cuts(places: list[int], penalties: list[int], length: int = LENGTH) -> list[int]:
    """Indexes of the chosen cuts, the last one included. places: increasing, from 0, at most `length` apart."""
    ends, starts = _unpadded(np.array(places), [p for p in _POWERS if p < length])
    ends.append(len(places))
    at = 0
    cost, back = [0] * len(places), [0] * len(places)
    queue: deque = deque([(0, 0, 0)])  # cost + place, place, index; first: the least in reach
    for j in range(1, len(places)):
        p = places[j]
        while queue[0][1] < p - length:
            queue.popleft()
        least, _, i = queue[0]
        least += length - p
        while ends[at] == j:
            k = starts[at]
            if cost[k] < least:
                least, i = cost[k], k
            at += 1
        cost[j] = least = least + penalties[j] + OPENING
        back[j] = i
        own = least + p
        while queue and queue[-1][0] >= own:
            queue.pop()
        queue.append((own, p, j))
    out, j = [], len(places) - 1
    while j > 0:
        out.append(j)
        j = back[j]
    return out[::-1]


def _unpadded(places: np.ndarray, powers: list[int]) -> tuple[list[int], list[int]]:
    """Index of the later and the earlier cut of each two that are a power apart, by the later one."""
    index = np.full(places[-1] + 1, -1)
    index[places] = np.arange(len(places))
    ends, starts = [], []
    for power in powers:
        later = np.arange(np.searchsorted(places, power), len(places))
        earlier = index[places[later] - power]
        ends.append(later[earlier >= 0])
        starts.append(earlier[earlier >= 0])
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    return ends[order].tolist(), starts[order].tolist()


def cuts(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the ids may be cut, from 0 to the last, and the penalty of each.

    ends, starts: whether an id can end, or follow, a sentence.
    """
    sentence = np.flatnonzero(ends[ids[:-1]] & starts[ids[1:]]) + 1
    places = np.union1d(np.concatenate([[0], sentence]), doc_ends)
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > STEP)
    if len(wide):
        inner = [np.arange(places[i] + STEP, places[i + 1], STEP) for i in wide]
        places = np.union1d(places, np.concatenate(inner))
    penalty = np.full(len(places), MIDDLE)
    penalty[np.searchsorted(places, sentence)] = SENTENCE
    penalty[np.searchsorted(places, doc_ends)] = 0
    return places, penalty


def sentence_tables(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Of each id of a byte-level vocabulary: whether it can end, and can follow, a sentence."""
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    ends = np.array([bool(n) and n[-1] in ".!?Ċ" for n in names])
    return ends, np.array([bool(n) and n[0] in "ĠĊ" or n[-1:] == "Ċ" for n in names])


def packed_unit(docs: list[tuple], ends: np.ndarray, starts: np.ndarray, first: int) -> Iterator[tuple]:
    """(number of the document, start, length, crc, its ids, sequence, offset) of each piece of a unit."""
    sizes = np.array([len(ids) for _, ids in docs])
    flat = np.concatenate([ids for _, ids in docs])
    doc_ends = np.cumsum(sizes)
    places, penalty = cuts(flat, doc_ends, ends, starts)
    chosen = places[best_cuts(places.tolist(), penalty.tolist())]
    edges = np.union1d(np.concatenate([[0], chosen]), doc_ends)
    doc = np.searchsorted(doc_ends, edges[:-1], side="right")
    sequence = np.searchsorted(chosen, edges[:-1], side="right")
    begin = np.concatenate([[0], chosen])[sequence]
    data = flat.astype("<u4")
    for a, b, d, s, o in zip(edges[:-1].tolist(), edges[1:].tolist(), doc.tolist(), sequence.tolist(), begin.tolist()):
        size = int(sizes[d])
        yield d, a - int(doc_ends[d]) + size, b - a, zlib.crc32(data[a:b].tobytes()), size, first + s, a - o


def _place(doc_id, value: int) -> tuple:
    return (False, 0, value) if doc_id is None else (True, doc_id, value)


def _range_of(hashed: DataFrame):
    """A function of doc_id and hash: the number of the range. hashed: doc_id, hash."""
    rate = min(1 / RANGE, MOST / max(1, hashed.count()))
    chosen = F.pmod(F.xxhash64("doc_id", "hash"), F.lit(1 << 40)) < int(rate * (1 << 40))
    begins = sorted(_place(r.doc_id, r.hash) for r in hashed.select("doc_id", "hash").where(chosen).distinct().collect())
    held = hashed.sparkSession.sparkContext.broadcast(begins)

    @F.arrow_udf(returnType=T.LongType())
    def number(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        places = map(_place, ids.to_pylist(), hashes.to_pylist())
        return pa.array([bisect_right(held.value, p) for p in places], pa.int64())

    return number


def packed(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of `docs` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    path: a byte-level vocabulary file of the `tokenizers` library.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    ordered = hashed.select(_range_of(hashed)("doc_id", "hash").alias("range"), "doc_id", "hash", "text").repartition("range")
    ordered = ordered.sortWithinPartitions("range", "doc_id", "hash").drop("hash")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaces=True)
        ends, starts = sentence_tables(encode.tokenizer)
        unit: list = []
        size, sequence, now = 0, 0, None
        id_type = None

        def flush():
            nonlocal size, sequence
            rows = list(packed_unit(unit, ends, starts, sequence))
            sequence = rows[-1][5] + 1
            columns = list(zip(*rows))
            names = [unit[d][0] for d in columns[0]]
            unit.clear()
            size = 0
            kinds = [id_type, *[pa.int64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([names, *columns[1:]], kinds)], _OUT)

        for batch in batches:
            id_type = batch.schema.field(1).type
            for a in range(0, batch.num_rows, 256):
                ranges, ids, texts = (c.to_pylist() for c in batch.slice(a, 256).columns)
                for at, doc_id, found in zip(ranges, ids, encode.encode(texts)):
                    if unit and (at != now or len(unit) == DOCS or size + len(found) >= UNIT):
                        yield flush()
                    if at != now:
                        now, sequence = at, at << 36
                    unit.append((doc_id, np.append(found, np.uint32(END))))
                    size += len(found) + 1
        if unit:
            yield flush()
        encode.clear()  # the process lives on in other tasks, and tasks of other jobs

    return ordered.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
