"""Fill-in-middle transformation of whole texts, assembled by a secondary sort.

A text is cut into units: white space (space, tab, line feed, vertical tab, form feed, carriage return) and the run of other
characters behind it; white space at the end of the text is a unit. h1 to h4, the first 32-bit groups of sha256 of
`<seed>:<doc_id>`, choose two borders between units and one of the forms `plain`, `spm` and `psm`.

Pieces of about CHUNK bytes of whole units (a longer unit is a piece) are keyed by their row and their place in the output, dealt
out by row and sorted by place within their partition (`repartition` and `sortWithinPartitions`: the DataFrame's
repartitionAndSortWithinPartitions, in the JVM, which spills). A task then streams them: a digest grows piece by piece, no
text is put together. For restoration each piece gets its place in the original from the output alone (a marker opens
a segment), is sorted again within its partition, and streams into a second digest. Texts are shuffled once.

A row's key is doc_id, a hash of the text and the input partition, so it does not depend on the order of rows, and
rows that repeat are one group: each place then comes as often as the row, and the group gives as many
equal results. A group is never larger than an input partition, whichever id or text is common.

Null text: as empty, which is `plain` with no units. Null doc_id: the hash of `<seed>:` alone. Very long texts: as all; memory
holds one text while it is cut, and one piece afterwards. Ties of the two borders: an empty middle. An empty
table gives no rows. Only doc_id and text are read, so other columns may have any name.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED, RATE, SPM = 42, 50, 80
CHUNK = 1 << 14
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}  # of a segment in the original
ROWS = 2048

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def unit_ends(raw: np.ndarray) -> np.ndarray:
    """Where the units of a text end. raw: its UTF-8 bytes."""
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    space = _SPACE[raw]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(raw))


def form_of(text: str, h3: int, h4: int, rate: int = RATE, spm: int = SPM) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return "plain"
    return "spm" if h4 % 100 < spm else "psm"


def plan(doc_id, text: str, seed: int = SEED) -> tuple[str, int, list[tuple[str, int, int]], np.ndarray, bytes]:
    """Form, number of units, (marker, begin, end) of each segment in the order of the output, ends of units, bytes."""
    raw = text.encode("utf-8", "replace")
    ends = unit_ends(np.frombuffer(raw, dtype=np.uint8))
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
    form = form_of(text, h3, h4)
    if form == "plain":
        return form, n, [("", 0, len(raw))], ends, raw
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    bounds = np.concatenate([[0], ends])
    p, q = int(bounds[a]), int(bounds[b])
    prefix, middle, suffix = (PREFIX, 0, p), (MIDDLE, p, q), (SUFFIX, q, len(raw))
    return form, n, [prefix, suffix, middle] if form == "psm" else [suffix, prefix, middle], ends, raw


def _chunks(ends: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Whole units from begin to end, about CHUNK bytes at a time."""
    while end - begin > CHUNK:
        i = int(np.searchsorted(ends, begin + CHUNK, side="right"))
        last = int(ends[i - 1]) if i else 0
        last = last if last > begin else int(ends[i])
        yield begin, last
        begin = last
    yield begin, end


def _characters(raw: bytes, begin: int, end: int) -> int:
    part = np.frombuffer(raw, dtype=np.uint8, offset=begin, count=end - begin)
    return int((part & 0xC0 != 0x80).sum())


_KEY = ["doc_id", "hash", "part"]
_FACTS = ["n", "form", "prefix_chars", "middle_chars"]
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
_FACT_DDL = "n long, form string, prefix_chars long, middle_chars long"


def pieces(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Pieces of the output: key and facts of the row, place (from 0, in the order of the output), piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("part"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [c.to_pylist() for c in batch.columns[:3]]
            rows: list[tuple] = []
            size = 0
            for i, text in enumerate(batch.column(3)):
                form, n, segments, ends, raw = plan(key[0][i], text.as_py() or "", seed)
                counts = (None, None)
                if form != "plain":
                    spans = {m: (a, b) for m, a, b in segments}
                    counts = _characters(raw, *spans[PREFIX]), _characters(raw, *spans[MIDDLE])
                place = 0
                for marker, a, b in segments:
                    for a, b in _chunks(ends, a, b):
                        piece = marker.encode() + raw[a:b]
                        marker = ""
                        rows.append((key[0][i], key[1][i], key[2][i], n, form, *counts, place, piece))
                        place += 1
                        size += b - a
                        if len(rows) >= ROWS or size > 1 << 22:
                            yield _batch(rows, batch.schema.field(0).type)
                            size = 0
            if rows:
                yield _batch(rows, batch.schema.field(0).type)

    return keyed.mapInArrow(run, f"doc_id {kind}, hash long, part int, {_FACT_DDL}, place long, piece binary")


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.int32(), *_KINDS, pa.int64(), pa.binary()]
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*_KEY, *_FACTS, "place", "piece"])
    rows.clear()
    return out


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, facts, place, piece, how often) of sorted pieces: equal keys and places come once."""
    now, times = None, 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        for row, piece in zip(zip(*columns), batch.column(batch.num_columns - 1)):
            if now and row == now[0]:
                times += 1
                continue
            if now:
                yield now[0][:3], now[0][3:7], now[0][7], now[1], times
            now, times = (row, piece.as_py()), 1
    if now:
        yield now[0][:3], now[0][3:7], now[0][7], now[1], times


LAST = 1 << 62


def _outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their place in the original, without markers; one more per row, the last, with the digest of the output."""
    rows: list[tuple] = []
    size, key, digest, segment, tail = 0, None, None, 0, None

    def closed() -> list[tuple]:
        return [(*key, *tail[0], LAST, digest.digest())] * tail[1] if key else []

    id_type = None

    def typed(source):
        nonlocal id_type
        for batch in source:
            id_type = batch.schema.field(0).type
            yield batch

    for at, facts, place, piece, times in _streamed(typed(batches)):
        if at != key:
            rows += closed()
            key, digest, segment, tail = at, hashlib.sha256(), 0, (facts, times)
        digest.update(piece)
        if facts[1] != "plain" and piece[:3].decode("utf-8", "replace") in PLACE:
            segment = PLACE[piece[:3].decode()]
            piece = piece[3:]
        rows += [(*at, *facts, segment << 40 | place, piece)] * times
        size += len(piece) * times
        if len(rows) >= ROWS or size > 1 << 22:
            yield _batch(rows, id_type)
            size = 0
    rows += closed()
    if rows:
        yield _batch(rows, id_type)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    key, digest, id_type = None, None, None

    def typed(source):
        nonlocal id_type
        for batch in source:
            id_type = batch.schema.field(0).type
            yield batch

    def out():
        kinds = [id_type, *_KINDS, pa.string(), pa.string()]
        names = ["doc_id", *_FACTS, "output_sha256", "restored_sha256"]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        rows.clear()
        return made

    for at, facts, place, piece, times in _streamed(typed(batches)):
        if at != key:
            key, digest = at, hashlib.sha256()
        if place < LAST:
            digest.update(piece)
            continue
        rows += [(at[0], *facts, piece.hex(), digest.hexdigest())] * times
        if len(rows) >= ROWS:
            yield out()
    if rows:
        yield out()


def transformed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, and digests of the output and of the text rebuilt from it."""
    made = pieces(docs, seed)
    schema = made.schema
    ordered = made.repartition(*_KEY).sortWithinPartitions(*_KEY, "place")
    back = ordered.mapInArrow(_outputs, schema).sortWithinPartitions(*_KEY, "place")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return back.mapInArrow(_restored, f"doc_id {kind}, {_FACT_DDL}, output_sha256 string, restored_sha256 string")


def outputs(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, form, place and text of the output's pieces, sorted within partitions: what a writer of training text streams."""
    ordered = pieces(docs, seed).repartition(*_KEY).sortWithinPartitions(*_KEY, "place")
    return ordered.select("doc_id", "form", "place", F.col("piece").cast("string").alias("text"))
