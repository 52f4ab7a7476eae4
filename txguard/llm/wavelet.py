"""Token ids of documents in compressed files of wavelet matrices.

`write_shards` encodes documents in ascending order of their ids (null first, rows with one id by a hash of the
text), END after each, and stores shards of about SHARD ids: each a wavelet matrix that answers access, counting
and occurrence lookup by rank and select. A shard is one row (part, number, n_tokens, doc_ids, matrix) of a
Parquet data set, so that Spark commits files and retries lost tasks; `matrix` is the byte layout of `build`.

Over written shards, `count_tokens`, `find_tokens` and `read_tokens` count ids, find their occurrences and read a range of ids,
by rank, select and access in each shard; `read_documents` reads all, and counts END in each document by rank.

Null and empty texts are the single id END. A longer document than SHARD is a shard by itself. Rows that repeat are stored
each. An empty table gives no shards and no rows. Only doc_id and text are read, so other columns may have any name.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txguard.llm.tokens import encoder

END, SHARD = 1, 1 << 20
MAGIC = b"TXWM0001"
CHUNK = 1 << 16  # bytes of a plane that are compressed together
BLOCK = 64  # bytes of a plane between counts of ones
_HEAD = struct.Struct("<8sQIQ")


def build(tokens: np.ndarray, sizes: np.ndarray) -> bytes:
    """Layout, all numbers little-endian: magic, number of ids (8 bytes), of planes (4), of documents (8); length (8)
    and zstd frame of the documents' sizes (4 bytes each); per plane, highest bit first: number of zeros (8), length (8)
    and zstd frame of the ones before each BLOCK (4 bytes each), then length (4) and zstd frame per CHUNK.

    A plane has a bit per id; ids are stably parted by it, zeros first, before the next plane.
    """
    pack = zstandard.ZstdCompressor(level=1).compress
    n = len(tokens)
    planes = max(1, int(tokens.max()).bit_length()) if n else 1
    out = [_HEAD.pack(MAGIC, n, planes, len(sizes))]
    frame = pack(np.asarray(sizes, dtype="<u4").tobytes())
    out += [struct.pack("<Q", len(frame)), frame]
    now = tokens.astype(np.uint16 if planes <= 16 else np.uint32)
    for k in range(planes - 1, -1, -1):
        one = (now >> k & 1).astype(bool)
        raw = np.packbits(one, bitorder="little")
        padded = np.zeros(-(-len(raw) // BLOCK) * BLOCK, dtype=np.uint8)
        padded[: len(raw)] = raw
        ones = np.bitwise_count(padded.reshape(-1, BLOCK)).sum(axis=1, dtype=np.int64)
        before = pack((np.cumsum(ones) - ones).astype("<u4").tobytes())
        zeros = now[~one]
        out += [struct.pack("<QQ", len(zeros), len(before)), before]
        for a in range(0, len(raw), CHUNK):
            frame = pack(raw[a : a + CHUNK].tobytes())
            out += [struct.pack("<I", len(frame)), frame]
        now = np.concatenate([zeros, now[one]])
    return b"".join(out)


class WaveletMatrix:
    """Reads what `build` made; planes are decompressed a chunk at a time, as far as a question needs them."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.n, self.planes, n_docs = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        self._unpack = zstandard.ZstdDecompressor().decompress
        at = _HEAD.size
        sizes, at = self._frame(at, "<Q")
        self.sizes = np.frombuffer(self._unpack(sizes), dtype="<u4").astype(np.int64) if n_docs else np.zeros(0, np.int64)
        self.zeros, self._before, self._chunks, self._open = [], [], [], {}
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", data, at)[0])
            before, at = self._frame(at + 8, "<Q")
            self._before.append(before)
            chunks = []
            for _ in range(-(-(-(-self.n // 8)) // CHUNK)):
                frame, at = self._frame(at, "<I")
                chunks.append(frame)
            self._chunks.append(chunks)

    def _frame(self, at: int, kind: str) -> tuple[memoryview, int]:
        size = struct.unpack_from(kind, self.data, at)[0]
        at += struct.calcsize(kind)
        return self.data[at : at + size], at + size

    def _part(self, plane: int, chunk: int) -> np.ndarray:
        key = (plane, chunk)
        if key not in self._open:
            self._open[key] = np.frombuffer(self._unpack(self._chunks[plane][chunk]), dtype=np.uint8)
        return self._open[key]

    def _bit(self, plane: int, i: int) -> int:
        byte = i >> 3
        return int(self._part(plane, byte // CHUNK)[byte % CHUNK]) >> (i & 7) & 1

    def rank(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        key = (plane, "before")
        if key not in self._open:
            self._open[key] = np.frombuffer(self._unpack(self._before[plane]), dtype="<u4")
        block = i // (8 * BLOCK)
        if block >= len(self._open[key]):
            return self.n - self.zeros[plane]
        first = block * BLOCK
        byte = i >> 3
        part = self._part(plane, first // CHUNK)[first % CHUNK : first % CHUNK + byte - first + 1]
        whole = int(np.bitwise_count(part[: byte - first]).sum())
        rest = int(part[byte - first]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(self._open[key][block]) + whole + rest.bit_count()

    def select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that value in a plane."""
        low, high = 0, self.n
        while high - low > 1:
            middle = (low + high) // 2
            seen = self.rank(plane, middle)
            if (seen if bit else middle - seen) <= k:
                low = middle
            else:
                high = middle
        return low

    def access(self, i: int) -> int:
        """The i-th id."""
        value = 0
        for p in range(self.planes):
            bit = self._bit(p, i)
            ones = self.rank(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        """Where the occurrences of an id among ids a to b lie below the last plane."""
        if token >> self.planes or b <= a:
            return 0, 0
        for p in range(self.planes):
            ra, rb = self.rank(p, a), self.rank(p, b)
            if token >> (self.planes - 1 - p) & 1:
                a, b = self.zeros[p] + ra, self.zeros[p] + rb
            else:
                a, b = a - ra, b - rb
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """How often an id occurs among ids a to b (not included)."""
        low, high = self._range(token, a, self.n if b is None else b)
        return high - low

    def occurrence(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for p in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - p) & 1
            i = self.select(p, bit, i - self.zeros[p] if bit else i)
        return i

    def _whole(self, plane: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a plane, one more at the end, and the ones before each byte."""
        key = (plane, "whole")
        if key not in self._open:
            parts = [self._part(plane, c) for c in range(len(self._chunks[plane]))]
            raw = np.concatenate([*parts, np.zeros(1, dtype=np.uint8)])
            ones = np.bitwise_count(raw).astype(np.int64)
            self._open[key] = raw, np.cumsum(ones) - ones
        return self._open[key]

    def ranks(self, plane: int, places: np.ndarray) -> np.ndarray:
        """`rank` of many places at once."""
        raw, before = self._whole(plane)
        byte = places >> 3
        mask = (np.left_shift(1, places & 7) - 1).astype(np.uint8)
        return before[byte] + np.bitwise_count(raw[byte] & mask)

    def accesses(self, places: np.ndarray) -> np.ndarray:
        """`access` of many places at once."""
        value = np.zeros(len(places), dtype=np.uint32)
        for p in range(self.planes):
            bit = self._whole(p)[0][places >> 3] >> (places & 7).astype(np.uint8) & 1
            ones = self.ranks(p, places)
            places = np.where(bit == 1, self.zeros[p] + ones, places - ones)
            value = value << np.uint32(1) | bit
        return value

    def counts(self, token: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`count` of an id in many ranges at once."""
        if token >> self.planes:
            return np.zeros(len(a), dtype=np.int64)
        for p in range(self.planes):
            ra, rb = self.ranks(p, a), self.ranks(p, b)
            if token >> (self.planes - 1 - p) & 1:
                a, b = self.zeros[p] + ra, self.zeros[p] + rb
            else:
                a, b = a - ra, b - rb
        return b - a

    def occurrences(self, token: int) -> np.ndarray:
        """Places of all occurrences of an id, ascending: the select of each, a plane at a time."""
        low, high = self._range(token, 0, self.n)
        places = np.arange(low, high)
        for p in range(self.planes - 1, -1, -1):
            if not len(places):
                break
            one = bool(token >> (self.planes - 1 - p) & 1)
            wanted = places - self.zeros[p] if one else places
            raw, before = self._whole(p)
            seen = before if one else np.arange(len(before)) * 8 - before
            byte = np.searchsorted(seen, wanted, side="right") - 1
            bits = np.unpackbits(raw[byte][:, None], axis=1, bitorder="little").astype(bool)
            order = np.cumsum(bits if one else ~bits, axis=1)
            places = byte * 8 + np.argmax(order == (wanted - seen[byte] + 1)[:, None], axis=1)
        return places

    def tokens(self) -> np.ndarray:
        """All ids, in order."""
        now = np.zeros(self.n, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for p in range(self.planes - 1, -1, -1):
            raw = [np.frombuffer(self._unpack(c), dtype=np.uint8) for c in self._chunks[p]]
            one = np.unpackbits(np.concatenate(raw), count=self.n, bitorder="little").view(bool) if raw else np.zeros(0, bool)
            now[self.zeros[p] :] |= now.dtype.type(1 << (self.planes - 1 - p))
            above = np.empty_like(now)
            above[~one] = now[: self.zeros[p]]
            above[one] = now[self.zeros[p] :]
            now = above
        return now.astype(np.uint32)


def write_shards(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Writes `docs` (doc_id, text) to `path`. tokenizer: a word-level vocabulary file of the `tokenizers` library."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces=False)
        part, number = TaskContext.get().partitionId(), 0
        names: list = []
        ids: list = []
        total = 0

        def shard():
            tokens = np.concatenate(ids)
            row = [[part], [number], [len(tokens)], [names], [build(tokens, np.array([len(x) for x in ids]))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], ["part", "number", "n_tokens", "doc_ids", "matrix"]
            )

        for batch in batches:
            id_type = batch.schema.field(0).type
            own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(texts), 256):
                for doc_id, found in zip(own[a : a + 256], encode.encode(texts[a : a + 256])):
                    if total and total + len(found) >= SHARD:
                        yield shard()
                        number, total = number + 1, 0
                        names.clear()
                        ids.clear()
                    names.append(doc_id)
                    ids.append(np.append(found, np.uint32(END)))
                    total += len(found) + 1
        if total:
            yield shard()

    kind = docs.schema["doc_id"].dataType.simpleString()
    shards = ordered.mapInArrow(
        run, f"part int, number int, n_tokens long, doc_ids array<{kind}>, matrix binary"
    )
    shards.write.option("compression", "uncompressed").parquet(path)


def _placed(shards: DataFrame) -> DataFrame:
    """part, number, first: the ids of all shards before each one."""
    inside = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    starts = shards.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("own_start"))
    return starts.join(parts, "part").select("part", "number", (F.col("part_start") + F.col("own_start")).alias("first"))


def _asked(shards: DataFrame, columns: list[str], answer, ddl: str, names: list[str]) -> DataFrame:
    """Rows that `answer(matrix, row)` gives for each shard as lists or arrays, behind part and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                columns = answer(WaveletMatrix(row["matrix"].as_py()), row)
                n = len(columns[0])
                key = [pa.array([row[c].as_py()] * n, pa.int32()) for c in ("part", "number")]
                yield pa.RecordBatch.from_arrays([*key, *columns], ["part", "number", *names])

    return shards.select("part", "number", *columns, "matrix").mapInArrow(run, f"part int, number int, {ddl}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, n_end (how many of its ids are END, by rank) of
    each stored document."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def answer(matrix: WaveletMatrix, row: dict) -> list:
        data = matrix.tokens().astype("<u4")
        ends = np.cumsum(matrix.sizes)
        starts = ends - matrix.sizes
        crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
        own = [starts, matrix.sizes, np.array(crc, dtype=np.int64), matrix.counts(END, starts, ends)]
        return [row["doc_ids"].values, *[pa.array(x, pa.int64()) for x in own]]

    found = _asked(
        shards, ["doc_ids"], answer, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, n_end long",
        ["doc_id", "start", "n_tokens", "ids_crc32", "n_end"],
    )
    return found.join(_placed(shards), ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "n_end"
    )


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, n: how often each id occurs in all files, by two ranks a plane and shard."""
    tokens = sorted(set(tokens))

    def answer(matrix: WaveletMatrix, row: dict) -> list:
        return [pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())]

    found = _asked(spark.read.parquet(path), [], answer, "token long, n long", ["token", "n"])
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, position (from the first id of all files), doc_id, offset (in the document) of every occurrence, by select."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    tokens = sorted(set(tokens))

    def answer(matrix: WaveletMatrix, row: dict) -> list:
        found = [matrix.occurrences(t) for t in tokens]
        places = np.concatenate([np.zeros(0, dtype=np.int64), *found])
        ends = np.cumsum(matrix.sizes)
        doc = np.searchsorted(ends, places, side="right")
        names = row["doc_ids"].values.take(pa.array(doc, pa.int64()))
        token = np.repeat(tokens, [len(f) for f in found])
        return [pa.array(token, pa.int64()), pa.array(places, pa.int64()), names, pa.array(places - (ends - matrix.sizes)[doc], pa.int64())]

    found = _asked(
        shards, ["doc_ids"], answer, f"token long, place long, doc_id {kind}, offset long", ["token", "place", "doc_id", "offset"]
    )
    return found.join(_placed(shards), ["part", "number"]).select(
        "token", (F.col("first") + F.col("place")).alias("position"), "doc_id", "offset"
    )


def read_tokens(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """position, token of the ids from start to end (not included), by access; shards outside are not opened."""
    shards = spark.read.parquet(path)
    wanted = shards.join(_placed(shards), ["part", "number"]).where((F.col("first") < end) & (F.col("first") + F.col("n_tokens") > start))

    def answer(matrix: WaveletMatrix, row: dict) -> list:
        first = row["first"].as_py()
        places = np.arange(max(0, start - first), min(matrix.n, end - first))
        return [pa.array(places + first, pa.int64()), pa.array(matrix.accesses(places), pa.int64())]

    return _asked(wanted, ["first"], answer, "position long, token long", ["position", "token"]).select("position", "token")
