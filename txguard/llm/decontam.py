"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words (`text.words`) of a benchmark item, or all words of a shorter
item. For each window length T that occurs, both sides are winnowed: of every w = T - k + 1 successive
k-grams (k = GRAM, or T if that is less) the one with the smallest hash is kept, the last one of equals.
Equal runs of T words keep the same k-gram, so each shared window shows as a shared fingerprint:
documents and items are joined on fingerprints, and each hit is extended to the windows of T words
around it, word by word. The result is exact.

Document fingerprints that no item has are mostly left out before the join by a bit table of items'
fingerprints; its size is fixed, and what passes it by chance fails the join.

Null and empty texts have no words and no hits; items without words are ignored. Items that repeat with one
id count once; documents that repeat give a row each. Of equal hashes the last in a window is kept, on both sides alike. Long texts are
taken whole, one at a time. Without items nothing is hit; without documents there are no rows. Only the named columns are read; others may
have any name and are kept by `uncontaminated`.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm import text
from txguard.plans.workspace import stored

WINDOW, GRAM = 10, 5
BITS = 1 << 24


def winnow(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, k: int, w: int) -> np.ndarray:
    """First words of the kept k-grams. begins, ends: words of each text."""
    value, _ = text.grams(hashes, np.zeros(len(hashes), dtype=np.int8), k)
    n = len(value) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, at = value[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, w):
        later = value[j : j + n]
        take = later <= best
        best[take] = later[take]
        at[take] = j
    at += np.arange(n)
    inside = np.zeros(n + 1, dtype=np.int32)
    full = ends - begins >= k + w - 1
    np.add.at(inside, begins[full], 1)
    np.add.at(inside, ends[full] - (k + w - 1) + 1, -1)
    return np.unique(at[np.cumsum(inside[:-1]) > 0])


def _context(w: text.Words, d: int, at: int, k: int, length: int) -> tuple[int, bytes]:
    """The words that windows around the k-gram at word `at` can hold: how many precede it, and them."""
    a, b = max(w.first[d], at - (length - k)), min(w.first[d + 1], at + length)
    return int(at - a), w.text(a, b)


def _fingerprints(texts: list, lengths: list[int] | None, bits: np.ndarray | None):
    """(text number, words, and per fingerprint: length, hash, word, words before, words around).

    lengths None: each text has its own window length, as items do.
    """
    for part in text.chunks(texts):
        w = text.words(texts[part])
        h = w.hashes()
        sizes = np.diff(w.first)
        found: dict[int, list] = {}
        for length in lengths if lengths is not None else sorted({min(int(x), WINDOW) for x in sizes} - {0}):
            k = min(GRAM, length)
            fits = sizes >= length if lengths is not None else np.minimum(sizes, WINDOW) == length
            at = winnow(h, w.first[:-1][fits], w.first[1:][fits], k, length - k + 1)
            if not len(at):
                continue
            value = text.grams(h, w.doc, k)[0][at] ^ text.splitmix(np.array([length], dtype=np.uint64))
            if bits is not None:
                slot = value & np.uint64(BITS - 1)
                seen = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                at, value = at[seen == 1], value[seen == 1]
            for p, v in zip(at.tolist(), value.view(np.int64).tolist()):
                d = int(w.doc[p])
                found.setdefault(d, []).append((length, v, p - int(w.first[d]), *_context(w, d, p, k, length)))
        for d in range(part.stop - part.start):
            yield part.start + d, int(sizes[d]), found.get(d, [])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        pick, rows = [], []
        for i, _, found in _fingerprints(batch.column(1).to_pylist(), None, None):
            pick += [i] * len(found)
            rows += found
        length, mark, _, before, around = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(pick, pa.int64())), pa.array(length, pa.int32()), pa.array(mark, pa.int64()),
             pa.array(before, pa.int32()), pa.array([x.decode("utf-8", "replace") for x in around], pa.string())],
            ["item_id", "length", "mark", "before", "around"],
        )


def _document_rows(lengths: list[int], packed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(zlib.decompress(packed.value), dtype=np.uint8)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            pick, sizes, prints, keys = [], [], [], []
            for i, n, found in _fingerprints(texts, lengths, bits):
                pick.append(i)
                sizes.append(n)
                keys.append(zlib.crc32((texts[i] or "").encode("utf-8", "replace")) << 32 | len(texts[i] or "") & 0xFFFFFFFF)
                prints.append(
                    [{"length": a, "mark": b, "at": c, "before": d, "around": e.decode("utf-8", "replace")} for a, b, c, d, e in found]
                )
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(pick, pa.int64())), pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                 pa.array(sizes, pa.int64()), pa.array(prints, pa.list_(_PRINT))],
                ["doc_id", "text_key", "n_words", "prints"],
            )

    return run


_PRINT = pa.struct(
    [("length", pa.int32()), ("mark", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("around", pa.string())]
)
_PRINTS = "array<struct<length: int, mark: bigint, at: bigint, before: int, around: string>>"


def _bit_table(items: DataFrame) -> bytes:
    """The slots of all item fingerprints, of fixed size."""
    slots = items.select(F.col("mark").bitwiseAND(F.lit(BITS - 1)).alias("slot")).distinct()
    one = slots.groupBy(F.shiftright("slot", 3).alias("byte")).agg(
        F.sum(F.expr("shiftleft(1, CAST(slot & 7 AS INT))")).cast("int").alias("bits")
    )
    found = one.toPandas()
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    bits[found["byte"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.uint8)
    return zlib.compress(bits.tobytes(), 1)


def _equal_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits -> first words of the windows around them that document and item share."""
    for batch in batches:
        length, at, before, around, item_before, item_around = (
            batch.column(batch.schema.get_field_index(c)).to_pylist()
            for c in ("length", "at", "before", "around", "item_before", "item_around")
        )
        pick, first = [], []
        for i, n in enumerate(length):
            doc, item = around[i].split(" "), item_around[i].split(" ")
            low, high = -min(before[i], item_before[i]), min(len(doc) - before[i], len(item) - item_before[i])
            run = 0
            for j in range(low, high):  # place against the k-gram's first word
                run = run + 1 if doc[before[i] + j] == item[item_before[i] + j] else 0
                if run >= n:
                    pick.append(i)
                    first.append(at[i] + j - n + 1)
        taken = batch.select(["doc_id", "text_key", "item_id", "length"]).take(pa.array(pick, pa.int64()))
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(first, pa.int64())], [*taken.schema.names, "first"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, item_ids (sorted as strings) of each row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    bench = benchmark.select("item_id", "text").dropDuplicates()
    own = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint"
    item = f"item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    items = bench.mapInArrow(_item_rows, f"{item}, length int, mark bigint, before int, around string")
    items = stored(items.distinct(), "winnow-items")
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # WINDOW of them at most
    packed = spark.sparkContext.broadcast(_bit_table(items))

    rows = docs.select("doc_id", "text").mapInArrow(
        _document_rows(lengths, packed), f"{own}, n_words bigint, prints {_PRINTS}"
    )
    rows = stored(rows, "winnow-documents")
    hits = rows.where(F.size("prints") > 0).select("doc_id", "text_key", F.explode("prints").alias("p")).distinct()
    hits = hits.select("doc_id", "text_key", "p.*").join(
        items.withColumnsRenamed({"before": "item_before", "around": "item_around"}), ["mark", "length"]
    )
    windows = hits.mapInArrow(_equal_windows, f"{own}, {item}, length int, first bigint")
    places = F.array_sort(F.collect_set(F.struct("first", "length")))
    covered = F.aggregate(  # words under sorted, overlapping windows
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["first"] + x["length"] - F.greatest(s["end"], x["first"]))).alias("n"),
            F.greatest(s["end"], x["first"] + x["length"]).alias("end"),
        ),
    )["n"]
    found = windows.groupBy("doc_id", "text_key").agg(
        covered.alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    found = found.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "n_hit", "item_ids")
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
    return out.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that share no window with an item.

    Of rows with one id, all go if one of them shares a window.
    """
    bad = contamination(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("_txguard_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_txguard_bad")), "left_anti")
