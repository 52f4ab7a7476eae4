"""Repeated passages: runs of several consecutive sentences that occur more than once in a corpus.

A sentence ends after `.`, `!` or `?` with white space behind, or at a line feed; one of more than PIECE words counts
as several, of PIECE words each but the last. Sentences without words (`text.words`) belong to the one before. A run starts
at every sentence and takes as many as give SENTENCES sentences and WORDS words, so that a chance repeat of a few short
ones is no run. Runs are equal if their words are; a 128-bit hash of them stands for the words, and is joined over the
whole corpus. Of equal runs the first, by document id (null last), text hash and place, stays; sentences that
others cover together are removed.

Pieces of long sentences count from the sentence's start, so two documents that share a passage from inside a sentence cut
it differently. So there are also runs of WORDS words that begin where the words say so, whatever the sentences: of each
WINDOW successive runs the one of the least hash, the last of equals. Of a shared passage of n words, wherever it begins, both
documents choose the same runs; they leave no gap, as WINDOW < WORDS, and cover all but at most WINDOW - 1 words at
each end. With n > 50 these are 23 words in a row at least, and hold a whole piece or sentence of up to PIECE words.

Null and empty texts have no sentences. Rows with the same id and text share their places, so of such copies the text
is judged once and the copies alike: they count as one document. Long texts are taken whole, one at a time. An empty table gives
no rows. Only doc_id and text are read; other columns may have any name and are kept by `without_repeats`.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.llm import text
from txguard.plans.workspace import stored

SENTENCES, WORDS, PIECE = 3, 20, 12
WINDOW = 15


def sentence_words(w: text.Words) -> np.ndarray:
    """First word of each sentence or piece of one; texts begin with a new one."""
    n = len(w.start)
    if not n:
        return np.zeros(0, dtype=np.int64)
    raw = w.raw
    stop = (raw == 46) | (raw == 33) | (raw == 63)
    space = (raw == 32) | (raw == 10) | (raw == 9) | (raw == 13)
    edge = raw == 10
    edge[1:] |= stop[:-1] & space[1:]
    passed = np.cumsum(edge)
    new = np.ones(n, dtype=bool)
    new[1:] = (passed[w.start[1:]] > passed[w.end[:-1] - 1]) | (w.doc[1:] != w.doc[:-1])
    begin = np.flatnonzero(new)
    inside = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    return np.flatnonzero(inside % PIECE == 0)


def lowest(value: np.ndarray, window: int) -> np.ndarray:
    """Place of the least of each `window` successive values, the last of equals."""
    place = np.arange(len(value))
    size = 1
    while size < window and len(place):
        step = min(size, window - size)
        left, right = place[:-step], place[step:]
        place = np.where(value[right] <= value[left], right, left)
        size += step
    return place


def runs(w: text.Words, shifted: bool = False) -> tuple[np.ndarray, ...]:
    """Of each run: text, first word, word after its last, two hashes; and the first word of each sentence.

    `shifted`: also those that begin where the words say so. Words are numbered over all texts.
    """
    first = sentence_words(w)
    count = len(first)
    after = np.append(first, len(w.start))
    doc = w.doc[first] if count else np.zeros(0, dtype=np.int64)
    last_of_doc = np.searchsorted(doc, doc, side="right")
    end = np.maximum(np.arange(count) + SENTENCES, np.searchsorted(after, first + WORDS, side="left"))
    whole = end <= last_of_doc
    span = _hashed(w.hashes())
    start, end = first[whole], after[end[whole]]
    if shifted:
        every = np.arange(max(0, len(w.start) - WORDS + 1))
        least = lowest(span(every, every + WORDS)[0], WINDOW)
        reach = np.arange(len(least))
        chosen = np.unique(least[w.doc[reach] == w.doc[reach + WINDOW + WORDS - 2]])
        # a run of WORDS words may be of both kinds
        both = np.unique(np.concatenate([start << 32 | end, chosen << 32 | (chosen + WORDS)]))
        start, end = both >> 32, both & ((1 << 32) - 1)
    return w.doc[start], start, end, *span(start, end), first


def _hashed(h: np.ndarray):
    """A function that gives two hashes of the words from a to b (not included)."""
    sums = []
    for seed in (31, 32):
        scale = text.randoms(seed, 1)[0] | np.uint64(1)
        powers = np.cumprod(np.full(len(h) + 1, scale, dtype=np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(text.splitmix(h ^ np.uint64(seed)) * powers[:-1])])
        inverse = np.cumprod(np.full(len(h) + 1, _inverse(int(scale)), dtype=np.uint64))
        sums.append((total, inverse))
    return lambda a, b: [text.splitmix((t[b] - t[a]) * inverse[a] + (b - a).astype(np.uint64)) for t, inverse in sums]


def _inverse(odd: int) -> np.uint64:
    return np.uint64(pow(odd, -1, 1 << 64))


def _rows(shifted: bool, whole: bool):
    """doc_id, text_key, words of each sentence and a hash of each run, or `whole` runs (struct of lists) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in text.chunks(texts):
                w = text.words(texts[part])
                n = part.stop - part.start
                doc, start, end, one, two, first = runs(w, shifted)
                sizes = np.diff(np.append(first, len(w.start))).astype(np.int8)
                sentences = np.concatenate([[0], np.searchsorted(first, w.first[1:])]).astype(np.int32)
                before = w.first[:-1]
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
                ids_, key = ids.slice(part.start, n), pa.array(_text_keys(texts[part]), pa.int64())
                if whole:
                    items = pa.StructArray.from_arrays(
                        [pa.array(start - before[doc], pa.int32()), pa.array(end - before[doc], pa.int32()),
                         pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], ["a", "b", "h", "g"]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [ids_, key, pa.ListArray.from_arrays(pa.array(ends), items)], ["doc_id", "text_key", "runs"])
                else:
                    lists = [pa.ListArray.from_arrays(pa.array(sentences), pa.array(sizes)),
                             pa.ListArray.from_arrays(pa.array(ends), pa.array(one.view(np.int64)))]
                    yield pa.RecordBatch.from_arrays([ids_, key, *lists], ["doc_id", "text_key", "sizes", "runs"])

    return run


def _text_keys(texts: list) -> list[int]:
    return [zlib.crc32((t or "").encode("utf-8", "replace")) << 31 ^ len(t or "") for t in texts]


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, sizes, spans of words -> doc_id, text_key, n_sentences, sentences that the spans cover."""
    for batch in batches:
        removed = []
        for sizes, spans in zip(batch.column(2), batch.column(3)):
            if not spans.is_valid:
                removed.append([])
                continue
            edges = np.concatenate([[0], np.cumsum(sizes.values.to_numpy(), dtype=np.int64)])
            turn = np.zeros(edges[-1] + 1, dtype=np.int64)
            np.add.at(turn, spans.values.field("a").to_numpy(), 1)
            np.add.at(turn, spans.values.field("b").to_numpy(), -1)
            inside = np.concatenate([[0], np.cumsum(np.cumsum(turn)[:-1] > 0)])
            removed.append(np.flatnonzero(np.diff(inside[edges]) == np.diff(edges)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pc.list_value_length(batch.column(2)).cast(pa.int64()),
             pa.array(removed, pa.list_(pa.int32()))], ["doc_id", "text_key", "n_sentences", "removed"])


def repeats(docs: DataFrame, shifted: bool = False) -> DataFrame:
    """doc_id, text_key, n_sentences, removed (numbers of the sentences that go, sorted) of each row of `docs`.

    `shifted`: by all runs, also those that begin inside sentences; without it by runs of whole sentences and pieces alone.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    rows = docs.mapInArrow(
        _rows(shifted, False), f"doc_id {kind}, text_key long, sizes array<byte>, runs array<bigint>"
    )
    rows = stored(rows, "sentence-rows")
    # most runs are single: only those whose first hash comes twice are placed and kept
    twice = rows.select(F.explode("runs").alias("h")).groupBy("h").count().where("count > 1").select("h")
    every = docs.mapInArrow(
        _rows(shifted, True), f"doc_id {kind}, text_key long, runs array<struct<a:int,b:int,h:bigint,g:bigint>>"
    )
    every = every.select("doc_id", "text_key", F.explode("runs").alias("r")).select("doc_id", "text_key", "r.*")
    every = stored(every.join(stored(twice, "sentence-twice"), "h", "left_semi"), "sentence-runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "a")
    repeated = every.groupBy("h", "g").agg(F.min(place).alias("first"))
    later = every.withColumn("place", place).join(stored(repeated, "sentence-repeats"), ["h", "g"]).where("place <> first")
    gone = later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "spans")
    out = rows.select("doc_id", "text_key", "sizes").join(
        gone, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left"
    )
    return out.select("doc_id", "text_key", "sizes", "spans").mapInArrow(
        _covered, f"doc_id {kind}, text_key long, n_sentences long, removed array<int>"
    )


def cut(one: str, removed: list[int]) -> str:
    """The text without those sentences. A sentence reaches from its first word to that of the next."""
    w = text.words([one])
    edges = [*w.start[sentence_words(w)].tolist(), len(w.raw) - 1]
    raw, out, end = one.encode("utf-8", "replace"), [], 0
    for i in removed:
        out.append(raw[end : edges[i]])
        end = edges[i + 1]
    return b"".join([*out, raw[end:]]).decode("utf-8")


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs`, all rows and columns, with repeated sentences removed from text and n_chars (if there) counted again."""
    gone = repeats(docs, shifted=True).where(F.size("removed") > 0).select(
        F.col("doc_id").alias("_txguard_doc"), F.col("text_key").alias("_key"), F.col("removed").alias("_removed")
    ).distinct()
    gone = gone.groupBy("_txguard_doc").agg(F.collect_list(F.struct("_key", "_removed")).alias("_txguard_removed"))
    found = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_txguard_doc")), "left").drop("_txguard_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = {n: batch.column(n) for n in names}
            texts, marks = columns["text"].to_pylist(), columns.pop("_txguard_removed").to_pylist()
            for i, found in enumerate(marks):
                if found and texts[i]:
                    key = _text_keys([texts[i]])[0]
                    own = [m["_removed"] for m in found if m["_key"] == key]
                    if own:
                        texts[i] = cut(texts[i], own[0])
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                sizes = [n if t is None or not m else len(t) for t, n, m in zip(texts, columns["n_chars"].to_pylist(), marks)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return found.mapInArrow(run, T.StructType(docs.schema.fields))
