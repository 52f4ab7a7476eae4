"""Near-duplicate vectors by product quantisation.

Vectors of one label link from a cosine of SIMILARITY on. Equal vectors of a label are one class that counts as often as
it occurs. Unit vectors go to coarse lists (nearest centre); what is left of them is coded in PARTS subspaces of
CODES codewords. No pair is lost by that, whatever the vectors. Vectors of cosine SIMILARITY are
R = sqrt(2 - 2 x SIMILARITY) apart, 0.374. Those of two lists lie on either side of the plane halfway between the centres, so one of them is
at most R / 2 from it, and a vector probes each list to whose plane it is that near. In probed lists, codewords looked up by code give
approximate cosines: q m = q m' + m e + (q - m) e with the code m' of m and its error e, and the last is at most R |e|. What
can reach SIMILARITY by that is ranked by its exact cosine in double precision. Before the codes, the coordinates q1, m1 on the
first principal axes (HEAD, or a third of all) leave out what they can: q m is at most q1 m1 + |q2| |m2| with the rests q2, m2.

Centres and codewords are fitted on about SAMPLE classes (a hash decides); there is a list for about LIST classes of a
label. All classes are indexed. A hash deals the classes of a label and length to groups of at most GROUP bytes of vectors, and each
pair of groups meets in one task, which goes through the lists in blocks of about BLOCK; so lists and labels of any size are
spread. A class is sent once for each group of its label, as it came: components in their own type, with list and code.
The copies are sent in rounds of about one copy of each class, and shuffle files go at the end of a round, so the disk holds the
index and about as much again, however many copies there are. Vectors of a length that the sample lacks, or of too few
classes for codes, are all compared exactly. Pairs of groups return, per vector, the number of its links, and links that span
their components, not all pairs.

Null labels; vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of different
lengths do not link. Rows that repeat an id are vectors of their own; a null id never names a component. Ties between centres go to the
first one. An empty table gives no rows. Only vec_id, label and embedding are read, so other columns may have any name; the table is
read for the size, for the sample, for the classes and for the result, and has to hold the same rows each time.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from txguard.llm.components import components
from txguard.plans.workspace import stored

SIMILARITY = 0.93
SAMPLE, LIST, LISTS, BLOCK = 16_384, 256, 4096, 1024
PARTS, CODES, ROUNDS, HEAD = 8, 256, 8, 16
GROUP, LEAST_GROUP, QUERIES, PRODUCTS = 64 << 20, 2 << 20, 65_536, 1 << 18
NO_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


def centres_of(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k means of x, a bounded sample."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = _squares(x, centres).argmin(axis=1)
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Coarse centres; per subspace, codewords for what remains; and the first principal axes."""
    coarse = centres_of(sample, min(lists, len(sample)), 1)
    rest = sample - coarse[_squares(sample, coarse).argmin(axis=1)]
    parts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
    head = max(HEAD, sample.shape[1] // 3)
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, : head if sample.shape[1] > 2 * head else 0]
    return coarse, [centres_of(rest[:, p], CODES, 2 + i) for i, p in enumerate(parts)], axes


def _parts(book, size: int) -> list[np.ndarray]:
    return np.array_split(np.arange(size), len(book[1]))


def _matrix(vectors: pa.ListArray, rows: np.ndarray, size: int) -> np.ndarray:
    """Vectors of `size` components of those rows."""
    flat, ends = vectors.values.to_numpy(), vectors.offsets.to_numpy()
    if (np.diff(ends) == size).all():
        return flat[ends[0] : ends[-1]].reshape(-1, size)[rows]
    return flat[ends[rows][:, None] + np.arange(size)]


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(float) + 0.0
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _keys(labels: pa.Array, vectors: pa.ListArray) -> pa.Array:
    """Names of label and vector (null: links with nothing)."""
    ends = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(float) + 0.0
    odd, some = (np.concatenate([[0], np.cumsum(x)])[ends] for x in (~np.isfinite(flat), flat != 0))
    good = (odd[1:] == odd[:-1]) & (some[1:] > some[:-1])
    good &= labels.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    keys = [
        hashlib.md5(repr(label).encode() + b"\0" + flat[a:b].tobytes()).digest() if yes else None
        for label, yes, a, b in zip(labels.to_pylist(), good.tolist(), ends[:-1].tolist(), ends[1:].tolist())
    ]
    return pa.array(keys, pa.binary())


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, vector -> and key."""
    for batch in batches:
        keys = _keys(batch.column(1), batch.column(2))
        yield pa.RecordBatch.from_arrays([*batch.columns, keys], ["vec_id", "label", "vector", "key"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, vector -> vec_id and key."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _keys(batch.column(1), batch.column(2))], ["vec_id", "key"])


def apart(least: float) -> float:
    """Largest distance of unit vectors of that cosine, with room for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6


def _index(books, least: float):
    """Adds list, codes and what the codes may fall short of a cosine of `least` to classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            sizes = batch.column(batch.schema.get_field_index("size")).to_numpy()
            lists, codes, short = np.zeros(len(sizes), np.int32), [b""] * len(sizes), np.zeros(len(sizes))
            for size in np.unique(sizes).tolist():
                book, all_rows = books.value.get(size), np.flatnonzero(sizes == size)
                for a in range(0, len(all_rows) if book else 0, BLOCK):
                    rows = all_rows[a : a + BLOCK]
                    x = _units(_matrix(vectors, rows, size))
                    near = _squares(x, book[0]).argmin(axis=1)
                    rest = x - book[0][near]
                    error, along, code = np.zeros(len(rows)), np.zeros(len(rows)), []
                    for words, p in zip(book[1], _parts(book, size)):
                        code.append(_squares(rest[:, p], words).argmin(axis=1))
                        left = rest[:, p] - words[code[-1]]
                        error += (left * left).sum(axis=1)
                        along += (x[:, p] * left).sum(axis=1)
                    lists[rows] = near
                    short[rows] = along + apart(least) * np.sqrt(error) + 1e-5
                    for r, c in zip(rows.tolist(), np.array(code, dtype=np.uint8).T):
                        codes[r] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.int32()), pa.array(codes, pa.binary()), pa.array(short, pa.float64())],
                [*batch.schema.names, "list", "codes", "short"])

    return run


class _Group:
    """Classes of one group in the order of their lists, which begin at `starts`; rows from `at` on in the task."""

    def __init__(self, columns: dict, rows: np.ndarray, at: int):
        self.at, self.size = at, len(rows)
        self.node, self.n, self.list, self.codes, self.short, self.raw = (
            columns[c][rows] for c in ("node", "n", "list", "codes", "short", "vector")
        )
        self.lists, self.starts = np.unique(self.list, return_index=True)
        self.ends = np.append(self.starts[1:], len(rows))


def _loaded(batches: Iterator[pa.RecordBatch]) -> tuple[list[_Group], int]:
    """The one or two groups of a task, and the length of their vectors."""
    parts: dict = {c: [] for c in ("node", "n", "list", "codes", "short", "vector", "first")}
    size = 0
    for batch in batches:
        column = {c: batch.column(batch.schema.get_field_index(c)) for c in [*parts, "size"]}
        if not batch.num_rows:
            continue
        size = column["size"][0].as_py()
        for c in ("node", "n", "list", "short", "first"):
            parts[c].append(np.array(column[c].to_numpy(zero_copy_only=False)))
        parts["vector"].append(_matrix(column["vector"], np.arange(batch.num_rows), size))
        parts["codes"].append(np.frombuffer(b"".join(column["codes"].to_pylist()), np.uint8).reshape(batch.num_rows, -1))
    columns = {}
    for c in list(parts):  # one after the other: the vectors are most of it
        columns[c] = np.concatenate(parts.pop(c))
    order, first = np.lexsort((columns["node"], columns["list"])), columns["first"]
    found = [order[first[order] == side] for side in (True, False)]
    return [_Group(columns, rows, at) for rows, at in zip(found, (0, len(found[0]))) if len(rows)], size


def _probes(raw: np.ndarray, own: np.ndarray, other: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """Whether vectors of the lists `own` probe the lists `other`; row by row, so the same whoever asks."""
    x, a, b = _units(raw), centres[own], centres[other]
    away, near, between = (((p - q) ** 2).sum(axis=1) for p, q in ((x, b), (x, a), (a, b)))
    return away <= near + apart(least) * np.sqrt(between) + 1e-9


def _asked(raw: np.ndarray, own: np.ndarray, lists: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """Bits, list by list, for all vectors that may probe it: never fewer than `_probes` says."""
    spare = 4e-7 * raw.shape[1] + 4e-6  # what single precision may lose
    halves, narrow = (centres * centres).sum(axis=1) / 2, np.ascontiguousarray(centres[lists].T.astype(np.float32))
    bits = np.empty((len(lists), -(-len(raw) // 8)), np.uint8)
    for a in range(0, len(raw), 1024):
        x, mine = _units(raw[a : a + 1024]).astype(np.float32), own[a : a + 1024]
        heads, which = _runs(mine)  # in the order of lists
        room = apart(least) / 2 * np.sqrt(_squares(centres[heads], centres[lists])) - halves[lists] + halves[heads][:, None] + spare
        room, near = room.astype(np.float32), (x * centres[mine].astype(np.float32)).sum(axis=1)
        over = x @ narrow
        for k, (r, e) in enumerate(pairwise([*np.flatnonzero(np.append(True, which[1:] != which[:-1])).tolist(), len(x)])):
            over[r:e] += room[k]
        yes = np.zeros((-(-len(x) // 8) * 8, len(lists)), np.uint8)
        np.greater_equal(over, near[:, None], out=yes[: len(x)].view(bool))
        yes = yes.reshape(-1, 8, len(lists))
        bits[:, a // 8 : (a + len(x) + 7) // 8] = reduce(np.bitwise_or, (yes[:, k] << 7 - k for k in range(8))).T  # as packbits, in less time
    return bits


def _heads(raw: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the axes and the length of the rest: their product is no less than the cosine."""
    out = np.empty((len(raw), axes.shape[1] + 1), np.float32)
    for a in range(0, len(raw), 4 * BLOCK):
        head = _units(raw[a : a + 4 * BLOCK]) @ axes
        rest = np.sqrt(np.maximum(1 - (head * head).sum(axis=1), 0))
        out[a : a + 4 * BLOCK] = np.column_stack([head, rest])
    return out


def _runs(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ascending i, and which of them each is."""
    new = np.append(True, i[1:] != i[:-1])
    return i[new], np.cumsum(new) - 1


def _distinct(names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of names (below n), and which of them each is."""
    if n > 4 * len(names):
        return np.unique(names, return_inverse=True)
    seen = np.zeros(n, dtype=bool)
    seen[names] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[names]


def _products(left, right, i: np.ndarray, j: np.ndarray, shape: tuple[int, int] | None) -> np.ndarray:
    """Of the pairs (i, j); left and right give the vectors of places. shape: of a block, where i ascends."""
    if shape and len(i) * 64 > shape[0] * shape[1]:
        some, which = _runs(i)
        return (left(some) @ right(np.arange(shape[1])).T)[which, j]
    out = np.empty(len(i))
    for a in range(0, len(i), BLOCK):
        out[a : a + BLOCK] = (left(i[a : a + BLOCK]) * right(j[a : a + BLOCK])).sum(axis=1)
    return out


def _exact(q: _Group, m: _Group, rows: np.ndarray, cols: np.ndarray, i: np.ndarray, j: np.ndarray, shape, least: float):
    """Those of the pairs of places in rows and cols that the cosine in double precision confirms."""
    if not len(i):
        return i, j
    yes = _products(lambda k: _units(q.raw[rows[k]]), lambda k: _units(m.raw[cols[k]]), i, j, shape) >= least
    return i[yes], j[yes]


def _ask(g: _Group, rows: np.ndarray, i: np.ndarray, lists: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """Whether the rows at places i of g probe the lists, computed once for each row and list."""
    names, which = _distinct(lists, len(centres))
    asked, at = _distinct(i * len(names) + which, len(rows) * len(names))
    if not len(asked):
        return np.zeros(0, dtype=bool)
    of = rows[asked // len(names)]
    return _probes(g.raw[of], g.list[of], names[asked % len(names)], centres, least)[at]


def _confirmed(q: _Group, m: _Group, rows: np.ndarray, cols: np.ndarray, i: np.ndarray, j: np.ndarray, shape, book, least: float):
    """Those of the pairs that the codes find, the exact cosine confirms, and that come from here.

    A pair that probes each other comes from the smaller node; others from the one that probes."""
    centres, words = book[0], book[1]
    near = _products(
        lambda k: _units(q.raw[rows[k]]),
        lambda k: centres[m.list[cols[k]]] + np.concatenate([w[c] for w, c in zip(words, m.codes[cols[k]].T)], axis=1),
        i, j, shape,
    ) >= least - m.short[cols[j]]
    i, j = _exact(q, m, rows, cols, i[near], j[near], shape, least)
    yes = (q.node[rows[i]] != m.node[cols[j]]) & _ask(q, rows, i, m.list[cols[j]], centres, least)
    i, j = i[yes], j[yes]
    back = np.flatnonzero(q.node[rows[i]] > m.node[cols[j]])
    keep = np.ones(len(i), dtype=bool)
    keep[back] = ~_ask(m, cols, j[back], q.list[rows[i[back]]], centres, least)
    return i[keep], j[keep]


def _linked(q: _Group, m: _Group, book, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """rows of q, rows of m, and the linked pairs as places in them. A pair comes once, from q to m or from m to q."""
    if book is None:  # all pairs, in one direction
        for b in range(0, m.size if q.at <= m.at else 0, BLOCK):
            cols = np.arange(b, min(m.size, b + BLOCK))
            step = PRODUCTS // len(cols)
            for a in range(0, q.size, step):
                rows = np.arange(a, min(q.size, a + step))
                pairs = q.node[rows][:, None] < m.node[cols] if q is m else np.ones((len(rows), len(cols)), dtype=bool)
                yield rows, cols, *_exact(q, m, rows, cols, *np.divmod(np.flatnonzero(pairs), len(cols)), pairs.shape, least)
        return
    spare = 2e-7 * (q.raw.shape[1] + 8)
    heads, others = (_heads(g.raw, book[2]) for g in (q, m))
    every, few, waiting = (np.arange(q.size), np.arange(m.size)), [], 0  # few: pairs of blocks that have few, taken together
    room, marks = np.empty(PRODUCTS, np.float32), np.empty(PRODUCTS, dtype=bool)
    for start in range(0, q.size, QUERIES):
        own = q.list[start : start + QUERIES]
        bits = _asked(q.raw[start : start + QUERIES], own, m.lists, book[0], least)
        for k in range(len(m.lists)):
            asks = np.flatnonzero(np.unpackbits(bits[k], count=len(own)).view(bool))
            for b in range(m.starts[k], m.ends[k] if len(asks) else 0, BLOCK):
                cols = np.arange(b, min(m.ends[k], b + BLOCK))
                step, block = PRODUCTS // len(cols), np.ascontiguousarray(others[cols].T)
                for a in range(0, len(asks), step):
                    rows = start + asks[a : a + step]
                    size = len(rows) * len(cols)
                    np.matmul(heads.take(rows, axis=0), block, out=room[:size].reshape(-1, len(cols)))
                    found = np.flatnonzero(np.greater_equal(room[:size], np.float32(least - spare), out=marks[:size]))
                    i, j = np.divmod(found, len(cols))
                    if len(i) * 64 > size:
                        yield rows, cols, *_confirmed(q, m, rows, cols, i, j, (len(rows), len(cols)), book, least)
                    elif len(i):
                        few.append((rows[i], cols[j]))
                        waiting += len(i)
                if waiting > PRODUCTS:
                    yield *every, *_confirmed(q, m, *every, *map(np.concatenate, zip(*few)), None, book, least)
                    few, waiting = [], 0
    if few:
        yield *every, *_confirmed(q, m, *every, *map(np.concatenate, zip(*few)), None, book, least)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of n nodes reaches by links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _joining(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of places that span the components of the pairs i (below n), n + j; i ascends."""
    if len(i) <= n:
        return i, n + j
    size = n + int(j.max()) + 1
    first = np.full(size, -1)
    first[n + j[::-1]] = i[::-1]
    heads = np.append(True, i[1:] != i[:-1])
    first[i[heads]] = n + j[heads]
    at = np.flatnonzero(first >= 0)
    root = spanning(size, at, first[at])
    more = root[i] != root[n + j]  # what the first links leave apart
    return np.concatenate([at, i[more]]), np.concatenate([first[at], n + j[more]])


def _compare(books, least: float):
    """Pairs of groups -> rows (a, null, links of a) and (a, b, null): links that span the components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, size = _loaded(batches)
        both = groups[-1].at > 0
        if groups[0].size + both < 2:
            return
        book = books.value.get(size)
        node = np.concatenate([g.node for g in groups])
        count = np.zeros(len(node), dtype=np.int64)
        links: list = [np.zeros((2, 0), dtype=np.int64)]
        waiting = 0
        q, m = groups[0], groups[-1]
        for q, m in ((q, m), (m, q)) if both else ((q, m),):
            for rows, cols, i, j in _linked(q, m, book, least):
                if not len(i):
                    continue
                count[q.at + rows] += np.bincount(i, weights=m.n[cols[j]], minlength=len(rows)).astype(np.int64)
                count[m.at + cols] += np.bincount(j, weights=q.n[rows[i]], minlength=len(cols)).astype(np.int64)
                named = np.concatenate([q.at + rows, m.at + cols])
                links.append(np.stack([named[x] for x in _joining(len(rows), i, j)]))
                waiting += links[-1].shape[1]
                if waiting > 1 << 21:
                    root = spanning(len(node), *np.concatenate(links, axis=1))
                    hung = np.flatnonzero(root != np.arange(len(node)))
                    links, waiting = [np.stack([hung, root[hung]])], 0
        root = spanning(len(node), *np.concatenate(links, axis=1))
        counted, hung = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(node)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([node[counted], node[hung]])),
             pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(node[root[hung]])]),
             pa.concat_arrays([pa.array(count[counted]), pa.nulls(len(hung), pa.int64())])], ["a", "b", "n"])

    return run


def _written(df: DataFrame, purpose: str) -> DataFrame:
    """As `stored`; the write's shuffle files go with its end, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(NO_SHUFFLES, None)
    conf.set(NO_SHUFFLES, "true")
    try:
        return stored(df, purpose)
    finally:
        conf.unset(NO_SHUFFLES) if before is None else conf.set(NO_SHUFFLES, before)


def _links(indexed: DataFrame, books, least: float, width: Column) -> DataFrame:
    """What `_compare` returns for all pairs of groups, round by round."""
    spark = indexed.sparkSession
    family = ["label", "size"]
    cores = spark.sparkContext.defaultParallelism
    families = indexed.groupBy(family).agg((F.count("*") * F.first(width)).alias("bytes"))
    total = families.agg(F.sum("bytes")).first()[0] or 0
    most = max(LEAST_GROUP, min(GROUP, total // cores))
    families = families.withColumn("groups", F.ceil(F.col("bytes") / most).cast("int"))
    several = stored(families.where("groups > 1").drop("bytes"), "vector-groups")  # at most total / most rows
    sent, tasks = families.agg(F.sum(F.col("bytes") * F.col("groups")), F.sum(F.expr("groups * (groups + 1L) / 2"))).first()
    rounds = max(1, -(-(sent or 0) // max(1, total)))
    dealt = indexed.join(F.broadcast(several), family, "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    parts = int(max((sent or 0) / rounds / (LEAST_GROUP * 4), min((tasks or 0) / rounds, 4 * cores))) + 1
    found = []
    for turn in range(rounds):
        others = F.filter(F.sequence(F.lit(0), F.col("groups") - 1), lambda k: (F.col("own") + k) % rounds == turn)
        copies = dealt.withColumn("other", F.explode(others)).select(
            *family, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") <= F.col("other")).alias("first"), "node", "n", "list", "codes", "short", "vector")
        pair = [*family, "low", "high"]
        copies = copies.repartition(parts, *pair).groupBy(pair)
        found.append(_written(copies.applyInArrow(_compare(books, least), "a long, b long, n long"), "vector-links"))
    return reduce(DataFrame.union, found)


def near_duplicates(vectors: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of `vectors` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    element = (FloatType() if single else DoubleType()).simpleString()
    given = vectors.select("vec_id", "label", F.col("embedding").cast(f"array<{element}>").alias("vector"))
    rows = given.mapInArrow(_keyed, f"vec_id {id_type}, label {label_type}, vector array<{element}>, key binary")
    rows = rows.where("key IS NOT NULL")
    total, labels = rows.agg(F.approx_count_distinct("key", 0.02), F.approx_count_distinct("label")).first()
    share = min(1.0, SAMPLE / max(1, total))
    picked = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    picked = picked.groupBy("key").agg(F.first("vector").alias("vector")).toPandas()  # about SAMPLE rows
    lists = int(max(1, min(LISTS, total / max(1, labels) / LIST)))
    by_size: dict = {}
    for key, vector in sorted(zip(map(bytes, picked["key"]), picked["vector"]), key=lambda row: row[0]):
        by_size.setdefault(len(vector), []).append(vector)
    books = spark.sparkContext.broadcast(
        {size: fit(_units(np.array(raw)), lists) for size, raw in by_size.items() if len(raw) >= CODES}
    )

    classes = rows.groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    classes = classes.withColumn("size", F.size("vector")).withColumn("node", F.monotonically_increasing_id())
    kinds = ", ".join(f"{c} {kind}" for c, kind in classes.dtypes)
    indexed = classes.mapInArrow(_index(books, least), f"{kinds}, list int, codes binary, short double")
    indexed = _written(indexed, "vector-index")
    found = _links(indexed, books, least, F.col("size") * F.lit(4 if single else 8))

    count = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    joined = stored(components(found.where("n IS NULL").select("a", "b")), "vector-components")
    named = joined.toDF("node", "component").join(indexed.select("node", "rep"), "node")
    named = named.groupBy("component").agg(F.min("rep").alias("component_id")).join(
        joined.toDF("node", "component"), "component").select("node", "component_id")
    classes = indexed.select("node", "key", "rep", "n").join(count.toDF("node", "links"), "node", "left").join(named, "node", "left")
    out = given.mapInArrow(_named, f"vec_id {id_type}, key binary").join(classes, "key", "left").select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "rep", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
