"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five consecutive words (`text.words`), or all words of a shorter text. Its weight is
count x idf with idf = 1 + ln((N + 1) / (df + 1)) / ln(N + 1), between 1 and 2: N texts with words in
the whole corpus, df how often, counted once per text, shingles in the same one of BUCKETS hash buckets occur. The table
of df has a fixed size, and its error as a share of N is the same for every corpus. Plain idf
would let the few changed shingles of a copy outweigh the many it shares with a large family.

Texts with the same words are one class from the start and go on as one. Each class gets
BANDS x ROWS samples; classes that share a band are compared, first by the share of equal samples,
then by the weighted Jaccard similarity of their whole texts, and linked from SIMILARITY on.
Members of buckets of more than FEW that could still link get FINER more samples, so that fewer pairs whose similarity is
just too small are compared as texts. In a band bucket not all pairs are made: some members (pivots) meet all that are not yet in their
component, links are joined to components, and this is repeated with more pivots; at last
everything outside the largest component of a bucket meets whatever is not in its own component. From
the second time on, in buckets of more than FEW members, pairs are left out that cannot link: a text shares with other components no more than
the weight S of its shingles that occur in one, so weights W, W' allow a similarity of
min(S, S') / (W + W' - min(S, S')) at most. So no link between two components is lost. A pair of similarity 0.8 shares a band with probability
1 - (1 - 0.8^4)^13 = 0.9989 and fails AGREE with less than 0.0001.

Null texts and texts without words resemble nothing: each is its own class. Rows that repeat, also those
with the same id, follow their text. A null id takes part; a class is named by its smallest id, and of ties the smallest key
represents it. Long texts are taken whole, one at a time. An empty table gives no rows. Only doc_id and text are read; other
columns may have any name and are kept by `one_of_each`.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.llm import text
from txguard.llm.components import components, joined
from txguard.plans.workspace import stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 13, 4
AGREE = 30  # of BANDS * ROWS samples; 0.8 gives 41.6 on average, with a deviation of 2.9
BUCKETS = 1 << 17
PIVOTS = (1, 4)
FEW = 32
FINER = 208  # more samples of members of large buckets
AGREE_FINER = 176  # of all 260 samples; 0.8 gives 208 on average, with a deviation of 6.4
_SAMPLES = BANDS * ROWS
_HASH_BITS = 44
_TABLE_BITS = 14
_TABLE = 1 << _TABLE_BITS
_TOGETHER = 1 << 13


def shingles(texts: list, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, text.Words]:
    """Number of the text, shingle and count, each shingle of a text once; texts in order."""
    w = text.words(texts)
    h = w.hashes()
    value, whole = text.grams(h, w.doc, k)
    doc, value = w.doc[: len(value)][whole], value[whole]
    sizes = np.diff(w.first)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        one = [text.grams(h[w.first[d] : w.first[d + 1]], w.doc[w.first[d] : w.first[d + 1]], sizes[d])[0][0] for d in short]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(one, dtype=np.uint64)])
    joint = (doc.astype(np.uint64) << np.uint64(_HASH_BITS)) | (value >> np.uint64(64 - _HASH_BITS))
    joint, count = np.unique(joint, return_counts=True)
    own = text.splitmix(joint & np.uint64((1 << _HASH_BITS) - 1))
    return (joint >> np.uint64(_HASH_BITS)).astype(np.int64), own, count, w


def _bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(BUCKETS - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(bucket, n): shingles of texts, each once per text, in each bucket; bucket -1: texts with words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in text.chunks(texts):
                doc, own, _, _ = shingles(texts[part])
                total += np.bincount(_bucket(own), minlength=BUCKETS)
                n += len(np.unique(doc))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(total[found], n))], ["bucket", "n"]
        )

    return docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf of each bucket: a table of fixed size, whatever the corpus."""
    found = document_frequencies(docs).toPandas()
    table = np.zeros(BUCKETS)
    real = found[found.bucket >= 0]
    table[real.bucket.to_numpy()] = real.n.to_numpy()
    n = max(2, int(found[found.bucket < 0].n.sum()))
    return 1 + np.log((n + 1) / (table + 1)).clip(min=0) / np.log(n + 1)


def _draws() -> tuple[np.ndarray, ...]:
    """Draws of the sampling scheme, looked up by hash: r, beta, r (beta - 1) and ln c with r, c ~ Gamma(2, 1)."""
    u = (text.randoms(11, 5 * _TABLE) >> np.uint64(11)).astype(float).reshape(5, _TABLE)
    u = (u + 0.5) / (1 << 53)
    r = -np.log(u[0] * u[1])
    return tuple(x.astype(np.float32) for x in (r, u[2], r * (u[2] - 1), np.log(-np.log(u[3] * u[4]))))


_SEED = (text.randoms(12, 2 * (_SAMPLES + FINER)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_DRAWS = _draws()


def signatures(
    doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, samples: range = range(_SAMPLES)
) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and the samples of each: one row of 32-bit numbers per text."""
    have, at = np.unique(doc, return_index=True)
    out = np.zeros((len(have), len(samples)), dtype=np.uint32)
    r, beta, shift, ln_c = _DRAWS
    short = (shingle >> np.uint64(32)).astype(np.uint32)
    log = np.log(weight).astype(np.float32)
    ends = np.append(at[1:], len(shingle))
    d = 0
    while d < len(have):  # texts that fit the processor's cache together
        e = max(d + 1, int(np.searchsorted(ends, at[d] + _TOGETHER, side="right")))
        own, ln_w, begin = short[at[d] : ends[e - 1]], log[at[d] : ends[e - 1]], at[d:e] - at[d]
        both = np.empty((len(own), 2), dtype=np.uint32)  # name and rank, read as one little-endian number
        one = both.view("<u8").ravel()
        for k, j in enumerate(samples):
            s = own * _SEED[2 * j]
            s ^= s >> np.uint32(15)
            s *= _SEED[2 * j + 1]
            s ^= s >> np.uint32(16)
            u = (s >> np.uint32(32 - _TABLE_BITS)).astype(np.intp)
            c = ((s >> np.uint32(2)) & np.uint32(_TABLE - 1)).astype(np.intp)
            scale = r.take(u, mode="clip")
            t = ln_w / scale
            t += beta.take(u, mode="clip")
            np.floor(t, out=t)
            scale *= t  # ln a = ln c - r (t - beta + 1)
            np.subtract(shift.take(u, mode="clip"), scale, out=scale)
            scale += ln_c.take(c, mode="clip")
            scale += np.float32(64)
            both[:, 1] = scale.view(np.uint32)
            np.bitwise_xor(s, t.astype(np.int32).view(np.uint32) * _SEED[0], out=both[:, 0])
            out[d:e, k] = np.minimum.reduceat(one, begin).astype(np.uint32)
        d = e
    return have, out


def _sign(table):
    """Rows (id, text) -> id, key (digest of the words), samples, hashes of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in text.chunks(texts):
                doc, own, count, w = shingles(texts[part])
                n = part.stop - part.start
                have, samples = signatures(doc, own, count * table.value[_bucket(own)])
                key = [hashlib.md5(x).hexdigest() if x else None for x in w.normal()]
                rows = samples.astype(np.uint64).reshape(len(have) * BANDS, ROWS)
                mixed = np.tile(np.arange(BANDS, dtype=np.uint64), len(have))
                for j in range(ROWS):
                    mixed = text.splitmix(mixed ^ rows[:, j])
                full = np.zeros(n, dtype=bool)
                full[have] = True

                def lists(values, each, kind):
                    ends = np.concatenate([[0], np.cumsum(full * each)])
                    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel(), kind))

                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.start, n), pa.array(key, pa.string()),
                        lists(samples.view(np.int32), _SAMPLES, pa.int32()), lists(mixed.view(np.int64), BANDS, pa.int64()),
                    ],
                    ["doc_id", "key", "samples", "bands"],
                )

    return run


def _weigh(one: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, own, count, _ = shingles([one])
    order = np.argsort(own)
    return own[order], (count * table[_bucket(own)])[order]


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Sum of the smaller over sum of the larger weights; a and b: sorted shingles and their weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - low
    return float(low / total) if total else 0.0


def _verify(table, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}

        def vector(key, one):
            if key not in seen:
                if len(seen) >= 16:
                    seen.clear()
                seen[key] = _weigh(one, table.value)
            return seen[key]

        for batch in batches:
            a, b, ta, tb = batch.columns
            linked = [
                weighted_jaccard(vector(ka, ta[i].as_py()), vector(kb, tb[i].as_py())) >= least
                for i, (ka, kb) in enumerate(zip(a.to_pylist(), b.to_pylist()))
            ]
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    return run


def _keys(texts: list) -> list:
    """Digest of the words of each text, null without words."""
    out = []
    for part in text.chunks(texts):
        out += [hashlib.md5(x).hexdigest() if x else None for x in text.words(texts[part]).normal()]
    return out


def _texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(key, text) of the classes in `members` (key, rep): the text of one row of each."""

    def run(batches):
        for batch in batches:
            same = [a == b for a, b in zip(batch.column(0).to_pylist(), _keys(batch.column(1).to_pylist()))]
            yield batch.filter(pa.array(same, pa.bool_()))

    found = docs.select(F.col("doc_id").alias("own"), "text").join(
        members.select("key", "rep"), F.col("own").eqNullSafe(F.col("rep"))
    )
    return found.select("key", "text").mapInArrow(run, "key string, text string").dropDuplicates(["key"])


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Rows of `docs` (doc_id, text, others ignored) -> doc_id, class_id, kept.

    class_id is the smallest doc_id of the class; kept says whether this row bears it.
    """
    out = _judged(docs, least).select("doc_id", "class_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _judged(docs: DataFrame, least: float) -> DataFrame:
    """doc_id, key, class_id and class_key, the smallest key of the class, of each row."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(idf_table(docs))
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("key", T.StringType()),
         T.StructField("samples", T.ArrayType(T.IntegerType())), T.StructField("bands", T.ArrayType(T.LongType()))]
    )
    rows = stored(docs.mapInArrow(_sign(table), schema), "minhash-rows")
    reps = stored(
        rows.where("key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("samples").alias("samples"), F.first("bands").alias("bands")
        ),
        "minhash-classes",
    )
    banded = reps.select("key", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").count().where("count > 1").select("bucket")
    live = stored(banded.join(shared, "bucket"), "minhash-buckets")
    members = stored(reps.join(live.select("key").distinct(), "key"), "minhash-members")
    texts = stored(_texts_of(docs, members), "minhash-texts")

    live = stored(live.join(members.select("key", "samples", "bands"), "key"), "minhash-live")
    found = None
    for most in (*PIVOTS, None):
        named = _open(live, found)
        if found is not None:
            named = stored(_linkable(named, texts, table, least, finer=most is None), "minhash-open")
        pairs = stored(_pairs(named, most, least), "minhash-pairs")
        if found is not None and pairs.isEmpty():
            break
        checked = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
        links = stored(checked.mapInArrow(_verify(table, least), "a string, b string"), "minhash-links")
        if found is None:
            found = stored(components(links), "minhash-components")
        elif not links.isEmpty():
            found = stored(joined(found, links), "minhash-components")
    names = (
        reps.select("key", "rep").join(found.toDF("key", "class_key"), "key")
        .groupBy("class_key").agg(F.min("rep").alias("class_id"))
    )
    names = found.toDF("key", "class_key").join(names, "class_key")
    classes = reps.select("key", "rep").join(names, "key", "left").select(
        "key", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("class_key", "key").alias("class_key")
    )
    return rows.select("doc_id", "key").join(classes, "key", "left").select(
        "doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key",
    )


def _open(live: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    if found is None:
        return live.withColumn("component", F.col("key"))
    named = live.join(found.toDF("key", "component"), "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )
    ends = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return named.join(ends.where("lo <> hi").select("bucket"), "bucket")


def _linkable(named: DataFrame, texts: DataFrame, table, least: float, finer: bool) -> DataFrame:
    """Members with their total weight and that of shingles which occur in another component (both 0 in buckets of
    FEW, where all pairs are few), without members whose share of the latter is too small for a link."""
    sizes = named.groupBy("bucket").agg(F.count("*").alias("size"))
    named = stored(named.join(sizes, "bucket"), "minhash-named")
    large, few = named.where(F.col("size") > FEW).drop("size"), named.where(F.col("size") <= FEW).drop("size")
    bounds = _bounds(large, texts, table).where(F.col("shared") >= least * F.col("total"))
    large = large.join(bounds, F.xxhash64("key") == F.col("name")).drop("name")
    few = few.withColumns({"total": F.lit(0.0), "shared": F.lit(0.0)})
    if finer:
        large = stored(large, "minhash-large")
        more = large.select("key").distinct().join(texts, "key").mapInArrow(_finer(table), "key string, finer array<int>")
        large = large.join(stored(more, "minhash-finer"), "key")
        few = few.withColumn("finer", F.lit(None).cast("array<int>"))
    return few.unionByName(large)


def _finer(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for part in text.chunks(texts):
                doc, own, count, _ = shingles(texts[part])
                have, samples = signatures(doc, own, count * table.value[_bucket(own)], range(_SAMPLES, _SAMPLES + FINER))
                ends = pa.array(np.arange(len(have) + 1) * FINER, pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(samples.view(np.int32).ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(have + part.start)), lists], ["key", "finer"])

    return run


def _bounds(named: DataFrame, texts: DataFrame, table) -> DataFrame:
    """name (64-bit hash of the key), total weight, and weight of the shingles in another component of the members that have some.

    Members that are read together give a common row for a shingle, with the lists of those that have it, so many near
    copies give little more rows than one. Only shingles of more than one component are dealt back to the members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, components_ = (c.to_numpy() for c in batch.columns[:2])
            texts = batch.column(2).to_pylist()
            for part in text.chunks(texts, text.CHUNK_BYTES // 8):
                doc, own, count, _ = shingles(texts[part])
                weight = (count * table.value[_bucket(own)]).astype(np.float32)
                total = np.bincount(doc, weight, part.stop - part.start)[doc]
                order = np.argsort(own)
                doc, own, weight, total = doc[order], own[order], weight[order], total[order]
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
                if not len(first):
                    continue
                component = components_[part][doc]
                lo, hi = (pa.array(f.reduceat(component, first)) for f in (np.minimum, np.maximum))
                ends = pa.array(np.append(first, len(own)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (names[part][doc], weight, total)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[first].view(np.int64)), lo, hi, *lists], ["shingle", "lo", "hi", "name", "weight", "total"])

    members = named.select("key", F.xxhash64("component").alias("component")).distinct().join(texts, "key")
    members = members.select(F.xxhash64("key").alias("name"), "component", "text")
    schema = "shingle long, lo long, hi long, name array<long>, weight array<float>, total array<double>"
    every = stored(members.mapInArrow(run, schema), "minhash-shingles")
    ends = every.groupBy("shingle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    common = ends.where("lo <> hi").select("shingle")
    shared = F.sum("weight") * (1 + 1e-6) + 1e-6  # above rounding
    dealt = every.join(common, "shingle").select(F.inline(F.arrays_zip("name", "weight", "total")))
    return dealt.groupBy("name").agg(F.first("total").alias("total"), shared.alias("shared"))


def _agreeing(x: str, y: str) -> Column:
    """How many samples of two columns are equal."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, a: s + a)


def _pairs(named: DataFrame, most: int | None, least: float) -> DataFrame:
    """Pairs (a < b) of classes to be compared as texts in this round, each once.

    `most` pivots of each bucket, chosen by hash, meet the members outside their component; None: all
    members outside the largest component of the bucket do, each pair in the first bucket that it shares.
    """
    if most:
        by = W.partitionBy("bucket").orderBy(F.xxhash64("bucket", "key"), "key")
        named = named.withColumn("asks", F.row_number().over(by) <= most)
    else:
        sizes = named.groupBy("bucket", "component").count()
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("count", "component"))["component"].alias("largest"))
        named = named.join(largest, "bucket").withColumn("asks", F.col("component") != F.col("largest"))
    asking = named.where("asks").select("bucket", *[F.col(c).alias(f"p_{c}") for c in named.columns if c != "bucket"])
    met = (F.col("component") != F.col("p_component")) & (~F.col("asks") | (F.col("key") < F.col("p_key")))
    if "total" in named.columns:  # the bound on the similarity, solved for the shared weight
        shared = F.least("shared", "p_shared") * (1 + 1 / least) * (1 + 1e-6) + 1e-6
        met &= shared >= F.col("total") + F.col("p_total")
    if not most:
        first = F.element_at(F.filter(F.zip_with("bands", "p_bands", lambda a, b: F.when(a == b, a)), lambda a: a.isNotNull()), 1)
        met &= first == F.col("bucket")
    same = _agreeing("samples", "p_samples")
    met &= same >= AGREE
    if "finer" in named.columns:
        met &= F.coalesce(same + _agreeing("finer", "p_finer") >= AGREE_FINER, F.lit(True))
    pairs = named.join(asking, "bucket").where(met)
    pairs = pairs.select(F.least("key", "p_key").alias("a"), F.greatest("key", "p_key").alias("b"))
    return pairs.distinct() if most else pairs


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, with one row of each class: that of its smallest doc_id.

    Among rows with that id the smallest digest stays; rows without words all stay.
    """
    judged = stored(_judged(docs, least), "minhash-judged")
    first = judged.where("key IS NOT NULL").groupBy("class_key").agg(F.min(F.struct("doc_id", "key")).alias("r"))
    kept = first.select("r.doc_id", "r.key").union(judged.where("key IS NULL").select("doc_id", "key"))
    twice = judged.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_txguard_twice"))
    kept = kept.select(F.col("doc_id").alias("_txguard_kept"), F.col("key").alias("_txguard_kept_key"))

    plain = kept.join(twice, F.col("_txguard_kept").eqNullSafe(F.col("_txguard_twice")), "left_anti")
    plain = docs.join(plain, docs["doc_id"].eqNullSafe(F.col("_txguard_kept")), "left_semi")
    other = docs.join(twice, docs["doc_id"].eqNullSafe(F.col("_txguard_twice")), "left_semi")

    def with_key(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.append_column("_txguard_key", pa.array(_keys(texts), pa.string()))

    schema = T.StructType([*docs.schema.fields, T.StructField("_txguard_key", T.StringType())])
    other = other.mapInArrow(with_key, schema)
    other = other.join(
        kept.distinct(),
        F.col("doc_id").eqNullSafe(F.col("_txguard_kept")) & F.col("_txguard_key").eqNullSafe(F.col("_txguard_kept_key")), "left_semi",
    )
    one = other.where("_txguard_key IS NOT NULL").dropDuplicates(["doc_id", "_txguard_key"])
    return plain.unionByName(one.union(other.where("_txguard_key IS NULL")).drop("_txguard_key"))
