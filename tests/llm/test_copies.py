"""Near-duplicates of documents and vectors, and repeated passages, against plain versions."""

import itertools
import os
import re

import numpy as np
import pytest

from txguard.llm import minhash, sentences, text, vectors
from txguard.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_are_those_of_the_pattern():
    texts = ["Ab1 _x-Y é̈ÉZ\u00a0`{|}~\x7f日本", None, "", "-", "a" * 10_000 + " b", "\n\nx"]
    w = text.words(texts)
    assert [[x for x in w.text(a, b).decode().split(" ") if x] for a, b in zip(w.first[:-1], w.first[1:])] == [words(t) for t in texts]
    assert len(set(w.hashes().tolist())) == len({x for t in texts for x in words(t)})


def test_classes_equal_all_pairs(spark, docs):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    table = minhash.idf_table(docs)
    vectors_ = {r.doc_id: minhash._weigh(r.text, table) for r in docs.select("doc_id", "text").collect()}
    links = [
        (a, b) for a, b in itertools.combinations(sorted(vectors_), 2)
        if minhash.weighted_jaccard(vectors_[a], vectors_[b]) >= minhash.SIMILARITY
    ]
    assert links and got == roots(vectors_, links)


def test_family_of_near_copies(spark):
    """Many copies that differ in a word or two from each other, and some from others by too much."""
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        own = list(base)
        for j in random.choice(200, int(random.integers(0, 5)), replace=False):
            own[j] = f"x{i}y{j}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows + [(1000 + i, f"other text {i} " * 4) for i in range(30)], "doc_id long, text string")
    table = minhash.idf_table(docs)
    v = {r.doc_id: minhash._weigh(r.text, table) for r in docs.collect()}
    links = [(a, b) for a, b in itertools.combinations(sorted(v), 2) if minhash.weighted_jaccard(v[a], v[b]) >= 0.8]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == roots(v, links)


def test_samples_agree_as_often_as_the_weights_overlap():
    random = np.random.default_rng(1)
    own = text.splitmix(np.arange(400, dtype=np.uint64))
    a, b = random.uniform(1, 3, 400), random.uniform(1, 3, 400)
    a[:100], b[300:] = 1e-9, 1e-9
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    same = []
    for k in range(40):
        _, s = minhash.signatures(np.repeat([0, 1], 400), np.tile(text.splitmix(own + np.uint64(k)), 2), np.concatenate([a, b]))
        same.append((s[0] == s[1]).mean())
    assert abs(np.mean(same) - want) < 0.03


def test_edges_of_near_duplicates(edge_docs, no_docs):
    rows = [(r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(edge_docs).collect()]
    assert len(rows) == 13 and rows.count((2, 1, False)) == 2 and (1, 1, True) in rows
    assert {(3, 3, True), (4, 4, True), (5, 5, True), (7, 7, True)} <= set(rows)
    assert minhash.near_duplicates(no_docs).collect() == []
    kept = minhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 7, 8, 9, 10, None, None]))


def test_one_row_of_a_repeated_id_stays(spark):
    long = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, long), (1, long), (1, "else " * 9), (0, long)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:3]) for r in minhash.one_of_each(docs).collect()) == [(0, "one"), (1, "els")]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def plain_repeats(rows):
    seen, out = set(), {}
    for doc_id, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        parts = []
        for x in re.split(r"(?<=[.!?])(?=[ \t\r\n])|\n", low):
            w = WORD.findall(x)
            parts += [w[i : i + sentences.PIECE] for i in range(0, len(w), sentences.PIECE)]
        gone = set()
        for i in range(len(parts)):
            j, run = i, []
            while j < len(parts) and (j - i < sentences.SENTENCES or len(run) < sentences.WORDS):
                run += parts[j]
                j += 1
            if j - i < sentences.SENTENCES or len(run) < sentences.WORDS:
                continue
            if tuple(run) in seen:
                gone |= set(range(i, j))
            seen.add(tuple(run))
        out[doc_id] = (len(parts), sorted(gone))
    return out


def test_repeats_equal_a_plain_scan(docs):
    got = {r.doc_id: (r.n_sentences, r.removed) for r in sentences.repeats(docs).collect()}
    assert got == plain_repeats([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()])
    assert any(removed for _, removed in got.values())


def test_passage_in_the_middle(spark):
    passage = " ".join(f"Word{i} is number {i} of these." for i in range(12))
    docs = spark.createDataFrame(
        [(1, "First words here. " + passage + " Some end."), (2, "Quite another start it is! " + passage + " Other end, and more.")],
        "doc_id long, text string",
    )
    assert [r.removed for r in sentences.repeats(docs).orderBy("doc_id").collect()] == [[], list(range(1, 13))]
    texts = [r.text for r in sentences.without_repeats(docs).orderBy("doc_id").collect()]
    assert texts[0].endswith("Some end.") and texts[1] == "Quite another start it is! Other end, and more."


@pytest.mark.parametrize("every", [None, 45, 35])
def test_passages_that_begin_inside_sentences(spark, every):
    """Shared passages behind openings of any length, in sentences that are longer than a piece or never end."""
    random = np.random.default_rng(8)

    def fresh(n):
        return [f"v{x}" for x in random.integers(0, 1 << 60, n)]

    def stops(w):
        return [x + "." if every and i % every == every - 1 else x for i, x in enumerate(w)]

    rows, planted = [], {}
    for i in range(120):
        n = [51, 60, 80, 200][i % 4]
        shared = stops(fresh(n))
        for d in (2 * i, 2 * i + 1):
            rows.append((d, " ".join(stops(fresh(random.integers(0, 40))) + shared + stops(fresh(random.integers(0, 40))))))
        planted[2 * i + 1] = n, shared
    docs = spark.createDataFrame(rows + [(9999, " ".join(stops(fresh(300))))], "doc_id long, text string")
    left = {r.doc_id: r.text.split() for r in sentences.without_repeats(docs).collect()}
    before = {d: t.split() for d, t in rows}
    assert all(left[d] == before[d] for d in before if d not in planted) and len(left[9999]) == 300
    for d, (n, shared) in planted.items():
        gone = set(before[d]) - set(left[d])
        assert gone <= set(shared)
        assert len(gone) >= max(1, n - 2 * (sentences.WINDOW - 1) - 2 * (sentences.PIECE - 1)), (d, n, len(gone))


def test_edges_of_repeats(edge_docs, no_docs):
    found = sentences.without_repeats(edge_docs)
    assert found.columns == edge_docs.columns and found.count() == 13
    rows = {r.doc_id: r for r in sentences.repeats(edge_docs).collect()}
    assert rows[3].n_sentences == rows[4].n_sentences == rows[5].n_sentences == 0
    assert rows[7].n_sentences == 2500 and len(rows[7].removed) > 2400
    assert sentences.repeats(no_docs).collect() == [] and sentences.without_repeats(no_docs).collect() == []


def plain_vectors(rows):
    unit = {i: np.array(v, dtype=float) / np.linalg.norm(v) for i, v, label in rows if label is not None}
    label = {i: k for i, _, k in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sorted(unit), 2)
        if label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= vectors.SIMILARITY
    ]
    return links, roots(unit, links)


@pytest.mark.parametrize("n, lists", [(600, 4096), (60, 4096)])
def test_vectors_equal_all_pairs(spark, monkeypatch, n, lists):
    """With codes and several lists, and with too few vectors for codes."""
    monkeypatch.setattr(vectors, "LIST", 20)
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 32))
    rows = []
    for i in range(n):
        near = centres[random.integers(40)] + random.normal(size=32) * random.choice([0.05, 0.25, 1.0])
        rows.append((i, [float(x) for x in near.astype(np.float32)], int(i % 3)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    links, root = plain_vectors(rows)
    count = {i: 0 for i in got}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found, want = sum(r.n_links for r in got.values()), sum(count.values())
    assert want > 0 and 0.99 * want <= found <= want
    if found == want:
        assert {i: r.component_id for i, r in got.items()} == root
        assert all(r.kept == (r.component_id == i) for i, r in got.items())


@pytest.mark.parametrize("inner", [4, 8])
def test_all_pairs_in_hundreds_of_lists(spark, monkeypatch, inner):
    """Vectors that fill few of their dimensions: no pair is lost, also of different lists."""
    monkeypatch.setattr(vectors, "LIST", 8)
    random = np.random.default_rng(inner)
    v = (random.normal(size=(3000, inner)) @ random.normal(size=(inner, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()}
    unit = v.astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= vectors.SIMILARITY
    root = vectors.spanning(len(v), *np.nonzero(near))
    assert near.sum() > 3100
    assert got == {i: (int(near[i].sum()) - 1, int(root[i])) for i in range(len(v))}


def _few_dimensions(n, inner, size=64):
    random = np.random.default_rng(inner)
    return (random.normal(size=(n, inner)) @ random.normal(size=(inner, size))).astype(np.float32)


def test_pairs_of_groups_miss_and_repeat_nothing(spark, monkeypatch):
    """Groups that meet in several rounds: links within a group, between groups, within a list and between lists, and copies."""
    monkeypatch.setattr(vectors, "LIST", 40)
    monkeypatch.setattr(vectors, "LEAST_GROUP", 64 * 4 * 250, raising=False)
    monkeypatch.setattr(vectors, "GROUP", 64 * 4 * 250, raising=False)
    v = _few_dimensions(1500, 6)
    rows = [(i, x.tolist(), "ab"[i % 3 == 0]) for i, x in enumerate(v)] + [(5000 + i, v[i].tolist(), "ab"[i % 3 == 0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = (unit @ unit.T >= vectors.SIMILARITY) & (labels[:, None] == labels)
    root = ids[vectors.spanning(len(rows), *np.nonzero(near))]
    assert near.sum() > 2000
    assert got == {int(i): (int(near[k].sum()) - 1, int(root[k]), bool(root[k] == i)) for k, i in enumerate(ids)}


def test_vectors_are_written_about_once(spark, monkeypatch):
    """What near-duplicates of vectors keep on disk is one index, however many lists and groups the vectors meet in."""
    monkeypatch.setattr(vectors, "LIST", 40)
    monkeypatch.setattr(vectors, "LEAST_GROUP", 64 * 4 * 1000, raising=False)
    monkeypatch.setattr(vectors, "GROUP", 64 * 4 * 1000, raising=False)
    v = np.random.default_rng(5).normal(size=(5000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    paths, write = [], vectors.stored

    def watched(frame, purpose):
        found = write(frame, purpose)
        paths.extend(found.inputFiles())
        return found

    monkeypatch.setattr(vectors, "stored", watched)
    assert vectors.near_duplicates(df).where("n_links = 0 AND kept").count() == 5000
    assert sum(os.path.getsize(p.removeprefix("file://")) for p in paths) < 2 * v.nbytes


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 0.0], 1), (10, [1.0, None], 1), (11, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "'x' AS key")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect())
    assert got[0] == (0, 3, 1, False) and got[1] == (1, 3, 1, True)
    assert got[2] == got[3] == (2, 3, 1, False)
    assert got[4:] == [(i, 0, i, True) for i in range(3, 12)]
    assert vectors.near_duplicates(df.limit(0)).collect() == []


def test_bounds_join_back_only_shingles_of_several_components(spark):
    """Totals and shared weights as counted plainly; a member that shares nothing is not joined at all."""
    rows = [("a", "x", "one two three four five six"), ("b", "y", "one two three four five seven"), ("c", "z", "alone in all its words here"),
            ("d", "x", "one two three four five six eight")]
    frame = spark.createDataFrame(rows, "key string, component string, text string")
    table = spark.sparkContext.broadcast(minhash.idf_table(frame))
    found = minhash._bounds(frame.select("key", "component"), frame.select("key", "text"), table)
    names = {r.name: r.key for r in frame.selectExpr("key", "xxhash64(key) AS name").collect()}
    got = {names[r.name]: (r.total, r.shared) for r in found.collect()}
    weights = {k: dict(zip(*minhash._weigh(t, table.value))) for k, _, t in rows}
    where = {}
    for k, c, _ in rows:
        for s in weights[k]:
            where.setdefault(s, set()).add(c)
    want = {k: (sum(w.values()), sum(x for s, x in w.items() if len(where[s]) > 1)) for k, w in weights.items()}
    assert set(got) == {"a", "b", "d"} and want["c"][1] == 0
    assert all(got[k] == pytest.approx(want[k], rel=1e-5) for k in got)


def test_links_that_come_later_join_components(spark):
    from txguard.llm.components import joined

    first = [(1, 2), (2, 3), (5, 6), (8, 9), (20, 21)]
    later = [(3, 6), (9, 30), (30, 31), (40, 41), (21, 20)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    want = {(r.node, r.component) for r in components(frame(first + later)).collect()}
    got = joined(components(frame(first)), frame(later)).collect()
    assert len(got) == len(want) and {(r.node, r.component) for r in got} == want


def test_steps_of_components_leave_nothing_in_the_driver(spark):
    """Tables of many steps, each broadcast from the driver, fill its memory."""
    from helpers import executed

    from txguard.llm.components import _star

    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    for both in (True, False):
        assert "Broadcast" not in executed(_star(edges, both))


def test_bounds_of_near_copies_share_rows(spark, monkeypatch):
    """Forty copies that differ in their last word: a row for each shingle they share, not for each copy of it."""
    words_ = " ".join(f"w{i}" for i in range(100))
    frame = spark.createDataFrame(
        [(f"k{i}", f"c{i}", f"{words_} x{i}") for i in range(40)], "key string, component string, text string"
    ).coalesce(1)
    table, kept = spark.sparkContext.broadcast(minhash.idf_table(frame)), []
    monkeypatch.setattr(minhash, "stored", lambda df, purpose: kept.append(df) or df)
    found = minhash._bounds(frame.select("key", "component"), frame.select("key", "text"), table).collect()
    assert len(found) == 40 and all(0.9 * r.total < r.shared < r.total for r in found)
    assert kept[0].count() < 40 * 97 / 4
