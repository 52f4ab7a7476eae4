"""Encoding, packing and token files: exact round trips."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from txguard.llm import packing, wavelet
from txguard.llm.queries import tokenizer_file
from txguard.llm.tokens import Encoder, Table

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


@pytest.mark.parametrize("name, spaces", FILES)
def test_pieces_give_the_ids_of_whole_texts(docs, name, spaces):
    whole = Tokenizer.from_file(tokenizer_file(name))
    whole.encode_special_tokens = True
    own = Encoder(tokenizer_file(name), spaces)
    draw = random.Random(3)
    texts = [r.text for r in docs.limit(60).collect()]
    texts += ["", None, " ", "a  b\n\n c \t", "it's we'll don't", "x\x1cy", "<|endoftext|> a", "e\u0301 \u0301", "\u2003x y\u3000z", "\ud7ff\r\n\r\nb"]
    texts += ["".join(draw.choice(" \n\t\rab'sé.1\u0300!T日") for _ in range(draw.randint(0, 30))) for _ in range(800)]
    for _ in range(2):
        got = own.encode(texts)
        assert [list(map(int, g)) for g in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name, spaces", FILES)
def test_pieces_of_any_length_and_case(name, spaces):
    whole = Tokenizer.from_file(tokenizer_file(name))
    whole.encode_special_tokens = True
    own = Encoder(tokenizer_file(name), spaces)
    draw = random.Random(5)
    words = ["H\u0331", "É", "E\u0301", "SIXTEENBYTESLONG", "sixteenbyteslong", "ÀÉsixteenbytes", "LONGER THANSIXTEENBYTES", "a" * 40, "ÿ×÷ß", "İI",
             "ΣΑΣ", "ПРИВЕТ", "привет", "中文", "</w>", "a</w>b", "abc.def", "abc!?x", "...", "don't", "1½", "\x00", "a\x00b", "ǅ", "\U0001d11e"]
    for _ in range(5):
        texts = ["".join(draw.choice(words) + draw.choice(["", " ", "\n", "  ", ". ", ",", "!"]) for _ in range(draw.randint(0, 12))) for _ in range(300)]
        got = own.encode(texts)
        assert [list(map(int, g)) for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_in_capitals_are_encoded_once():
    own = Encoder(tokenizer_file("word_bpe_49k.json"), False)
    asked = []
    add = own._add
    own._add = lambda new: asked.extend(new) or add(new)
    one, other = own.encode(["grüne häuser", "Grüne HÄUSER Häuser GRÜNE"])
    assert asked == ["grüne", "häuser"] and len(other) == 2 * len(one)


@pytest.mark.parametrize("name, spaces", FILES)
def test_known_pieces_take_little_memory(name, spaces):
    own = Encoder(tokenizer_file(name), spaces)
    words = [f" {'abcdefghij'[i % 10]}{i:06x}" for i in range(120_000)]
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for a in range(0, len(words), 1000):
        own.encode(["".join(words[a : a + 1000])])
    assert (tracemalloc.get_traced_memory()[0] - before) / len(words) < 100
    tracemalloc.stop()


def test_packing_leaves_no_pieces_in_a_reused_process(spark, docs):
    path = tokenizer_file("byte_bpe_50k.json")

    def known(batches):
        from txguard.llm import tokens

        for batch in batches:
            held = [e.known for (_, spaces), e in tokens._open.items() if spaces]
            yield pa.RecordBatch.from_arrays([pa.array([max(held, default=-1)], pa.int64())], ["n"])

    assert packing.packed(docs, path).count()
    left = spark.range(0, 64, 1, 8).mapInArrow(known, "n long").collect()
    assert 0 in {r.n for r in left} and max(r.n for r in left) == 0


def test_table_of_pieces_grows():
    draw = np.random.default_rng(3)
    low = draw.permutation(np.arange(200_000, dtype=np.uint64))
    high = low % np.uint64(3)
    table = Table()
    for part in np.array_split(np.arange(200_000), 7):
        assert (table.find(low[part], high[part]) == -1).all()
        table.add(low[part], high[part], part)
    assert (table.find(low, high) == np.arange(200_000)).all()
    assert (table.find(low, high + np.uint64(3)) == -1).all() and len(table.slots) >= 400_000


def padding(sizes):
    return sum(0 if s & (s - 1) == 0 else packing.LENGTH - s for s in sizes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0, 2, 16])), min_size=1, max_size=12))
def test_cuts_are_the_best(steps):
    places, penalties = [0], [0]
    for step, penalty in steps:
        places.append(places[-1] + step)
        penalties.append(penalty)
    length, powers = 12, {1, 2, 4, 8}

    def cost(a, b):
        n = places[b] - places[a]
        return (0 if n in powers else length - n) + penalties[b] + packing.OPENING if n <= length else float("inf")

    best = [0.0]
    for j in range(1, len(places)):
        best.append(min(best[i] + cost(i, j) for i in range(j)))
    chosen = [0, *packing.best_cuts(places, penalties, length)]
    assert chosen[-1] == len(places) - 1
    assert sum(cost(a, b) for a, b in zip(chosen, chosen[1:])) == best[-1]


def check_pieces(rows, texts):
    whole = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array(whole.encode(texts[doc_id] or "", add_special_tokens=False).ids + [packing.END], dtype="<u4")
        pieces.sort(key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
    return [sum(r.length for r in p) for p in by_sequence.values()]


def test_packing_keeps_each_id_once(docs):
    rows = packing.packed(docs, tokenizer_file("byte_bpe_50k.json")).collect()
    sizes = check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})
    assert padding(sizes) < 0.03 * sum(sizes)


def test_packing_does_not_follow_the_partitions(spark, docs):
    path = tokenizer_file("byte_bpe_50k.json")
    one = sorted(map(tuple, packing.packed(docs.repartition(7), path).collect()))
    assert one == sorted(map(tuple, packing.packed(docs.coalesce(1), path).collect()))


@pytest.mark.parametrize("expression", ["doc_id * 512", "doc_id + 70368744177664", "-doc_id * 1000003", "cast(null as bigint)",
                                        "concat('doc-', doc_id * 977)", "7"])
def test_packing_does_not_follow_the_kind_of_ids(docs, expression):
    """Little padding, whatever ids look like; all pieces there."""
    many = docs.limit(100).selectExpr(f"{expression} AS doc_id", "text", "'x' AS hash", "1 AS range")
    rows = packing.packed(many, tokenizer_file("byte_bpe_50k.json")).collect()
    sizes = {}
    for r in rows:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert max(sizes.values()) <= packing.LENGTH and padding(sizes.values()) < 0.02 * sum(sizes.values())
    whole = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    assert sum(sizes.values()) == sum(len(whole.encode(r.text).ids) + 1 for r in many.select("text").collect())


def test_ranges_of_packing_follow_from_the_rows(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANGE", 16)
    path = tokenizer_file("byte_bpe_50k.json")
    rows = packing.packed(docs, path).collect()
    assert len({r.sequence_id >> 36 for r in rows}) > 5
    assert sorted(map(tuple, rows)) == sorted(map(tuple, packing.packed(docs.repartition(7), path).collect()))
    check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})
    order = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in order] == sorted(r.doc_id for r in order)


def test_edges_of_packing(edge_docs, no_docs):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = packing.packed(edge_docs, path).collect()
    assert sum(r.doc_id == 3 for r in rows) == 1 and sum(r.doc_id == 2 and r.start == 0 for r in rows) == 2
    own = [r for r in rows if r.doc_id in (3, 4)]
    assert all((r.length, r.doc_tokens) == (1, 1) for r in own)
    assert sum(r.length for r in rows if r.doc_id == 7) == 30_002
    assert packing.packed(no_docs, path).collect() == []


@pytest.mark.parametrize("n", [0, 1, 63, 513, 70_000])
@pytest.mark.parametrize("top", [0, 1, 5, 49_407, 100_000])
def test_wavelet_matrix(n, top):
    draw = np.random.default_rng(n + top)
    tokens = (draw.integers(0, top + 1, n) // draw.integers(1, 9, n)).astype(np.uint32)
    sizes = [n // 3, n - n // 3]
    matrix = wavelet.WaveletMatrix(wavelet.build(tokens, np.array(sizes)))
    assert (matrix.tokens() == tokens).all() and matrix.sizes.tolist() == sizes
    for i in draw.integers(0, n, 8) if n else ():
        token = int(tokens[i])
        assert matrix.access(int(i)) == token
        a, b = sorted(draw.integers(0, n + 1, 2).tolist())
        assert matrix.count(token, a, b) == (tokens[a:b] == token).sum()
        places = np.flatnonzero(tokens == token)
        for k in {0, len(places) // 2, len(places) - 1}:
            assert matrix.occurrence(token, k) == places[k]
        with pytest.raises(IndexError):
            matrix.occurrence(token, len(places))
    assert matrix.count(200_000) == 0


@pytest.mark.parametrize("n", [0, 1, 8, 513, 70_000])
@pytest.mark.parametrize("top", [0, 1, 5, 49_407])
def test_many_questions_at_once(n, top):
    draw = np.random.default_rng(n + top)
    tokens = (draw.integers(0, top + 1, n) // draw.integers(1, 9, n)).astype(np.uint32)
    matrix = wavelet.WaveletMatrix(wavelet.build(tokens, np.array([n])))
    places = draw.integers(0, n, 200) if n else np.zeros(0, dtype=np.int64)
    assert (matrix.accesses(places) == tokens[places]).all()
    a = draw.integers(0, n + 1, 100)
    b = np.minimum(n, a + draw.integers(0, 50, 100))
    for token in {*tokens[:5].tolist(), 0, 1, 70_000}:
        assert (matrix.occurrences(token) == np.flatnonzero(tokens == token)).all()
        assert matrix.counts(token, a, b).tolist() == [int((tokens[x:y] == token).sum()) for x, y in zip(a, b)]


def test_questions_over_files(spark, docs, edge_docs, folder, monkeypatch):
    """Counts, occurrences and ranges over the written shards, against the plain ids."""
    whole = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    for name, frame in (("docs", docs), ("edges", edge_docs.where("doc_id IS NOT NULL AND doc_id <> 2"))):
        path = folder(name)
        wavelet.write_shards(frame.repartition(3), tokenizer_file("word_bpe_49k.json"), path)
        rows = sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())
        ids = [whole.encode(t or "", add_special_tokens=False).ids + [wavelet.END] for _, t in rows]
        flat = np.array([i for x in ids for i in x])
        doc = [(d, k) for (d, _), x in zip(rows, ids) for k in range(len(x))]
        asked = [wavelet.END, int(flat[0]), int(np.bincount(flat).argmax()), 49_000]
        assert {r.token: r.n for r in wavelet.count_tokens(spark, path, asked).collect()} == {t: int((flat == t).sum()) for t in asked}
        got = sorted((r.token, r.position, r.doc_id, r.offset) for r in wavelet.find_tokens(spark, path, asked).collect())
        assert got == sorted((t, int(p), *doc[p]) for t in set(asked) for p in np.flatnonzero(flat == t))
        for a, b in ((0, 7), (len(flat) // 2, len(flat) // 2 + 300), (len(flat) - 3, len(flat) + 10), (5, 5)):
            part = sorted((r.position, r.token) for r in wavelet.read_tokens(spark, path, a, b).collect())
            assert part == [(i, int(flat[i])) for i in range(a, min(b, len(flat)))]
        ends = {r.doc_id: r.n_end for r in wavelet.read_documents(spark, path).collect()}
        assert ends == {d: x.count(wavelet.END) for (d, _), x in zip(rows, ids)}


def stored_rows(spark, docs, path):
    wavelet.write_shards(docs, tokenizer_file("word_bpe_49k.json"), path)
    return wavelet.read_documents(spark, path).collect()


def test_token_files(spark, docs, folder, monkeypatch):
    rows = stored_rows(spark, docs, folder("shards"))
    whole = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    at = 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = np.array(whole.encode(texts[r.doc_id], add_special_tokens=False).ids + [wavelet.END], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_edges_of_token_files(spark, edge_docs, no_docs, folder):
    rows = stored_rows(spark, edge_docs, folder("edges"))
    assert len(rows) == 13
    by_start = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    ids = [r.doc_id for r in by_start if r.doc_id is not None]
    assert ids == sorted(ids) and [r.n_tokens for r in rows if r.doc_id == 4] == [1]
    assert stored_rows(spark, no_docs, folder("none")) == []
