"""Merkle manifests, fill-in-middle and byte pairs against plain versions."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txguard.llm import bpe, fim, merkle
from txguard.llm.queries import op13_byte_pairs, tokenizer_file


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest


def plain_leaf(row, change=0):
    out = ""
    for field in merkle.FIELDS:
        v = row[field]
        v = v + change if field == "n_chars" and v is not None else v
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def plain_tree(nodes):
    """Top of the tree and, for each node, its siblings from the bottom up as (before, after)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for a in range(0, len(nodes), 2):
            run = nodes[a : a + 2]
            for i in range(len(run)):
                for leaf in members[a + i]:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(sha("".join(run)))
            joined.append([x for m in members[a : a + 2] for x in m])
        nodes, members = above, joined
    return nodes[0], paths


def plain_manifest(rows):
    """(id, leaf, subroot, root, path) of each row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), r["doc_id"]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, out = [], []
    for g in order:
        found = sorted(groups[g], key=lambda x: x[:3])
        top, paths = plain_tree([x[2] for x in found])
        tops.append(top)
        out.append((found, top, paths))
    root, above = plain_tree(tops)
    return sorted(
        (str(x[3]), x[2], top, root, tuple(p + above[k]))
        for k, (found, top, paths) in enumerate(out) for x, p in zip(found, paths)
    )


def manifest_rows(frame):
    return sorted(
        (str(r["id"]), r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in frame.collect()
    )


def test_manifest_equals_a_plain_one(docs, edge_docs):
    for frame in (docs, edge_docs):
        rows = [r.asDict() for r in frame.collect()]
        assert manifest_rows(merkle.verified(frame)) == plain_manifest(rows)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2, 3], [16, 17], [15, 1, 33], [257]])
def test_trees_of_all_sizes(spark, sizes):
    rows = [(i, f"l{g}" if g else None, "s", 3, f"t{i}") for g, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string").repartition(5)
    assert manifest_rows(merkle.verified(frame)) == plain_manifest([r.asDict() for r in frame.collect()])


def test_manifest_finds_what_was_changed(edge_docs):
    changed = {"n_chars": F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    for r in merkle.verified(edge_docs, changed=changed).collect():
        tampered = r["id"] is not None and r["id"] % 2 == 0
        assert r.verified == (not tampered) and (r.folded_root == r.root) == r.verified
    assert merkle.verified(edge_docs.withColumn("n_chars", F.lit(None).cast("long")), changed=changed).where("NOT verified").isEmpty()


def test_manifest_of_other_columns_and_of_none(spark, edge_docs, no_docs):
    assert merkle.verified(no_docs).collect() == []
    other = merkle.verified(edge_docs, id_="n", group="source", fields=("n", "key", "lang_pred"))
    assert other.where("NOT verified").isEmpty() and other.count() == edge_docs.count()
    assert {r.subroot for r in other.collect()} != {r.root for r in other.collect()}


def test_one_language_may_hold_all(spark):
    """Places come from partitions and counts: no window or group over a language."""
    frame = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
        F.lit("t").alias("text"))
    found = merkle.placed(merkle.leaves(frame), ["id", "leaf"])
    assert [r.place for r in found.orderBy("id").collect()] == list(range(3000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "merkle-order" in plan  # windows see a row per partition


# Fill in middle


UNIT = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_fim_equals_a_plain_one(docs, edge_docs, no_docs):
    for frame in (docs, edge_docs, edge_docs.repartition(4)):
        rows = frame.select("doc_id", "text").collect()
        assert ordered(fim.transformed(frame).collect()) == ordered(plain_fim(r.doc_id, r.text) for r in rows)
    assert fim.transformed(no_docs).collect() == []


def test_fim_of_odd_texts(spark, monkeypatch):
    draw = random.Random(5)
    odd = ["<P", "S>", "<", "M>x", " ", "\t\n", " ", "é", "日本", "x" * 40_000, " " * 40_000, "<P>", "a", "b "]
    rows = [(i % 90, "".join(draw.choice(odd) for _ in range(draw.randint(0, 12)))) for i in range(300)]
    rows += rows[:50] + [(None, "same text of many rows")] * 400
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = fim.transformed(frame).collect()
    assert ordered(found) == ordered(plain_fim(*r) for r in rows)
    assert {r.form for r in found} == {"plain", "spm", "psm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\r\nab\x0b\x0c\x1c é日", max_size=30))
def test_units(text):
    ends = np.cumsum([0, *(len(u.encode()) for u in UNIT.findall(text))])[1:]
    assert fim.unit_ends(np.frombuffer(text.encode(), dtype=np.uint8)).tolist() == ends.tolist()


def test_pieces_are_bounded_and_in_order(spark):
    frame = spark.createDataFrame([(3, "word " * 50_000)], "doc_id long, text string")
    sizes = fim.pieces(frame).select(F.octet_length("piece").alias("n")).collect()
    assert len(sizes) > 10 and max(r.n for r in sizes) <= fim.CHUNK + 3
    rows = fim.outputs(frame).collect()
    text = "".join(r.text for r in rows)
    assert [r.place for r in rows] == list(range(len(rows)))
    assert sha(text) == fim.transformed(frame).collect()[0].output_sha256


def test_fim_shuffles_texts_once(docs):
    plan = fim.transformed(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 3


# Byte pairs


@pytest.fixture(scope="module")
def codec():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        return bpe.Codec(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def odd_texts():
    draw = random.Random(9)
    texts = ["", None, " ", "  \n\n x", "a" * 3000, "ab" * 2000 + " <|endoftext|><|endoftext|> x", "日本語" * 100, "'s 't 'RE we're I'll  ",
             "x\x1cy\x85\xa0z᠎", " " * 500 + "x", "퟿\r\n\r\nb", "é ́", "<|endoftext|>", "\U00010940a 1՘ "]
    texts += ["".join(draw.choice(" \n\t\rab'sé.1̀!T日") for _ in range(draw.randint(0, 40))) for _ in range(400)]
    return texts + ["".join(chr(draw.choice([draw.randrange(1, 128), draw.randrange(128, 0xD800), draw.randrange(0xE000, 0x33500)]))
                            for _ in range(200)) for _ in range(300)]


def test_bpe_equals_the_library(docs, codec, library):
    texts = [r.text for r in docs.limit(100).collect()] + odd_texts()
    for _ in range(2):  # new words, then known ones
        for t, ids in zip(texts, codec.encode(texts)):
            want = library.encode(t or "", add_special_tokens=False).ids
            assert ids.tolist() == want
            assert codec.decode(ids) == library.decode(want, skip_special_tokens=False) == (t or "")


def test_words_are_those_of_the_library(library):
    for i in range(0x40000):
        if not 0xD800 <= i < 0xE000:
            t = f"a{chr(i)}1{chr(i)}! {chr(i)}"
            assert [t[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(t)] == bpe.words_of(t)


def plain_merges(codec, word):
    """Merges the leftmost pair of the lowest rank until there is none."""
    ids = [int(codec.byte_id[b]) for b in word]
    while True:
        ranks = [codec.rank_of.get(a * codec.top + b, 1 << 60) for a, b in zip(ids, ids[1:])]
        if not ranks or min(ranks) == 1 << 60:
            return ids
        i = ranks.index(min(ranks))
        ids[i : i + 2] = [int(codec.merged[ranks[i]])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=1, max_size=70), st.text(alphabet="aehinrst ", min_size=1, max_size=200).map(str.encode)), max_size=40))
def test_trees_merge_as_a_plain_search(codec, words):
    want = [plain_merges(codec, w) for w in words]
    assert [x.tolist() for x in codec.merge(words)] == want
    assert [codec.merge_one(codec.byte_id[np.frombuffer(w, dtype=np.uint8)].tolist()) for w in words] == want


def test_long_words_take_n_log_n_steps(codec):
    word = ("abcdefghij" * 30_000).encode()
    assert codec.decode(codec.merge([word])[0].astype("<u4")) == word.decode()


def test_long_texts_in_parts_and_full_tables(codec, library, monkeypatch, docs):
    monkeypatch.setattr(bpe, "PART", 700)
    monkeypatch.setattr(bpe, "WORDS", 50)
    for r in docs.limit(30).collect():
        assert codec.encode([r.text])[0].tolist() == library.encode(r.text, add_special_tokens=False).ids


def test_bpe_frames(edge_docs, no_docs):
    path = tokenizer_file("byte_bpe_50k.json")
    found = bpe.encoded(edge_docs.withColumn("ids", F.lit("theirs")), path)
    assert found.columns == [c for c in edge_docs.columns if c != "text"] + ["ids"]
    back = bpe.decoded(found, path)
    own = edge_docs.select("doc_id", F.coalesce("text", F.lit("")), "key", "block").collect()
    assert ordered(back.select("doc_id", "text", "key", "block").collect()) == ordered(own)
    assert bpe.decoded(bpe.encoded(no_docs, path), path).collect() == []


def test_bpe_query_equals_the_library(spark, sf, docs, library):
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha(text))
    found = op13_byte_pairs(spark, sf)
    assert dict(found.dtypes)["n_tokens"] == "bigint"
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()} == want


def test_other_vocabularies_are_refused(tmp_path):
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        bpe.Codec(file.read())


def test_tampering_follows_crc32(spark, sf, docs):
    from txguard.llm.queries import op11_manifest

    rows = op11_manifest(spark, sf).collect()
    assert all(r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) for r in rows)
    assert any(not r.verified for r in rows) and len(rows) == docs.count()
