"""The pipeline against what each stage promises, on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from txguard.llm import decontam, language, minhash, secrets, sentences
from txguard.llm.queries import tokenizer_file  # noqa: F401
from txguard.plans.workspace import stored


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, sf), "test-pipeline")
        assert docs.columns == columns
        seen[name] = before, {r.doc_id: r.text for r in docs.collect()}
    before, after = seen["language"]
    assert before == after  # all test documents are prose
    before, after = seen["near duplicates"]
    original = spark.read.parquet(f"{sf}/documents.parquet")
    classes = {r.doc_id: r.class_id for r in minhash.near_duplicates(original).collect()}
    assert set(after) == set(classes.values()) and len(after) < len(before)
    before, after = seen["benchmark"]
    items = [set(_windows(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    known = set().union(*items)
    assert set(after) == {i for i, t in before.items() if not known & set(_windows(t))}
    before, after = seen["secrets"]
    assert set(before) == set(after)
    assert any(secrets.MARK in t for t in after.values()) == any(secrets.base_spans(t) for t in before.values())
    assert not any(secrets.base_spans(t) for t in after.values())
    assert all(after[i] == t for i, t in before.items() if not secrets.base_spans(t) and secrets.MARK not in after[i])


def _windows(t):
    import re

    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return [tuple(w[i : i + decontam.WINDOW]) for i in range(len(w) - decontam.WINDOW + 1)]


def test_run_and_registration(spark, sf):
    import __spark_entry__ as entry_point

    out = entry_point.queries()["pipeline"](spark, sf)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 0
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_with_edge_rows(spark, sf, edge_docs, no_docs):
    kept = edge_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, sf), "test-pipeline")
        assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 6, 7, 8, 9, 10}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf).collect() == []


def test_language_stage_without_labels_keeps_texts_with_a_letter(spark, sf, edge_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for frame in (docs, edge_docs):
        blank = frame.withColumn("lang", F.lit(None).cast("string"))
        kept = corpus_pipeline.known_language(spark, blank, sf)
        want = sorted(str(r.doc_id) for r in frame.collect() if any(c.isalpha() for c in r.text or ""))
        assert kept.columns == frame.columns and sorted(str(r.doc_id) for r in kept.collect()) == want


def test_language_stage_rejects_by_probability(docs, monkeypatch):
    assert language.accepted(docs).count() == docs.count()
    monkeypatch.setattr(language, "CHANCE", 4.1)
    assert language.accepted(docs).isEmpty()


FOREIGN = [
    "Привет как дела сегодня мы идем в лес чтобы собрать грибы и ягоды для нашей бабушки которая живет далеко " * 5,
    "Καλημέρα πώς είσαι σήμερα πηγαίνουμε στο δάσος για να μαζέψουμε μανιτάρια " * 5,
    "今天天气很好我们去公园散步吃饭看书学习中文" * 10,
    "नमस्ते आप कैसे हैं आज हम जंगल जा रहे हैं " * 8,
]


def test_language_stage_rejects_other_languages(spark, docs):
    """Clean documents stay, all of them; languages that no document is labelled with go."""
    other = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    kept = language.accepted(docs.unionByName(other, allowMissingColumns=True))
    assert kept.where("doc_id < 0").isEmpty() and kept.count() == docs.count()


def test_columns_of_any_name_stay(spark, sf, edge_docs):
    """Users' columns may be named as the stages' own helpers are."""
    names = ["_key", "_kept", "_kept_key", "_doc", "_removed", "_bad", "twice", "own", "hash", "range", "bucket", "bands"]
    frame = edge_docs.withColumns({n: F.lit(f"value of {n}") for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stored(stage(spark, frame, sf), "test-pipeline")
        assert frame.columns == edge_docs.columns + names
    frame = sentences.without_repeats(frame)
    assert {r[n] for r in frame.collect() for n in names} == {f"value of {n}" for n in names}
    assert not corpus_pipeline.packed(spark, frame, sf).isEmpty()
