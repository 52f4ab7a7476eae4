"""Every registered corpus query with SQL gives the rows of its SQL; all give one row where the contract says so."""

import pytest
from compare import differences

import __spark_entry__ as entry_point
from txguard.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, duck, sf, name):
    assert differences(QUERIES[name](spark, sf), duck, ORACLE[name]) == ""


def test_all_are_registered():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize(
    "name, table, id_",
    [("op1_near_duplicates", "documents", "doc_id"), ("op4_near_vectors", "embeddings", "vec_id"),
     ("op5_secrets", "documents", "doc_id"), ("op7_url_filter", "pages", "page_id"), ("op9_language", "documents", "doc_id"),
     ("op13_byte_pairs", "documents", "doc_id")],
)
def test_one_row_each(spark, sf, name, table, id_):
    want = sorted(r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(id_).collect())
    assert sorted(r[0] for r in QUERIES[name](spark, sf).select(id_).collect()) == want
