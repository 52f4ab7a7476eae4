"""Changing schemas, drift, and the sequential comparison of two arms."""

import math
import random

import pytest
from helpers import by, executed
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.operators import drift, metrics
from txguard.plans import models
from txguard.sources import evolution as ev


pytestmark = pytest.mark.usefixtures("spark")


def struct(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    "a, b, want",
    [("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("float", "double", "double"),
     ("decimal(5,2)", "decimal(9,4)", "decimal(9,4)"), ("decimal(9,2)", "int", "decimal(12,2)"), ("decimal(5,2)", "bigint", "decimal(21,2)"),
     ("date", "timestamp_ntz", "timestamp_ntz"), ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
     ("struct<x:int>", "struct<y:string,x:bigint>", "struct<x:bigint,y:string>"), ("string", "string", "string"), ("void", "int", "int")],
)
def test_wider(a, b, want):
    a, b, want = (struct(f"c {t}")[0].dataType for t in (a, b, want))
    assert ev.wider(a, b) == ev.wider(b, a) == want or {type(a)} == {T.StructType}
    assert ev.wider(a, b) == want


@pytest.mark.parametrize("a, b", [("int", "string"), ("bigint", "double"), ("decimal(38,0)", "decimal(38,10)"), ("array<int>", "int"), ("date", "timestamp")])
def test_what_would_lose_something_is_an_error(a, b):
    with pytest.raises(ev.SchemaConflict, match="c: "):
        ev.merged_schema([struct(f"c {a}"), struct(f"c {b}")])


def test_changes_field_by_field():
    old, new = struct("a int, b string, c double, gone int, old_name string"), struct("a bigint, b int, c float, name string, more date")
    found = {(c.field, c.kind) for c in ev.changes(old, new, {"old_name": "name"})}
    assert found == {("a", "widened"), ("b", "conflict"), ("c", "narrowed"), ("gone", "removed"), ("old_name", "renamed"), ("more", "added")}
    assert ev.changes(old, old) == []


def test_generations_read_as_one(spark, folder):
    spark.sql("SELECT 1 AS id, CAST(7 AS int) AS amt, struct(1 AS x) AS s, 'm' AS `a.b`").write.parquet(folder("0"))
    spark.sql("SELECT 2 AS id, 9000000000 AS amt, struct(5000000000 AS x, 'y' AS y) AS s, 'shop' AS shop").write.parquet(folder("1"))
    spark.sql("SELECT CAST(NULL AS int) AS id, CAST(NULL AS bigint) AS amt, CAST(NULL AS struct<x:int>) AS s").write.parquet(folder("2"))
    found = ev.read_generations(spark, [folder("0"), folder("1"), folder("2")], renames={"a.b": "shop"})
    assert found.schema.simpleString() == "struct<id:int,amt:bigint,s:struct<x:bigint,y:string>,shop:string>"
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted([(1, 7, (1, None), "m"), (2, 9_000_000_000, (5_000_000_000, "y"), "shop"), (None, None, None, None)], key=str)
    text = executed(found.where("amt > 8").select("id"))
    assert "PushedFilters: [IsNotNull(amt), GreaterThan(amt," in text and "ReadSchema: struct<id:int,amt:bigint>" in text
    with pytest.raises(ev.SchemaConflict):
        ev.evolved(spark.sql("SELECT 1 AS a, 2 AS b"), struct("b int"), {"a": "b"})
    narrowed = ev.evolved(spark.sql("SELECT 9000000000 AS amt UNION ALL SELECT 5"), struct("amt int, more string"))
    assert sorted(map(tuple, narrowed.collect()), key=str) == [(5, None), (None, None)]


def test_unknown_fields_stay_as_variants(spark, folder):
    messages = spark.createDataFrame(
        [('{"id":"1","amt":5,"device":{"os":"x","v":[1,2]},"ok":true}',), ('{"old":"2"}',), ('{"old":"3","id":"4","amt":"text"}',), ("broken",), (None,), ("{}",)],
        "value string",
    )
    found = ev.decode_open(messages, "id string, amt bigint", renames={"old": "id"})
    found.write.parquet(folder("v"))
    rows = spark.read.parquet(folder("v")).select(
        "id", "amt", F.col("_corrupt_record").isNotNull().alias("bad"), F.size("other_fields").alias("n"),
        F.expr("try_variant_get(other_fields['device'], '$.v[1]', 'int')").alias("v"), F.expr("try_variant_get(other_fields['ok'], '$', 'boolean')").alias("ok"),
    ).collect()
    got = sorted(map(tuple, rows), key=str)
    assert ("1", 5, False, 2, 2, True) in got and ("2", None, False, 0, None, None) in got
    assert sum(r[2] for r in got) == 2  # the broken one, and the amount that is no number
    assert len(got) == 6


# Drift


def test_sketches_add_up_and_are_near_the_exact_distance(spark):
    draw = random.Random(4)
    rows = [(i % 5, draw.gauss(0, 1) + (2 if i % 5 == 4 else 0), float(i % 7)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "day int, x double, y double").repartition(6).persist()
    past, live = df.where("day < 2"), df.where("day >= 2")
    reference = drift.sketch_state(past, ("x", "y"))
    parts = drift.sketch_state(live.where("x < 0"), ("x", "y"), ("day",)).unionByName(drift.sketch_state(live.where("x >= 0"), ("x", "y"), ("day",)))
    got = {(r.day, r.column): r for r in drift.drift_report(reference, drift.add_states(parts)).collect()}
    want = {(r.day, r.column): r for r in drift.exact_drift(past, live, ("x", "y"), ("day",)).collect()}
    assert set(got) == set(want) and len(got) == 6
    for key, r in want.items():
        assert got[key].n == r.n and got[key].distance == pytest.approx(r.distance, abs=0.03 if key[1] == "x" else 0.3)
        assert got[key].drifted == r.drifted == (key == (4, "x"))
    assert got[4, "x"].stability_index > 1 > 0.05 > got[2, "x"].stability_index


def test_drift_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, float("nan")), (1, 2.0)], "day int, x double")
    state = drift.sketch_state(df, ("x",), ("day",))
    assert state.first().n == 2
    empty = drift.sketch_state(df.where("false"), ("x",), ("day",))
    assert drift.drift_report(drift.sketch_state(df, ("x",)), empty).collect() == []
    assert not drift.drift_report(drift.sketch_state(df, ("x",)), state).first().drifted


def test_retraining_starts_by_drift_only(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(models, "retrain_and_promote", lambda *a: calls.append(a) or 7)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") + 900).cast("double").alias("z"))
    reference = drift.sketch_state(df, ("x",))
    moved = drift.sketch_state(df.select(F.col("z").alias("x")), ("x",))
    assert models.retrain_if_drifted(spark, df, reference, reference, "root", 14) is None and not calls
    assert models.retrain_if_drifted(spark, df, reference, moved, "root", 14) == 7 and len(calls) == 1


# Sequential test


def plain_p(n_a, h_a, n_b, h_b, effect):
    if not n_a or not n_b:
        return 1.0
    pooled = (h_a + h_b) / (n_a + n_b)
    v = pooled * (1 - pooled) * (1 / n_a + 1 / n_b)
    if v <= 0:
        return 1.0
    gain, t = h_b / n_b - h_a / n_a, effect**2
    return min(1.0, 1 / (math.sqrt(v / (v + t)) * math.exp(min(700, gain * gain * t / (2 * v * (v + t))))))


def test_sequential_test_by_hand(spark):
    draw = random.Random(8)
    looks = [(day, arm, 200, sum(draw.random() < rate for _ in range(200))) for day in range(12) for arm, rate in (("A", 0.5), ("B", 0.65))]
    looks += [(0, "A", 3, 1), (20, "A", 5, 5)]
    got = by(metrics.sequential_test(spark.createDataFrame(looks, "day int, arm string, n int, hits int"), "day", "n", "hits", effect=0.1), "day", "p_value", "decision")
    least = 1.0
    for day in [*range(12), 20]:
        so_far = [sum(x[k] for x in looks if x[0] <= day and x[1] == arm) for arm in "AB" for k in (2, 3)]
        least = min(least, plain_p(*so_far, 0.1))
        assert got[day] == (pytest.approx(least), "B" if least <= 0.05 else None)
    assert got[11][1] == "B"


def test_equal_arms_are_rarely_told_apart(spark):
    """Looking after every step, at most 5 % of comparisons of equal arms may ever decide (here 200 of them)."""
    draw = random.Random(1)
    looks = [(run, look, arm, 50, sum(draw.random() < 0.3 for _ in range(50))) for run in range(200) for look in range(20) for arm in "AB"]
    df = spark.createDataFrame(looks, "run int, look int, arm string, n int, hits int")
    found = metrics.sequential_test(df, "look", "n", "hits", by=("run",), effect=0.05)
    assert found.where("decision IS NOT NULL").select("run").distinct().count() <= 16
    one = spark.createDataFrame([(1, "A", 10, 5)], "look int, arm string, n int, hits int")
    assert metrics.sequential_test(one, "look", "n", "hits").first().p_value == 1.0
