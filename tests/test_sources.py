import json
from decimal import Decimal

import pytest
from helpers import by, tx_frame

from txguard import schemas
from txguard.plans import workspace
from txguard.sinks import publish
from txguard.sources import customers, history, payload, stream


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def csv_line(**fields):
    return ",".join(str(fields.get(n, "")) for n in schemas.field_names(schemas.TRANSACTION))


def test_typed_csv_goes_by_position(spark, folder):
    names = schemas.field_names(schemas.TRANSACTION)
    header = ",".join(["", *[f"other_{n}" for n in names[1:]]])  # unnamed first, foreign names
    lines = [csv_line(_c0=0, cc_num="c", zip="01234", amt="12.345", lat="x"), csv_line(cc_num="d")]
    path = write(folder("h.csv"), "\n".join([header, *lines]) + "\n")
    df = history.read_history(spark, path)
    assert df.columns == names
    got = by(df, "cc_num", "_c0", "zip", "amt", "lat")
    assert got["c"][:2] == ("0", Decimal(1234)) and got["c"][3] is None
    assert got["d"] == (None, None, None, None)


def test_untyped_csv(spark, folder):
    path = write(folder("u.csv"), ",cc_num,amt,is_fraud\n0,a,1.5,0\n1,b,free,1\n2,c,,yes\n")
    raw = history.read_history_untyped(spark, path)
    assert raw.columns == ["_c0", "cc_num", "amt", "is_fraud"]
    assert {t for _, t in raw.dtypes} == {"string"}
    typed = history.typed(raw)
    assert typed.columns == [*schemas.field_names(schemas.TRANSACTION), "cast_failures"]
    got = by(typed, "cc_num", "amt", "is_fraud", "cast_failures", "zip")
    assert got["a"] == (Decimal("1.50"), 0, 0, None)
    assert got["b"] == (None, 1, 1, None) and got["c"] == (None, None, 1, None)


MESSAGES = {
    "plain": '{"cc_num":"c","amt":12.345,"zip":"01234"}',
    "quoted": '{"cc_num":"c","amt":"12.30","lat":"-12.5"}',
    "extra": '{"cc_num":"c","colour":"red"}',
    "missing": "{}",
    "huge": '{"cc_num":"c","amt":12345678901}',
    "broken": '{"cc_num":"c","am',
    "null": None,
}


def test_decode(spark):
    df = spark.createDataFrame(list(MESSAGES.items()), "key string, value string")
    binary = df.select(df.key, df.value.cast("binary").alias("value"))
    got = by(
        payload.decode(binary, keep=("key",)).withColumn("bad", payload.is_corrupt()),
        "key", "cc_num", "amt", "zip", "lat", "bad",
    )
    assert got["plain"] == ("c", Decimal("12.35"), Decimal(1234), None, False)
    assert got["quoted"][:4] == ("c", Decimal("12.30"), None, Decimal("-12.5"))
    assert got["extra"] == ("c", None, None, None, False)
    assert got["missing"] == (None, None, None, None, False)
    assert got["huge"][1] is None
    assert got["broken"] == (None, None, None, None, True)
    assert got["null"] == (None, None, None, None, False)


def test_encode_then_decode(spark):
    tx = tx_frame(spark, [{"trans_num": 1, "amt": "1.20", "zip": "00501"}, {"trans_num": 2}])
    back = payload.decode(payload.encode(tx, key="trans_num")).drop(schemas.CORRUPT_COLUMN)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, tx.collect()), key=str)


def test_topic_options():
    plain = stream.topic_options("host:1", "t")
    assert plain == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "maxOffsetsPerTrigger": "10000"
    }
    secured = stream.topic_options("h", "t", 5, jaas="login", min_partitions=64, extra={"x": "y"})
    assert secured["kafka.security.protocol"] == "SASL_SSL" and secured["minPartitions"] == "64"
    assert secured["kafka.sasl.mechanism"] == "PLAIN" and secured["x"] == "y"


def test_jdbc_options():
    one = customers.jdbc_options("jdbc:x", "customer_details", {"user": "u"})
    assert one == {"url": "jdbc:x", "dbtable": "customer_details", "user": "u"}
    many = customers.jdbc_options("jdbc:x", "t", {}, "id", (0, 10**9), 64)
    assert many["numPartitions"] == "64" and many["upperBound"] == str(10**9)
    with pytest.raises(ValueError):
        customers.jdbc_options("jdbc:x", "t", {}, "id")


def test_newest_customers(spark):
    rows = [("a", "FRAUD", 1), ("a", "GENUINE", 3), ("a", "GENUINE", 3), ("b", "FRAUD", 2)]
    df = spark.createDataFrame(rows, "ssn string, status string, epoch_id bigint")
    newest = customers.newest_customers(df)
    assert newest.columns == df.columns
    assert by(newest, "ssn", "status", "epoch_id") == {"a": ("GENUINE", 3), "b": ("FRAUD", 2)}


RECORDS = [{"key": "k1", "amt": 1.50, "cc_num": "a"}, {"amt": None, "cc_num": "b"}, {"key": "k3", "cc_num": "c"}]


def test_publish_lines_keeps_the_text(spark, folder):
    lines = [json.dumps(r) for r in RECORDS]
    path = write(folder("r.jsonl"), "\n".join([*lines, "", "  "]) + "\n")
    publish.publish(publish.messages_from_lines(spark, path), "parquet", folder("topic"))
    sent = by(spark.read.parquet(folder("topic")), "value", "key")
    assert set(sent) == set(lines)
    assert sent[lines[0]] == "k1" and sent[lines[2]] == "k3" and len(sent[lines[1]]) == 36


def test_publish_arrays(spark, folder):
    path = write(folder("r.json"), json.dumps(RECORDS, indent=1))
    rows = publish.messages_from_arrays(spark, path).collect()
    keys = {json.loads(r.value)["cc_num"]: r.key for r in rows}
    assert len(rows) == 3 and keys["a"] == "k1" and keys["c"] == "k3" and len(keys["b"]) == 36
    assert sorted((json.loads(r.value) for r in rows), key=lambda r: r["cc_num"]) == RECORDS


def test_publish_arrays_without_any_key(spark, folder):
    path = write(folder("n.json"), '[{"a": 1}, {"a": 2}]')
    rows = publish.messages_from_arrays(spark, path).collect()
    assert {r.value for r in rows} == {'{"a":1}', '{"a":2}'}
    assert len({r.key for r in rows}) == 2


def test_workspace_is_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_dir(spark, "x").startswith(root)
    assert workspace.new_dir(spark, "x") != workspace.new_dir(spark, "x")
