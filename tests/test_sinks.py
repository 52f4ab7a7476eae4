import os
from functools import partial

import pytest
from helpers import by, plan, tx_frame
from pyspark.sql import functions as F

from txguard import constants as C
from txguard import fixtures as fx
from txguard.operators import analytics
from txguard.sinks import catalog, tables
from txguard.sinks.customers import write_customers
from txguard.sources.customers import newest_customers


def scored(spark, statuses, month=1):
    rows = [{"trans_num": t, "ssn": t, "first": "Ann", "job": "x", "amt": "10"} for t in statuses]
    status = F.create_map(*[F.lit(x) for t, s in statuses.items() for x in (t, s)])
    return tx_frame(spark, rows).withColumns(
        {
            "year": F.lit(2024), "month": F.lit(month),
            "final_fraud_status": status[F.col("trans_num")],
            "alert_generated": status[F.col("trans_num")] == "FRAUD",
        }
    )


def test_empty_batches_write_nothing(spark, folder):
    none = scored(spark, {"a": "FRAUD"}).where("false")
    for write in (tables.write_scored, tables.write_deidentified, tables.write_alerts):
        write(none, 0, folder("t"))
    write_customers(none, 0, fmt="parquet", path=folder("t"))
    assert not os.path.exists(folder("t"))


def test_replayed_epoch_replaces_itself(spark, folder):
    write = partial(tables.write_scored, path=folder("s"))
    write(scored(spark, {"a": "FRAUD", "b": "GENUINE"}), 0)
    write(scored(spark, {"c": "GENUINE"}), 1)
    write(scored(spark, {"a": "GENUINE", "b": "GENUINE"}), 0)  # other class, fewer partitions
    back = spark.read.parquet(folder("s"))
    assert by(back, "trans_num", "final_fraud_status", "epoch_id") == {
        "a": ("GENUINE", 0), "b": ("GENUINE", 0), "c": ("GENUINE", 1)
    }
    assert back.where("processing_timestamp is null").isEmpty()


def test_deidentified_has_no_personal_columns(spark, folder):
    tables.write_deidentified(scored(spark, {"a": "FRAUD"}), 0, folder("d"))
    assert not set(C.DROPPED_PII) & set(spark.read.parquet(folder("d")).columns)


def test_alerts_only_raised_ones(spark, folder):
    batch = scored(spark, {"a": "FRAUD", "b": "GENUINE"})
    tables.write_alerts(batch, 0, folder("a"))
    tables.write_alerts(batch, 0, folder("a"))
    assert [r.trans_num for r in spark.read.parquet(folder("a")).collect()] == ["a"]


def test_customers_newest_epoch_wins(spark, folder):
    write = partial(write_customers, fmt="parquet", path=folder("c"))
    write(scored(spark, {"a": "FRAUD", "b": "GENUINE"}), 0)
    write(scored(spark, {"a": "GENUINE"}), 1)
    write(scored(spark, {"a": "GENUINE"}), 1)
    rows = spark.read.parquet(folder("c"))
    assert rows.columns == [*C.CUSTOMER_COLUMNS, "status", "epoch_id"] and rows.count() == 3
    assert by(newest_customers(rows), "ssn", "status") == {"a": "GENUINE", "b": "GENUINE"}


def test_compaction_keeps_rows_and_merges_files(spark, folder):
    for epoch in range(6):
        tables.write_scored(scored(spark, {f"t{epoch}": "GENUINE", f"u{epoch}": "FRAUD"}), epoch, folder("s"))
    tables.compact(spark, folder("s"), folder("m"))
    before, after = spark.read.parquet(folder("s")), spark.read.parquet(folder("m"))
    assert after.count() == before.count() == 12
    assert len(after.inputFiles()) < len(before.inputFiles())


def test_catalog_sees_later_epochs_and_prunes(spark, folder):
    write = partial(tables.write_scored, path=folder("s"))
    write(scored(spark, {"a": "FRAUD"}), 0)
    catalog.register(spark, "scored_test", folder("s"))
    catalog.refresh(spark, "scored_test")
    write(scored(spark, {"b": "GENUINE"}, month=2), 1)
    catalog.refresh(spark, "scored_test")
    assert spark.table("scored_test").count() == 2
    feb = spark.sql("SELECT trans_num FROM scored_test WHERE month = 2 AND final_fraud_status = 'GENUINE'")
    assert [r.trans_num for r in feb.collect()] == ["b"]
    filters = next(part for part in plan(feb).split("PartitionFilters: [")[1:])
    assert filters.startswith("isnotnull(month") and "final_fraud_status" in filters.split("]")[0]
    spark.sql("DROP TABLE scored_test")


def test_report_reads_only_its_partitions(spark, sf, folder):
    tx = fx.arrivals(spark, sf).withColumns(
        {"year": F.lit(2024), "month": F.lit(1), "final_fraud_status": F.lit("GENUINE")}
    )
    tables.write_scored(tx, 0, folder("s"))
    top = analytics.top_by_fraud_amount(spark.read.parquet(folder("s")), "cc_num")
    text = plan(top)
    assert "TakeOrderedAndProject" in text
    assert "final_fraud_status" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<cc_num:string,amt:decimal(9,2)>" in text


def test_jdbc_writer_gets_its_options(spark, monkeypatch):
    seen = {}

    class Writer:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def mode(self, m):
            seen["mode"] = m
            return self

        def save(self):
            seen["saved"] = True

    from pyspark.sql.classic.dataframe import DataFrame

    batch = scored(spark, {"a": "FRAUD"})
    monkeypatch.setattr(DataFrame, "write", property(lambda self: seen.update(columns=self.columns) or Writer()))
    write_customers(batch, 7, url="jdbc:x", dbtable="customer_details", connections=4)
    assert seen["format"] == "jdbc" and seen["mode"] == "append" and seen["numPartitions"] == 4
    assert seen["columns"] == [*C.CUSTOMER_COLUMNS, "status", "epoch_id"] and seen["saved"]


def test_unknown_table_format_fails(spark, folder):
    with pytest.raises(Exception, match="(?i)data source"):
        tables.write_scored(scored(spark, {"a": "FRAUD"}), 0, folder("x"), fmt="delta")


def test_empty_replay_clears_its_epoch(spark, folder):
    batch = scored(spark, {"a": "FRAUD", "b": "FRAUD"})
    for write, name in ((tables.write_alerts, "a"), (tables.write_scored, "s"), (tables.write_deidentified, "d")):
        write(batch, 0, folder(name))
        write(batch, 1, folder(name))
        write(batch.where("trans_num = 'a'"), 0, folder(name))
        write(batch.where("false"), 1, folder(name))
        assert [(r.trans_num, r.epoch_id) for r in spark.read.parquet(folder(name)).collect()] == [("a", 0)]
        write(batch.where("false"), 2, folder(name))  # nothing there to clear


def test_a_fraud_wins_within_an_epoch(spark):
    rows = [("a", "GENUINE", 1), ("a", "FRAUD", 1), ("a", "GENUINE", 1), ("b", "FRAUD", 0), ("b", "GENUINE", 1)]
    df = spark.createDataFrame(rows, "ssn string, status string, epoch_id bigint")
    assert by(newest_customers(df), "ssn", "status") == {"a": "FRAUD", "b": "GENUINE"}


def test_raw_messages_stay_out_of_the_deidentified_table(spark, folder):
    broken = scored(spark, {"a": "FRAUD"}).withColumn("_corrupt_record", F.lit('{"ssn":"123-45'))
    tables.write_deidentified(broken, 0, folder("d"))
    assert "_corrupt_record" not in spark.read.parquet(folder("d")).columns
    tables.write_bad_messages(broken, 0, folder("b"))
    assert [r.message for r in spark.read.parquet(folder("b")).collect()] == ['{"ssn":"123-45']
