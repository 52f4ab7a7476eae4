"""The given tables seen as card transactions and customers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard import schemas
from txguard.functions import time as T

# The first 80 % or so of the time span plays the history, the rest the stream.
STREAM_START = "2024-01-25 00:00:00"

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_transactions(events: DataFrame) -> DataFrame:
    """Every event as a transaction record, plus its time as `event_time`.

    A card's home lies on a 25-step grid. One event in eight happens at another grid point, the
    others near home.
    """
    user, event = F.col("user_id"), F.col("event_id")
    text = user.cast("string")
    home = user % 25
    away = F.when(event % 8 == 0, (user + 1 + event % 24) % 25).otherwise(home)
    columns = {
        "_c0": event.cast("string"),
        "ssn": text,
        "cc_num": text,
        "first": F.concat(F.lit("First"), text),
        "last": F.concat(F.lit("Last"), text),
        "gender": F.when(user % 2 == 0, "F").otherwise("M"),
        "street": F.concat(text, F.lit(" Main Street")),
        "city": F.concat(F.lit("City"), home.cast("string")),
        "state": F.concat(F.lit("S"), (user % 5).cast("string")),
        "zip": 10000 + user % 80000,
        "lat": -60 + home * 5,
        "long": -170 + home * 14,
        "city_pop": (1000 + home * 100).cast("string"),
        "job": F.concat(F.lit("Job"), (user % 10).cast("string")),
        "dob": F.concat((1950 + user % 50).cast("string"), F.lit("-01-01")),
        "acct_num": F.concat(F.lit("ACC"), text),
        "profile": F.concat(F.lit("profile"), (user % 3).cast("string")),
        "trans_num": event.cast("string"),
        "trans_date": F.substring(F.col("ts").cast("string"), 1, 10),
        "trans_time": F.substring(F.col("ts").cast("string"), 12, 8),
        "unix_time": T.seconds_of("ts").cast("string"),
        "category": F.col("event_type"),
        "amt": F.col("value") * 10,
        "is_fraud": F.when((event % 8 == 0) & (F.col("value") > 100), 1).otherwise(0),
        "merchant": F.concat(F.lit("M"), (event % 50).cast("string")),
        "merch_lat": -60 + away * 5 + (event % 100).cast("double") / 100,
        "merch_long": -170 + away * 14 + (event % 37).cast("double") / 100,
    }
    types = schemas.field_types(schemas.TRANSACTION)
    return events.select(
        *[columns[name].cast(kind).alias(name) for name, kind in types.items()],
        F.col("ts").alias("event_time"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return as_transactions(events.where(F.col("ts") < F.lit(STREAM_START).cast("timestamp_ntz")))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return as_transactions(events.where(F.col("ts") >= F.lit(STREAM_START).cast("timestamp_ntz")))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, straight from its file or files."""
    return (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(spark, sf_dir)
    return as_transactions(stream.where(F.col("ts") >= F.lit(STREAM_START).cast("timestamp_ntz")))


def with_defects(tx: DataFrame) -> DataFrame:
    """Transactions with the faults the quality checks look for, spread by transaction number."""
    n = F.col("trans_num").cast("bigint")
    return tx.withColumns(
        {
            "ssn": F.when(n % 50 != 0, F.col("ssn")),
            "cc_num": F.when(n % 70 != 0, F.col("cc_num")),
            "amt": F.when(n % 90 == 0, F.lit(0).cast("decimal(9,2)")).when(n % 60 != 0, F.col("amt")),
            "lat": F.when(n % 80 != 0, F.col("lat")),
            "trans_num": F.when(n % 100 == 1, (n - 1).cast("string")).when(
                n % 500 != 7, F.col("trans_num")
            ),
        }
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension: nation and region take the place of city and state."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("c_custkey").cast("string")
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            key.alias("ssn"),
            key.alias("cc_num"),
            F.col("c_name").alias("first"),
            F.col("c_mktsegment").alias("last"),
            F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.concat((1950 + F.col("c_custkey") % 50).cast("string"), F.lit("-01-01")).alias("dob"),
            F.concat(F.lit("ACC"), key).alias("acct_num"),
            F.when(F.col("c_acctbal") < 0, "FRAUD").otherwise("GENUINE").alias("status"),
        )
    )
