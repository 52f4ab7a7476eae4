from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.skew import lookup_join


def with_customer(
    tx: DataFrame, customers: DataFrame, how: str = "left", heavy: DataFrame | None = None
) -> DataFrame:
    """Adds the customer's columns on `ssn`, prefixed `customer_`. One row per ssn expected."""
    dim = customers.select(
        "ssn", *[F.col(c).alias(f"customer_{c}") for c in customers.columns if c != "ssn"]
    )
    return lookup_join(tx, dim, "ssn", how, heavy, spread="trans_num")
