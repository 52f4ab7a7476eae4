"""Record layouts, as DDL strings so that importing this module needs no session."""

from functools import cache

from pyspark.sql.types import StructType

# Field names, order and types of the transaction record.
TRANSACTION = """
    _c0 string, ssn string, cc_num string,
    first string, last string, gender string,
    street string, city string, state string,
    zip decimal(5,0), lat decimal(9,6), long decimal(9,6),
    city_pop string, job string, dob string, acct_num string, profile string,
    trans_num string, trans_date string, trans_time string, unix_time string,
    category string, amt decimal(9,2), is_fraud decimal(9,0),
    merchant string, merch_lat decimal(9,6), merch_long decimal(9,6)
"""

# Customer table.
CUSTOMER = """
    ssn string, cc_num string, first string, last string, gender string,
    city string, state string, dob string, acct_num string, status string
"""

CORRUPT_COLUMN = "_corrupt_record"


@cache
def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def field_names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


def field_types(ddl: str) -> dict[str, str]:
    """Type of each field, as text."""
    return {f.name: f.dataType.simpleString() for f in struct(ddl)}
