from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import constants as C
from txguard import schemas
from txguard.functions import hashing


def customer_rows(df: DataFrame, status: str) -> DataFrame:
    """The customer columns plus `status`, one row per transaction."""
    return df.select(*C.CUSTOMER_COLUMNS, F.col(status).cast("string").alias("status"))


def deidentified(df: DataFrame) -> DataFrame:
    """Without the personal columns, and without the raw text of messages that could not be decoded."""
    return df.drop(*C.DROPPED_PII, schemas.CORRUPT_COLUMN)


def masked(df: DataFrame, salt: str) -> DataFrame:
    """Direct identifiers replaced: keyed digests to join on, last four digits to recognise.

    The salt is a secret of the caller. Without it the digest of a card number can be found by
    trying all numbers.
    """
    return df.withColumns(
        {
            "ssn": hashing.salted_sha256("ssn", salt),
            "card_token": hashing.salted_sha256("cc_num", salt),
            "cc_num": hashing.last4("cc_num"),
            "acct_num": hashing.last4("acct_num"),
            "first": F.mask("first"),
            "last": F.mask("last"),
        }
    )
