from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(col, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 of a text value, the same in every run and every engine.

    Null goes to no bucket.
    """
    head = F.conv(F.substring(F.md5(F.col(col).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def salted_sha256(col, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.col(col)), 256)


def last4(col) -> Column:
    """Text with everything but the last four characters replaced by `*`."""
    c = F.col(col)
    hidden = F.greatest(F.length(c) - 4, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.lit(4)))
