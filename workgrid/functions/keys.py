"""Key and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite_id(*cols) -> Column:
    """Plain concatenation, no separator, NULL if any part is NULL (SQL ``||``)."""
    return F.concat(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def content_hash(cols) -> Column:
    """Aggregate over rows: an order-free checksum of the named columns (sum of 32 md5 bits per row)."""
    bits = F.conv(F.substring(row_hash(cols), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.sum(bits), F.lit(0).cast("bigint"))


def row_hash(cols) -> Column:
    """md5 of all values joined with ``|``; NULL is written as ``NULL``.

    Column order is the source's ordinal order. Values are rendered with
    Spark's string cast.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))
