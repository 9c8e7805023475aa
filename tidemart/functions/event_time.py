"""Event time as text and as timestamp. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the wire and of the partition columns.
WIRE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_PATTERN = "yyyy-MM-dd"
HOUR_PATTERN = "HH"


def parse(ts: Column) -> Column:
    """Text to timestamp; NULL, not an error, where the text does not match."""
    return F.try_to_timestamp(ts, F.lit(WIRE_PATTERN))


def wire_text(time: Column) -> Column:
    return F.date_format(time, WIRE_PATTERN)


def day(time: Column) -> Column:
    return F.date_format(time, DAY_PATTERN)


def hour(time: Column) -> Column:
    return F.date_format(time, HOUR_PATTERN)
