"""Hour and day keys over UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_KEY = "yyyy-MM-dd-HH"
DAY_KEY = "yyyy-MM-dd"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_utc(iso: Column) -> Column:
    """``2023-05-02T07:11:05Z`` as UTC wall-clock time, other offsets converted; NULL when it does not parse."""
    moment = iso.try_cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment)
    return F.when(iso.rlike(r"T.*[+-]\d\d(:?\d\d)?$"), shifted).otherwise(iso.try_cast("timestamp_ntz"))


def iso_utc(ts: Column) -> Column:
    """Inverse of :func:`parse_utc`, to the second."""
    return F.date_format(ts, ISO_UTC)


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, HOUR_KEY)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, DAY_KEY)


def parse_hour_key(key: Column) -> Column:
    """Inverse of :func:`hour_key`; NULL when the key is malformed."""
    return F.try_to_timestamp(key, F.lit(HOUR_KEY)).cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")
