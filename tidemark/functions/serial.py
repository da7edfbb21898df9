"""Reading the change stamp back out of an event serial."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NO_STAMP = -1


def last_segment(serial: Column) -> Column:
    """Text after the last '-'."""
    return F.substring_index(serial, "-", -1)


def legacy_stamp(serial: Column) -> Column:
    """The last segment read as one number, so a five-digit time sorts below any six-digit one."""
    return F.coalesce(last_segment(serial).try_cast("decimal(20,0)"), F.lit(NO_STAMP)).cast("decimal(20,0)")


def serial_stamp(serial: Column) -> Column:
    """Moment of the event as ``yyyyMMddHHmmss``, with the unpadded time of day padded to six digits.

    Segments of other lengths are read as one number; unreadable ones count as oldest.
    """
    segment = last_segment(serial)
    padded = F.concat(F.substring(segment, 1, 8), F.lpad(F.substring(segment, 9, 6), 6, "0"))
    text = F.when(F.length(segment).between(8, 14), padded).otherwise(segment)
    return F.coalesce(text.try_cast("decimal(20,0)"), F.lit(NO_STAMP)).cast("decimal(20,0)")
