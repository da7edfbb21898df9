"""The date a run works for, and the stamps written into event serials."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Fixed value: the order of the serial stamp.
STAMP_FORMAT = "yyyyMMddHHmmss"
STAMP_FORMAT_12H = "yyyyMMddhhmmss"


@dataclass(frozen=True)
class Clock:
    """``as_of`` replaces the wall clock, so that a run can be repeated; None means now."""

    as_of: date | datetime | str | None = None
    legacy_12h: bool = False

    def now(self) -> Column:
        if self.as_of is None:
            return F.localtimestamp()
        return F.lit(str(self.as_of)).cast("timestamp_ntz")

    def day(self) -> Column:
        return self.now().cast("date")

    def stamp(self) -> Column:
        """Text of the present moment; a date alone gives its midnight."""
        return F.date_format(self.now(), STAMP_FORMAT_12H if self.legacy_12h else STAMP_FORMAT)


def as_clock(as_of: Clock | date | datetime | str | None) -> Clock:
    return as_of if isinstance(as_of, Clock) else Clock(as_of)


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")
