"""Text expressions with the blank, null and comma-separated-cell rules of the source database."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EMPTY_DATE = "1900-01-01"


def is_blank(c: Column) -> Column:
    """NULL, empty or only spaces; never NULL itself."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def is_blank_date(c: Column) -> Column:
    """NULL, or the date an empty text converts to in the source database."""
    return c.isNull() | (c.cast("date") == F.lit(EMPTY_DATE).cast("date"))


def concat_text(*parts: Column | str) -> Column:
    """Concatenation in which NULL counts as empty text; plain strings are literals."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def tokens(csv: Column) -> Column:
    """Trimmed tokens of a comma-separated cell; NULL stays NULL and '' is one empty token."""
    return F.transform(F.split(csv, ","), lambda token: F.trim(token))


def csv_contains(csv: Column, value: Column) -> Column:
    """Whether some trimmed token equals ``value``; False when either side is NULL."""
    return F.coalesce(F.array_contains(tokens(csv), value), F.lit(False))


def csv_size(csv: Column) -> Column:
    """Number of tokens; 0 for NULL and 1 for ''."""
    return F.when(csv.isNull(), F.lit(0)).otherwise(F.size(F.split(csv, ",")))


def squeeze(c: Column, characters: str = " ,") -> Column:
    """Trimmed text without any of ``characters``."""
    return F.translate(F.trim(c), characters, "")


def without_spaces(c: Column) -> Column:
    return F.translate(c, " ", "")


def text_has(c: Column, *needles: str) -> Column:
    """Whether the text contains any of the needles, taken literally."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(c, F.lit(needle))
    return found


def parse_number(c: Column) -> Column:
    """Number held as text, with grouping commas allowed; NULL when unreadable or not a number."""
    value = F.translate(c.cast("string"), ",", "").try_cast("double")
    return F.when(~F.isnan(value), value)


def scrub_sentinel(c: Column, sentinel: str = "NaN") -> Column:
    """The text sentinel becomes NULL."""
    return F.when(c == sentinel, F.lit(None)).otherwise(c)
