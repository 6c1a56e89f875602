"""Date and timestamp parsing. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns end in \z: Java's $ would also match before a trailing newline.
_SHORT_DATE = r"^[0-9]{2}\.[0-9]{2}\.[0-9]{2}\z"
_STAMP_WITH_FRACTION = r"^ *[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\.[0-9]{1,6}Z\z"

# Two-digit years below the pivot belong to this century.
_CENTURY_PIVOT = "70"


def parse_trending_date(raw: Column) -> Column:
    """'YY.DD.MM' text to DATE; NULL for any other format or an impossible date."""
    year = F.substring(raw, 1, 2)
    century = F.when(year < _CENTURY_PIVOT, F.lit("20")).otherwise(F.lit("19"))
    iso = F.concat(century, year, F.lit("-"), F.substring(raw, 7, 2), F.lit("-"), F.substring(raw, 4, 2))
    return F.when(raw.rlike(_SHORT_DATE), iso.try_cast("date"))


def parse_publish_time(raw: Column) -> Column:
    """ISO text with a 1-6 digit fraction and a literal Z to TIMESTAMP_NTZ (UTC); anything else is NULL."""
    stamp = F.rtrim(F.trim(raw), F.lit("Z"))
    return F.when(raw.rlike(_STAMP_WITH_FRACTION), stamp.try_cast("timestamp_ntz"))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from `start` to `end` as BIGINT; NULL if either is NULL, negative if `end` is earlier."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
