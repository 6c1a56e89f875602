"""The profiler's own grammars, stricter or looser than staging's on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP_OPTIONAL_FRACTION = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z\z"

# The only spellings the profiler takes as boolean.
PROFILE_TRUE = ("True", "true", "TRUE")
PROFILE_FALSE = ("False", "false", "FALSE")


def profile_publish_time(raw: Column) -> Column:
    """ISO text with two-digit fields and a literal Z; the fraction may be missing."""
    return F.when(raw.rlike(_STAMP_OPTIONAL_FRACTION), F.rtrim(raw, F.lit("Z")).try_cast("timestamp_ntz"))


def profile_boolean(raw: Column) -> Column:
    return F.when(raw.isin(*PROFILE_TRUE), True).when(raw.isin(*PROFILE_FALSE), False)


def profile_integer(raw: Column) -> Column:
    """NULL for blank or non-integer text."""
    return raw.try_cast("bigint")
