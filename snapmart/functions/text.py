"""Boolean and tag text normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings after trim and lower.
TRUE_TEXT = ("true", "t", "1")
FALSE_TEXT = ("false", "f", "0")
NO_TAGS_TEXT = "[none]"


def normalize_boolean(raw: Column) -> Column:
    """Three-valued: an unknown spelling becomes NULL rather than False."""
    word = F.lower(F.trim(raw))
    return F.when(word.isin(*TRUE_TEXT), True).when(word.isin(*FALSE_TEXT), False)


def _has_tags(raw: Column) -> Column:
    # NULL text makes this NULL, which F.when treats as not matched
    return ~F.lower(F.trim(raw)).isin("", NO_TAGS_TEXT)


def _clean_tags(raw: Column) -> Column:
    return F.regexp_replace(F.replace(raw, F.lit('"')), r"\|+", "|")


def normalize_tags(raw: Column) -> Column:
    """Quotes removed, runs of '|' collapsed; an outer '|' stays. NULL for blank or '[none]'."""
    return F.when(_has_tags(raw), _clean_tags(raw))


def tag_count(raw: Column) -> Column:
    """Separators in the normalized text plus one (a trailing '|' counts); 0 where there are no tags."""
    clean = _clean_tags(raw)
    separators = F.length(clean) - F.length(F.replace(clean, F.lit("|")))
    return F.when(_has_tags(raw), separators + 1).otherwise(0).cast("bigint")
