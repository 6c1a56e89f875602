"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a hashed key, so keys agree with already published ones.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the text of the parts joined by '-'."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def observation_key() -> Column:
    """Key of one observation; the date part is the raw text, so unparseable dates keep distinct keys."""
    return surrogate_key("region_code", "video_id", "trending_date")
