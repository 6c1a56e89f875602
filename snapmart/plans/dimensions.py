"""Region, category and item dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapmart.functions import surrogate_key
from snapmart.plans.items import ATTRIBUTES, item_aggregate


def dim_region(seed: DataFrame) -> DataFrame:
    return seed.select(
        surrogate_key("region_code").alias("region_key"), "region_code", "region_name", "locale", "language_code"
    )


def dim_category(categories: DataFrame) -> DataFrame:
    """One row per (region_code, category_id)."""
    return categories.select(
        surrogate_key("region_code", "category_id").alias("category_key"),
        "region_code",
        "category_id",
        "category_title",
        "category_channel_id",
        "assignable",
    )


def video_of(items: DataFrame) -> DataFrame:
    """The attributes of each item's latest observation (no history)."""
    key = surrogate_key("region_code", "video_id").alias("video_key")
    return items.select(key, "region_code", "video_id", *[f"latest.{a}" for a in ATTRIBUTES])


def dim_video(observations: DataFrame) -> DataFrame:
    """One row per (region_code, video_id) of staged observations."""
    return video_of(item_aggregate(observations))
