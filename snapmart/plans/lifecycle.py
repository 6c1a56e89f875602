"""Lifecycle of an item within a region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import days_between, surrogate_key
from snapmart.plans.items import item_aggregate
from snapmart.schemas import MEASURES


def lifecycle_of(items: DataFrame) -> DataFrame:
    """First and last date, observed days, latest and peak measures of each item."""
    published = F.col("first_publish_time")
    return items.select(
        "region_code",
        "video_id",
        surrogate_key("region_code", "video_id").alias("video_region_key"),
        "first_trending_date",
        "last_trending_date",
        "observed_trending_days",
        *[f"latest_{m}" for m in MEASURES],
        *[f"peak_{m}" for m in MEASURES],
        published.alias("publish_time"),
        days_between(published, F.col("first_trending_date")).alias("days_publish_to_first_trending"),
    )


def int_lifecycle(observations: DataFrame) -> DataFrame:
    """One row per (region_code, video_id) of staged observations."""
    return lifecycle_of(item_aggregate(observations))
