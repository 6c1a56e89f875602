"""Daily observation fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import surrogate_key
from snapmart.schemas import FLAGS, MEASURES


def join_video_keys(enriched: DataFrame, videos: DataFrame) -> DataFrame:
    """Left join of the item dimension's key on (region_code, video_id): a shuffle of the whole input,
    in which AQE splits an item with very many rows."""
    keys = videos.select("video_id", "region_code", "video_key")
    return enriched.join(keys, ["video_id", "region_code"], "left")


def derived_video_key() -> Column:
    """The key that join would find. The item dimension has a row for every staged item and its key is a
    function of (region_code, video_id), so no lookup is needed; a NULL part never matches a join."""
    known = F.col("region_code").isNotNull() & F.col("video_id").isNotNull()
    return F.when(known, surrogate_key("region_code", "video_id"))


def fct_daily(
    enriched: DataFrame, regions: DataFrame, categories: DataFrame, videos: DataFrame | None = None
) -> DataFrame:
    """One row per observation with dimension keys; an unmatched dimension leaves its key NULL.

    With small region and category dimensions (broadcast by the caller) and no `videos`, the fact is
    computed without any shuffle. Pass `videos` if it was not built from the same staged observations.
    """
    region_keys = regions.select("region_code", "region_key")
    category_keys = categories.select("region_code", "category_id", "category_key")
    if videos is None:
        keyed = enriched.withColumn("video_key", derived_video_key())
    else:
        keyed = join_video_keys(enriched, videos)
    return (
        keyed.join(region_keys, "region_code", "left")
        .join(category_keys, ["region_code", "category_id"], "left")
        .select(
            "observation_key",
            "region_code",
            "video_id",
            F.col("trending_date_parsed").alias("trending_date"),
            "region_key",
            "video_key",
            "category_key",
            "title",
            "channel_title",
            "category_id",
            "publish_time",
            "days_since_publish",
            *MEASURES,
            "like_rate",
            "dislike_rate",
            "comment_rate",
            "engagement_rate",
            "has_valid_engagement",
            *FLAGS,
            "tags_raw",
            "tags_normalized",
            "tag_count",
        )
    )
