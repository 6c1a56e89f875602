"""Observations with category data, rates, validity and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import days_between, engagement_rates, has_valid_engagement, normalize_tags, tag_count
from snapmart.schemas import FLAGS, MEASURES


def join_categories(observations: DataFrame, categories: DataFrame) -> DataFrame:
    """Left join on the region-scoped category id; unknown ids keep NULL category columns.

    A broadcast hint on `categories` carries over; without one Spark's size statistics decide.
    """
    lookup = categories.select(
        "region_code", "category_id", "category_title", F.col("assignable").alias("category_assignable")
    )
    return observations.join(lookup, ["region_code", "category_id"], "left")


def int_enriched(observations: DataFrame, categories: DataFrame) -> DataFrame:
    """Staged observations enriched; rates are computed even where the validity flag is false."""
    rates = engagement_rates()
    return join_categories(observations, categories).select(
        "region_code",
        "video_id",
        "trending_date",
        "trending_date_parsed",
        "observation_key",
        "title",
        "channel_title",
        "category_id",
        "category_title",
        "category_assignable",
        "publish_time",
        days_between(F.col("publish_time"), F.col("trending_date_parsed")).alias("days_since_publish"),
        *MEASURES,
        *[rate.alias(name) for name, rate in rates.items()],
        *FLAGS,
        has_valid_engagement().alias("has_valid_engagement"),
        "tags_raw",
        normalize_tags(F.col("tags_raw")).alias("tags_normalized"),
        tag_count(F.col("tags_raw")).alias("tag_count"),
        "_source_file",
        "_loaded_at",
    )
