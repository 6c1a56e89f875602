"""The item level: one aggregate over staging from which lifecycle, item dimension and channel mart are projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import engagement_rates, has_valid_engagement
from snapmart.schemas import FLAGS, MEASURES

ATTRIBUTES = ("title", "channel_title", "category_id", "publish_time", "thumbnail_link", "description", *FLAGS)


def _latest(measure: str) -> Column:
    # a missing measure must not win, so its date is masked
    dated = F.when(F.col(measure).isNotNull(), F.col("trending_date_parsed"))
    return F.max_by(measure, dated).alias(f"latest_{measure}")


def item_aggregate(observations: DataFrame) -> DataFrame:
    """One row per (region_code, video_id), in one shuffle with a map-side partial step.

    Observed days count dates, so gaps do not count. Staging leaves one row per item and raw date, and its date
    format has one spelling per date, so a plain count is the distinct count without its second shuffle.
    `latest` holds the attributes of the latest observation (after date and load time the raw date settles
    ties; it is unique within an item after dedup), `label` the channel title seen last, `best_rate` the highest
    engagement rate of a valid observation. Catalyst prunes what a projection does not use; without
    `latest` and `label` all buffers are fixed-width and it is a hash aggregate.
    """
    label = F.when(F.col("channel_title").isNotNull(), F.struct("trending_date_parsed", "channel_title"))
    rate = F.when(has_valid_engagement(), engagement_rates()["engagement_rate"])
    order = F.struct("trending_date_parsed", "_loaded_at", "trending_date")
    return observations.groupBy("video_id", "region_code").agg(
        F.min("trending_date_parsed").alias("first_trending_date"),
        F.max("trending_date_parsed").alias("last_trending_date"),
        F.count("trending_date_parsed").alias("observed_trending_days"),
        *[_latest(m) for m in MEASURES],
        *[F.max(m).alias(f"peak_{m}") for m in MEASURES],
        F.min("publish_time").alias("first_publish_time"),
        F.max(rate).alias("best_rate"),
        F.max(label).getField("channel_title").alias("label"),
        F.max_by(F.struct(*ATTRIBUTES), order).alias("latest"),
    )
