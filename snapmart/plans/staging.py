"""Staging: typed, deduplicated observations and flat category rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions import normalize_boolean, observation_key, parse_publish_time, parse_trending_date
from snapmart.operators.relational import latest_of_repeated, latest_per_key
from snapmart.schemas import FLAGS, MEASURES, REGIONS

GRAIN = ("region_code", "video_id", "trending_date")

_RENAMED = {"publish_time": "publish_time_raw", "tags": "tags_raw", **{flag: f"{flag}_raw" for flag in FLAGS}}

# After the load time, ties between copies of a key are settled by the measures, then by every
# remaining column: a total order, so reruns and engines agree.
DEDUP_ORDER = (
    "_loaded_at",
    *MEASURES,
    "title",
    "channel_title",
    "category_id",
    "publish_time_raw",
    "tags_raw",
    "thumbnail_link",
    *(f"{flag}_raw" for flag in FLAGS),
    "description",
    "_source_file",
)


def source_observations(landed: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    """All allowed regions as one relation, 19 columns, measures strictly cast.

    The regions live in one table, so their union is one scan with an allow-list; the filter prunes
    partitions or row groups. A measure that is not an integer fails the job (ANSI cast).
    """
    texts = ("video_id", "trending_date", "title", "channel_title", "category_id", "publish_time", "tags")
    return landed.filter(F.col("_source_region").isin(*regions)).select(
        F.col("_source_region").alias("region_code"),
        *[F.col(c).cast("string").alias(_RENAMED.get(c, c)) for c in texts],
        *[F.col(c).cast("bigint").alias(c) for c in MEASURES],
        F.col("thumbnail_link").cast("string").alias("thumbnail_link"),
        *[F.col(flag).cast("string").alias(f"{flag}_raw") for flag in FLAGS],
        F.col("description").cast("string").alias("description"),
        F.col("_source_file").cast("string").alias("_source_file"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def deduplicate(source: DataFrame) -> DataFrame:
    """Latest load per grain key. The item id leads the key, so sorts settle most rows on its first bytes."""
    return latest_per_key(source, ("video_id", "trending_date", "region_code"), DEDUP_ORDER)


def deduplicate_table(source: DataFrame) -> DataFrame:
    """The same rows for a source that is cheap to read twice: only rows whose grain key may repeat are shuffled."""
    return latest_of_repeated(source, ("video_id", "trending_date", "region_code"), DEDUP_ORDER)


def stg_observations(landed: DataFrame, regions: Sequence[str] = REGIONS, table: bool = False) -> DataFrame:
    """One row per (region_code, video_id, trending_date); dates, times and flags typed, raw text kept.

    `table` says that `landed` is a written table, cheap to read twice.
    """
    source = source_observations(landed, regions)
    return type_observations(deduplicate_table(source) if table else deduplicate(source))


def type_observations(deduplicated: DataFrame) -> DataFrame:
    """Parse dates, times and flags and add the surrogate key."""
    return deduplicated.select(
        *GRAIN,
        parse_trending_date(F.col("trending_date")).alias("trending_date_parsed"),
        "title",
        "channel_title",
        "category_id",
        parse_publish_time(F.col("publish_time_raw")).alias("publish_time"),
        "publish_time_raw",
        "tags_raw",
        *MEASURES,
        "thumbnail_link",
        *[normalize_boolean(F.col(f"{flag}_raw")).alias(flag) for flag in FLAGS],
        *[f"{flag}_raw" for flag in FLAGS],
        "description",
        "_source_file",
        "_loaded_at",
        observation_key().alias("observation_key"),
    )


def stg_categories(landed: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    """Category rows of all allowed regions. Ids are region-scoped and never merged across regions."""
    return landed.filter(F.col("_source_region").isin(*regions)).select(
        F.col("_source_region").alias("region_code"),
        F.col("category_id").cast("string").alias("category_id"),
        "category_title",
        "category_channel_id",
        "assignable",
        "_source_file",
        "_loaded_at",
    )
