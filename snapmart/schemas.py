"""Fixed schemas, names and accepted values of the landing files and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The region allow-list. Regions are never discovered from the data.
REGIONS = ("CA", "DE", "FR", "GB", "IN", "JP", "KR", "MX", "RU", "US")

# Header of an observation file, in order.
OBSERVATION_HEADER = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)

MEASURES = ("views", "likes", "dislikes", "comment_count")
FLAGS = ("comments_disabled", "ratings_disabled", "video_error_or_removed")

# Fixed value: category id known to be absent from most regional category documents.
KNOWN_ORPHAN_CATEGORY = "29"

# Every landed field stays text; typing belongs to staging.
OBSERVATION_FILE = T.StructType([T.StructField(name, T.StringType()) for name in OBSERVATION_HEADER])

CATEGORY_FILE = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "snippet",
                            T.StructType(
                                [
                                    T.StructField("channelId", T.StringType()),
                                    T.StructField("title", T.StringType()),
                                    T.StructField("assignable", T.BooleanType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

REGION_SEED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("region_code", "region_name", "locale", "language_code")]
)

# The region seed.
REGION_SEED_ROWS = (
    ("CA", "Canada", "en_CA", "en"),
    ("DE", "Germany", "de_DE", "de"),
    ("FR", "France", "fr_FR", "fr"),
    ("GB", "United Kingdom", "en_GB", "en"),
    ("IN", "India", "en_IN", "en"),
    ("JP", "Japan", "ja_JP", "ja"),
    ("KR", "South Korea", "ko_KR", "ko"),
    ("MX", "Mexico", "es_MX", "es"),
    ("RU", "Russia", "ru_RU", "ru"),
    ("US", "United States", "en_US", "en"),
)
