"""Rates and the engagement validity flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when either side is NULL or the denominator is 0 (never 0 by default)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def engagement_rates() -> dict[str, Column]:
    """The four point-in-time rates over `views`. They do not look at the validity flag; marts filter on it."""
    views, likes, dislikes, comments = (F.col(c) for c in ("views", "likes", "dislikes", "comment_count"))
    return {
        "like_rate": safe_divide(likes, views),
        "dislike_rate": safe_divide(dislikes, views),
        "comment_rate": safe_divide(comments, views),
        "engagement_rate": safe_divide(likes + dislikes + comments, views),
    }


def has_valid_engagement() -> Column:
    """False for a removed item, disabled ratings, or views NULL/0. A NULL flag does not invalidate."""
    views = F.col("views")
    return (
        F.when(F.col("video_error_or_removed"), False)
        .when(F.col("ratings_disabled"), False)
        .when(views.isNull() | (views == 0), False)
        .otherwise(True)
    )
