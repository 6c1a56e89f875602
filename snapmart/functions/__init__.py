"""Column expressions. Every one is built from JVM-side functions, so Catalyst sees through all of them."""

from snapmart.functions.dates import days_between, parse_publish_time, parse_trending_date
from snapmart.functions.keys import observation_key, surrogate_key
from snapmart.functions.measures import engagement_rates, has_valid_engagement, safe_divide
from snapmart.functions.profile_grammar import profile_boolean, profile_integer, profile_publish_time
from snapmart.functions.text import normalize_boolean, normalize_tags, tag_count

__all__ = [
    "days_between",
    "engagement_rates",
    "has_valid_engagement",
    "normalize_boolean",
    "normalize_tags",
    "observation_key",
    "parse_publish_time",
    "parse_trending_date",
    "profile_boolean",
    "profile_integer",
    "profile_publish_time",
    "safe_divide",
    "surrogate_key",
    "tag_count",
]
