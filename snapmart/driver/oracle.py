"""SQL for DuckDB that gives, on the same tables, what each registered query must return.

Written from the definitions, not from the Spark plans: windows where Spark aggregates, `strptime`
where Spark casts, joins where Spark folds. Dates and timestamps leave as text and doubles rounded to
six places, as in `registry.py`, so both engines print equal values.
"""

from __future__ import annotations

import re

from snapmart.operators.quality import DECLARED, TableChecks

# name -> SELECT over driver tables and earlier entries
CTES: dict[str, str] = {}

CTES["landed"] = """
SELECT 'p' || l_partkey AS video_id,
       CASE WHEN l_tax = 0.08 THEN 'bad' ELSE strftime(l_shipdate, '%y.%d.%m') END AS trending_date,
       p_name AS title, s_name AS channel_title,
       CASE WHEN p_brand = 'Brand#55' THEN '29' ELSE p_brand END AS category_id,
       CASE WHEN l_linenumber = 7 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
            WHEN l_linenumber = 6 THEN ''
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') END AS publish_time,
       CASE l_linenumber % 5 WHEN 1 THEN '' WHEN 2 THEN ' [None] '
            WHEN 3 THEN '"' || p_type || '"||"b"' WHEN 4 THEN p_brand || '|b|' END AS tags,
       CASE WHEN l_tax = 0 THEN '0' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS views,
       CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS likes,
       CAST(l_linenumber AS VARCHAR) AS dislikes,
       CASE WHEN l_linenumber <> 6 THEN CAST(CAST(floor(l_quantity / 2) AS BIGINT) AS VARCHAR) END AS comment_count,
       'http://x/' || l_partkey AS thumbnail_link,
       CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'N' THEN ' f ' ELSE 'maybe' END AS comments_disabled,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'TRUE' ELSE 'False' END AS ratings_disabled,
       CASE WHEN l_quantity = 50 THEN '1' ELSE '0' END AS video_error_or_removed,
       CASE WHEN l_partkey % 2 = 1 THEN 'about ' || p_type END AS description,
       r_name AS _source_region, r_name || 'videos.csv' AS _source_file, o_orderdate AS _loaded_at,
       CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS x_comments,
       l_returnflag || l_linestatus = 'RF' AS x_ratings, l_quantity = 50 AS x_error,
       l_quantity <> 50 AND l_returnflag || l_linestatus <> 'RF' AND l_tax > 0 AND l_extendedprice >= 1 AS x_valid
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     JOIN orders ON l_orderkey = o_orderkey"""

_PROJECTION = """SELECT _source_region AS region_code, video_id, trending_date, title, channel_title, category_id,
       publish_time AS publish_time_raw, tags AS tags_raw, CAST(views AS BIGINT) AS views,
       CAST(likes AS BIGINT) AS likes, CAST(dislikes AS BIGINT) AS dislikes,
       CAST(comment_count AS BIGINT) AS comment_count, thumbnail_link,
       comments_disabled AS comments_disabled_raw, ratings_disabled AS ratings_disabled_raw,
       video_error_or_removed AS video_error_or_removed_raw, description, _source_file, _loaded_at{extra}
FROM landed"""

_EXTRA = ", x_comments, x_ratings, x_error, x_valid"
CTES["source"] = _PROJECTION.format(extra="")
CTES["marked"] = _PROJECTION.format(extra=_EXTRA)

CTES["united"] = "\nUNION ALL\n".join(
    f"{_PROJECTION.format(extra='')} WHERE _source_region = '{r}'" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
)

CTES["deduped"] = """
SELECT * FROM marked
QUALIFY row_number() OVER (
    PARTITION BY region_code, video_id, trending_date
    ORDER BY _loaded_at DESC NULLS LAST, views DESC NULLS LAST, likes DESC NULLS LAST, dislikes DESC NULLS LAST,
             comment_count DESC NULLS LAST, title DESC NULLS LAST, channel_title DESC NULLS LAST,
             category_id DESC NULLS LAST, publish_time_raw DESC NULLS LAST, tags_raw DESC NULLS LAST,
             thumbnail_link DESC NULLS LAST, comments_disabled_raw DESC NULLS LAST,
             ratings_disabled_raw DESC NULLS LAST, video_error_or_removed_raw DESC NULLS LAST,
             description DESC NULLS LAST, _source_file DESC NULLS LAST) = 1"""


def _date(raw: str) -> str:
    century = f"CASE WHEN CAST(substr({raw}, 1, 2) AS INTEGER) < 70 THEN '20' ELSE '19' END"
    return (
        f"CASE WHEN regexp_full_match({raw}, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{2}}') THEN "
        f"CAST(try_strptime({century} || {raw}, '%Y.%d.%m') AS DATE) END"
    )


def _key(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return f"md5({' || $$-$$ || '.join(parts)})"


def _rate(numerator: str) -> str:
    return f"CASE WHEN views <> 0 THEN CAST({numerator} AS DOUBLE) / CAST(views AS DOUBLE) END"


_PUBLISHED = "try_strptime(publish_time_raw, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _typed(relation: str) -> str:
    return f"""
SELECT region_code, video_id, trending_date, {_date("trending_date")} AS trending_date_parsed, title, channel_title,
       category_id, CAST({_PUBLISHED} AS TIMESTAMP) AS publish_time, publish_time_raw, tags_raw,
       views, likes, dislikes, comment_count, thumbnail_link, x_comments AS comments_disabled,
       x_ratings AS ratings_disabled, x_error AS video_error_or_removed, comments_disabled_raw,
       ratings_disabled_raw, video_error_or_removed_raw, description, _source_file, _loaded_at,
       {_key("region_code", "video_id", "trending_date")} AS observation_key, x_valid
FROM {relation}"""


CTES["typed"] = _typed("deduped")
CTES["stg"] = "SELECT * EXCLUDE (x_valid) FROM typed"
CTES["undeduped"] = _typed("marked")

CTES["cat"] = """
SELECT r_name AS region_code, p_brand AS category_id, 'Group ' || substr(p_brand, 7, 1) AS category_title,
       'ch-' || p_brand AS category_channel_id,
       CASE WHEN right(p_brand, 1) <> '5' THEN right(p_brand, 1) = '2' END AS assignable,
       r_name || '_category_id.json' AS _source_file, TIMESTAMP '2020-01-01 00:00:00' AS _loaded_at
FROM region, (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN ('Brand#25', 'Brand#55')) AS brands"""

_NO_TAGS = "tags_raw IS NULL OR trim(tags_raw) = '' OR lower(trim(tags_raw)) = '[none]'"
_TAGS = "regexp_replace(regexp_replace(tags_raw, '\"', '', 'g'), '[|]+', '|', 'g')"
_TAG_COUNT = f"CAST(CASE WHEN {_NO_TAGS} THEN 0 ELSE len(string_split({_TAGS}, '|')) END AS BIGINT)"


def _enriched(relation: str) -> str:
    return f"""
SELECT o.region_code, video_id, trending_date, trending_date_parsed, observation_key, title, channel_title,
       o.category_id, c.category_title, c.assignable AS category_assignable, publish_time,
       date_diff('day', CAST(publish_time AS DATE), trending_date_parsed) AS days_since_publish,
       views, likes, dislikes, comment_count, {_rate("likes")} AS like_rate, {_rate("dislikes")} AS dislike_rate,
       {_rate("comment_count")} AS comment_rate, {_rate("(likes + dislikes + comment_count)")} AS engagement_rate,
       comments_disabled, ratings_disabled, video_error_or_removed, x_valid AS has_valid_engagement, tags_raw,
       CASE WHEN {_NO_TAGS} THEN NULL ELSE {_TAGS} END AS tags_normalized, {_TAG_COUNT} AS tag_count,
       o._source_file, o._loaded_at
FROM {relation} o LEFT JOIN cat c ON o.region_code = c.region_code AND o.category_id = c.category_id"""


CTES["enriched"] = _enriched("typed")
CTES["enriched_undeduped"] = _enriched("undeduped")

CTES["life"] = f"""
SELECT region_code, video_id, {_key("region_code", "video_id")} AS video_region_key,
       min(trending_date_parsed) AS first_trending_date, max(trending_date_parsed) AS last_trending_date,
       count(DISTINCT trending_date_parsed) AS observed_trending_days,
       max_by(views, trending_date_parsed) FILTER (views IS NOT NULL) AS latest_views,
       max_by(likes, trending_date_parsed) FILTER (likes IS NOT NULL) AS latest_likes,
       max_by(dislikes, trending_date_parsed) FILTER (dislikes IS NOT NULL) AS latest_dislikes,
       max_by(comment_count, trending_date_parsed) FILTER (comment_count IS NOT NULL) AS latest_comment_count,
       max(views) AS peak_views, max(likes) AS peak_likes, max(dislikes) AS peak_dislikes,
       max(comment_count) AS peak_comment_count, min(publish_time) AS publish_time,
       date_diff('day', CAST(min(publish_time) AS DATE), min(trending_date_parsed)) AS days_publish_to_first_trending
FROM stg GROUP BY region_code, video_id"""

CTES["dregion"] = f"""
SELECT {_key("r_name")} AS region_key, r_name AS region_code,
       array_to_string(list_transform(string_split(r_name, ' '),
                       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS region_name,
       'l_' || r_regionkey AS locale, lower(substr(r_name, 1, 2)) AS language_code
FROM region"""

CTES["dcat"] = f"""
SELECT {_key("region_code", "category_id")} AS category_key, region_code, category_id, category_title,
       category_channel_id, assignable
FROM cat"""

CTES["latest"] = """
SELECT * FROM stg
QUALIFY row_number() OVER (PARTITION BY region_code, video_id
    ORDER BY trending_date_parsed DESC NULLS LAST, _loaded_at DESC NULLS LAST, trending_date DESC NULLS LAST) = 1"""

CTES["dvideo"] = f"""
SELECT {_key("region_code", "video_id")} AS video_key, region_code, video_id, title, channel_title, category_id,
       publish_time, thumbnail_link, description, comments_disabled, ratings_disabled, video_error_or_removed
FROM latest"""


def _fact(relation: str) -> str:
    """Keys are functions of a line's own columns; brands 25 and 55 have no category row."""
    return f"""
SELECT observation_key, region_code, video_id, trending_date_parsed AS trending_date,
       {_key("region_code")} AS region_key, {_key("region_code", "video_id")} AS video_key,
       CASE WHEN category_id NOT IN ('Brand#25', '29') THEN {_key("region_code", "category_id")} END AS category_key,
       title, channel_title, category_id, publish_time, days_since_publish, views, likes, dislikes, comment_count,
       like_rate, dislike_rate, comment_rate, engagement_rate, has_valid_engagement, comments_disabled,
       ratings_disabled, video_error_or_removed, tags_raw, tags_normalized, tag_count
FROM {relation}"""


CTES["fact"] = _fact("enriched")
CTES["fact_undeduped"] = _fact("enriched_undeduped")

CTES["best_rate"] = """
SELECT region_code, video_id, max(engagement_rate) FILTER (has_valid_engagement) AS latest_engagement_rate
FROM fact GROUP BY region_code, video_id"""

CTES["item_label"] = """
SELECT region_code, video_id, channel_title FROM fact WHERE channel_title IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY region_code, video_id
    ORDER BY trending_date DESC NULLS LAST, channel_title DESC) = 1"""

CTES["labelled_item"] = """
SELECT region_code, video_id, channel_title, latest_engagement_rate, latest_views, peak_views, observed_trending_days
FROM life JOIN best_rate USING (region_code, video_id) LEFT JOIN item_label USING (region_code, video_id)"""

CTES["part_item"] = """
SELECT ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][p_size % 5 + 1] AS _source_region,
       'part' || p_partkey || '.json' AS _source_file, pos, id, title, 'ch-' || p_partkey AS channel,
       CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS assignable
FROM (SELECT *, 0 AS pos, CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size <> 1 THEN p_name END AS title FROM part
      UNION ALL
      SELECT *, 1 AS pos, p_brand AS id, p_type AS title FROM part) AS item
WHERE p_size % 7 <> 0 AND p_size % 10 <> 0"""


def _valid_rates(group: str, rates: str) -> str:
    """Mean rates of each group's valid lines. Lines without comments (number 6) have no comment or engagement rate."""
    added = {"like": "likes", "dislike": "dislikes", "comment": "comment_count", "engagement": "likes + dislikes + comment_count"}
    means = [
        f"sum(CAST({added[r]} AS DOUBLE) / views) / nullif(count(*){' - count(*) FILTER (dislikes = 6)' if r in ('comment', 'engagement') else ''}, 0) "
        f"AS avg_{r}_rate"
        for r in rates.split()
    ]
    return f"SELECT {group}, {', '.join(means)} FROM (SELECT * FROM fact WHERE has_valid_engagement) AS valid GROUP BY ALL"


QUERIES: dict[str, str] = {}

# --- scans, projections, set operations ---
QUERIES["scan_project_cast"] = "SELECT * FROM source"
QUERIES["star_rename"] = "SELECT *, trending_date AS trending_date_text FROM stg"
QUERIES["json_items_flatten"] = """
SELECT _source_region, _source_file, id AS category_id, title AS category_title, channel AS category_channel_id,
       assignable FROM part_item"""
QUERIES["union_regions"] = "SELECT * FROM united"
QUERIES["union_categories"] = "SELECT * FROM cat"
QUERIES["set_diff_names"] = """
SELECT coalesce(e.name, f.name) AS name,
       CASE WHEN f.name IS NULL THEN 'missing' WHEN e.name IS NULL THEN 'extra' ELSE 'ok' END AS status
FROM (SELECT DISTINCT 'o' || o_orderkey AS name FROM orders) e
     FULL JOIN (SELECT DISTINCT 'o' || (l_orderkey + l_linenumber) AS name FROM lineitem) f ON e.name = f.name"""
QUERIES["load_summary"] = """
SELECT _source_region, count(*) AS n_rows FROM landed GROUP BY ROLLUP (_source_region)"""

# --- scalar functions ---
QUERIES["safe_divide"] = f"""
SELECT region_code, video_id, views, comment_count, {_rate("comment_count")} AS ratio FROM source"""
QUERIES["normalize_boolean"] = """
SELECT region_code, video_id, x_comments AS comments_disabled, x_ratings AS ratings_disabled,
       x_error AS video_error_or_removed FROM marked"""
QUERIES["tags_normalized"] = f"""
SELECT region_code, video_id, tags_raw, CASE WHEN {_NO_TAGS} THEN NULL ELSE {_TAGS} END AS tags_normalized FROM source"""
QUERIES["tag_count"] = f"SELECT region_code, video_id, tags_raw, {_TAG_COUNT} AS tag_count FROM source"
QUERIES["trending_date_parse"] = f"""
SELECT region_code, video_id, trending_date, {_date("trending_date")} AS trending_date_parsed FROM source"""
QUERIES["publish_time_parse"] = f"""
SELECT region_code, video_id, publish_time_raw, CAST({_PUBLISHED} AS TIMESTAMP) AS publish_time FROM source"""
QUERIES["days_since_publish"] = f"""
SELECT region_code, video_id, trending_date,
       date_diff('day', CAST({_PUBLISHED} AS DATE), {_date("trending_date")}) AS days_since_publish FROM source"""
QUERIES["surrogate_key"] = f"""
SELECT region_code, video_id, trending_date, description, {_key("region_code")} AS key_1,
       {_key("region_code", "description")} AS key_2, {_key("region_code", "video_id", "trending_date")} AS key_3
FROM source"""
QUERIES["validity_flag"] = "SELECT region_code, video_id, views, x_valid AS has_valid_engagement FROM undeduped"
QUERIES["engagement_rates"] = f"""
SELECT region_code, video_id, {_rate("likes")} AS like_rate, {_rate("dislikes")} AS dislike_rate,
       {_rate("comment_count")} AS comment_rate, {_rate("(likes + dislikes + comment_count)")} AS engagement_rate
FROM source"""

# --- windows and joins ---
QUERIES["dedup_latest"] = "SELECT * EXCLUDE (x_comments, x_ratings, x_error, x_valid) FROM deduped"
QUERIES["dedup_of_table"] = QUERIES["dedup_latest"]
QUERIES["latest_row_pick"] = "SELECT * FROM latest"
QUERIES["left_join_category"] = """
SELECT o.region_code, o.video_id, o.trending_date, o.category_id, c.category_title, c.assignable AS category_assignable
FROM source o LEFT JOIN cat c ON o.region_code = c.region_code AND o.category_id = c.category_id"""
QUERIES["left_join_video"] = """
SELECT o.region_code, o.video_id, o.trending_date, v.video_key
FROM source o LEFT JOIN dvideo v ON o.region_code = v.region_code AND o.video_id = v.video_id"""
QUERIES["inner_join_lifecycle"] = "SELECT * FROM labelled_item"
QUERIES["inner_join_bucketed"] = QUERIES["inner_join_lifecycle"]
QUERIES["anti_join_orphans"] = """
SELECT region_code, video_id, trending_date, category_id FROM source WHERE category_id IN ('Brand#25', '29')"""
QUERIES["relationships_violations"] = """
SELECT o.category_id, count(*) AS n_rows
FROM source o LEFT JOIN (SELECT DISTINCT category_id FROM cat WHERE assignable) c ON o.category_id = c.category_id
WHERE o.category_id IS NOT NULL AND c.category_id IS NULL GROUP BY o.category_id"""

# --- models ---
QUERIES["stg_observations"] = "SELECT * FROM stg"
QUERIES["stg_categories"] = "SELECT * FROM cat"
QUERIES["int_enriched"] = "SELECT * FROM enriched"
QUERIES["int_lifecycle"] = "SELECT * FROM life"
QUERIES["dim_region"] = "SELECT * FROM dregion"
QUERIES["dim_category"] = "SELECT * FROM dcat"
QUERIES["dim_video"] = "SELECT * FROM dvideo"
QUERIES["fct_daily"] = "SELECT * FROM fact"
QUERIES["mart_video_lifecycle"] = """
SELECT video_region_key, region_code, video_id, first_trending_date, last_trending_date, observed_trending_days,
       latest_views, peak_views, latest_likes, peak_likes, latest_dislikes, peak_dislikes, latest_comment_count,
       peak_comment_count, publish_time, days_publish_to_first_trending FROM life"""
QUERIES["mart_channel_performance"] = """
SELECT region_code, channel_title, count(DISTINCT video_id) AS distinct_videos,
       CAST(sum(observed_trending_days) AS BIGINT) AS total_trending_days, avg(latest_views) AS avg_latest_views,
       avg(peak_views) AS avg_peak_views, avg(latest_engagement_rate) AS avg_engagement_rate
FROM labelled_item GROUP BY region_code, channel_title"""
QUERIES["mart_category_performance"] = f"""
SELECT g.*, avg_engagement_rate, avg_like_rate, avg_dislike_rate, avg_comment_rate
FROM (SELECT region_code, category_id, CASE WHEN category_id NOT IN ('Brand#25', '29') THEN 'Group ' || substr(category_id, 7, 1) END
             AS category_title, trending_date, count(DISTINCT video_id) AS distinct_videos, count(*) AS observations
      FROM fact GROUP BY ALL) AS g
     LEFT JOIN ({_valid_rates("region_code, category_id, trending_date", "engagement like dislike comment")}) AS v
     ON (g.region_code, g.category_id) = (v.region_code, v.category_id) AND g.trending_date IS NOT DISTINCT FROM v.trending_date"""
QUERIES["mart_regional_trending"] = f"""
SELECT g.*, avg_engagement_rate, avg_like_rate
FROM (SELECT region_code, trending_date, count(DISTINCT video_id) AS distinct_videos, count(*) AS observations,
             count(DISTINCT category_id) AS active_categories, count(DISTINCT channel_title) AS active_channels
      FROM fact GROUP BY ALL) AS g
     LEFT JOIN ({_valid_rates("region_code, trending_date", "engagement like")}) AS v
     ON g.region_code = v.region_code AND g.trending_date IS NOT DISTINCT FROM v.trending_date"""

# --- data quality ---
_STG_COLUMNS = (
    "region_code video_id trending_date trending_date_parsed title channel_title category_id publish_time "
    "publish_time_raw tags_raw views likes dislikes comment_count thumbnail_link comments_disabled ratings_disabled "
    "video_error_or_removed comments_disabled_raw ratings_disabled_raw video_error_or_removed_raw description "
    "_source_file _loaded_at observation_key"
).split()
QUERIES["dq_not_null"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_failures FROM stg" for c in _STG_COLUMNS
)
QUERIES["dq_unique"] = """
SELECT observation_key, count(*) AS n_rows FROM undeduped GROUP BY observation_key HAVING count(*) > 1"""
QUERIES["dq_accepted_values"] = """
SELECT comments_disabled_raw, count(*) AS n_rows FROM source
WHERE comments_disabled_raw NOT IN ('True', 'False') GROUP BY comments_disabled_raw"""
QUERIES["dq_relationships"] = """
SELECT video_id, count(*) AS n_rows FROM source
WHERE video_id NOT IN (SELECT video_id FROM dvideo WHERE video_error_or_removed = false AND ratings_disabled = false)
GROUP BY video_id"""
QUERIES["dq_unique_combo"] = """
SELECT region_code, video_id, count(*) AS n_rows FROM stg GROUP BY region_code, video_id HAVING count(*) > 1"""
# brand 55 has no category row either, but carries the exempt id
QUERIES["dq_orphan_category"] = """
SELECT region_code, video_id, trending_date, category_id FROM stg WHERE category_id = 'Brand#25'"""
# items all of whose lines have tax 0.08, and so no date; a date range can't be reversed
QUERIES["dq_lifecycle_dates"] = """
SELECT region_code, video_id, CAST(NULL AS DATE) AS first_trending_date, CAST(NULL AS DATE) AS last_trending_date,
       CAST(0 AS BIGINT) AS observed_trending_days
FROM source GROUP BY region_code, video_id HAVING min(trending_date) = 'bad'"""
QUERIES["dq_duplicate_grain"] = """
SELECT observation_key, region_code, video_id, trending_date, count(*) AS c FROM fact_undeduped
GROUP BY ALL HAVING count(*) > 1"""
# the query lowers likes by 10 and comments by 5; prices and line numbers are never negative
QUERIES["dq_nonnegative"] = """
SELECT region_code, video_id, trending_date, views, likes - 10 AS likes, dislikes, comment_count - 5 AS comment_count
FROM fact WHERE likes < 10 OR comment_count < 5"""
# order dates lie in 1992 to 1998 and dates before 1970 are not found, so a line is shipped too early if ever
QUERIES["dq_publish_before_trending"] = """
SELECT region_code, video_id, trending_date_parsed, publish_time,
       datediff('day', CAST(publish_time AS DATE), trending_date_parsed) AS days_since_publish
FROM stg WHERE CAST(publish_time AS DATE) > trending_date_parsed + INTERVAL 1 DAY"""
_STG_REQUIRED = (
    "observation_key region_code video_id trending_date trending_date_parsed category_id views likes dislikes "
    "comment_count"
).split()
QUERIES["dq_table_report"] = "\nUNION ALL ".join(
    [
        f"SELECT 'stg_observations' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS n_failures FROM stg"
        for c in _STG_REQUIRED
    ]
    + [
        "SELECT 'stg_observations', 'accepted_values', 'region_code', count(*) FILTER (region_code NOT IN "
        "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')) FROM stg",
        "SELECT 'stg_observations', 'unique', 'observation_key', count(*) FROM "
        "(SELECT observation_key FROM stg GROUP BY 1 HAVING count(*) > 1) AS repeated",
    ]
)
QUERIES["dq_observed_report"] = f"""{QUERIES["dq_table_report"]}
UNION ALL SELECT 'stg_observations', 'n_rows', '', count(*) FROM stg"""

# --- profile ---
_LANDED_DATE = _date("trending_date")
_PROFILE_STAMP = """coalesce(
    try_strptime(CASE WHEN regexp_full_match(publish_time, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d\\.\\d{1,6}Z')
                      THEN publish_time END, '%Y-%m-%dT%H:%M:%S.%fZ'),
    try_strptime(CASE WHEN regexp_full_match(publish_time, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ')
                      THEN publish_time END, '%Y-%m-%dT%H:%M:%SZ'))"""
_SIXTEEN = (
    "video_id trending_date title channel_title category_id publish_time tags views likes dislikes comment_count "
    "thumbnail_link comments_disabled ratings_disabled video_error_or_removed description"
).split()
_FLAG_COLUMNS = ("comments_disabled", "ratings_disabled", "video_error_or_removed")
_MEASURE_COLUMNS = ("views", "likes", "dislikes", "comment_count")
_BOOLEAN_WORDS = "('True', 'true', 'TRUE', 'False', 'false', 'FALSE')"

QUERIES["profile_counts"] = f"""
SELECT _source_region AS region_code, count(*) AS n_rows, count(DISTINCT nullif(video_id, '')) AS distinct_video_id,
       count(DISTINCT nullif(trending_date, '')) AS distinct_trending_date_raw,
       count(DISTINCT CASE WHEN {_LANDED_DATE} IS NOT NULL THEN trending_date END) AS distinct_trending_date_parsed
FROM landed GROUP BY 1"""
QUERIES["profile_date_range"] = f"""
SELECT _source_region AS region_code, min({_LANDED_DATE}) AS min_trending_date, max({_LANDED_DATE}) AS max_trending_date,
       min(trending_date) FILTER ({_LANDED_DATE} IS NOT NULL) AS min_trending_date_text,
       max(trending_date) FILTER ({_LANDED_DATE} IS NOT NULL) AS max_trending_date_text
FROM landed GROUP BY 1"""
_DUPLICATES = f"""
SELECT _source_region AS region_code, count(*) AS n_rows,
       count(*) - count(DISTINCT (coalesce(video_id, ''), coalesce(trending_date, ''))) AS duplicate_grain_keys,
       count(*) - count(DISTINCT ({", ".join(f"coalesce({c}, '')" for c in _SIXTEEN)})) AS exact_duplicate_rows
FROM landed GROUP BY 1"""
QUERIES["profile_duplicates"] = f"SELECT * EXCLUDE (n_rows) FROM ({_DUPLICATES}) AS d"
QUERIES["profile_nulls"] = "\nUNION ALL ".join(
    f"SELECT _source_region AS region_code, '{c}' AS column_name, "
    f"count(*) FILTER ({c} IS NULL OR {c} = '') AS n_blank, "
    f"100.0::DOUBLE * count(*) FILTER ({c} IS NULL OR {c} = '') / count(*) AS pct_blank FROM landed GROUP BY 1"
    for c in _SIXTEEN
)
_PARSED = {
    "trending_date": _LANDED_DATE,
    "publish_time": _PROFILE_STAMP,
    **{c: f"TRY_CAST({c} AS BIGINT)" for c in _MEASURE_COLUMNS},
    **{c: f"CASE WHEN {c} IN {_BOOLEAN_WORDS} THEN 1 END" for c in _FLAG_COLUMNS},
}
QUERIES["profile_parse_failures"] = "\nUNION ALL ".join(
    f"SELECT _source_region AS region_code, '{c}' AS column_name, "
    f"count(*) FILTER ({c} <> '' AND {parsed} IS NULL) AS n_failures FROM landed GROUP BY 1"
    for c, parsed in _PARSED.items()
)
_RANGE = (
    "'{0}' AS measure, min(TRY_CAST({0} AS BIGINT)) AS min_value, max(TRY_CAST({0} AS BIGINT)) AS max_value, "
    "count(*) FILTER (TRY_CAST({0} AS BIGINT) < 0) AS n_negative FROM landed"
)
QUERIES["profile_numeric_ranges"] = "\nUNION ALL ".join(
    sql
    for c in _MEASURE_COLUMNS
    for sql in (
        f"SELECT _source_region AS region_code, {_RANGE.format(c)} GROUP BY 1",
        f"SELECT CAST(NULL AS VARCHAR) AS region_code, {_RANGE.format(c)}",
    )
)
QUERIES["profile_bool_unexpected"] = f"""
SELECT region_code, raw_value, count(*) AS n_rows
FROM ({" UNION ALL ".join(f"SELECT _source_region AS region_code, {c} AS raw_value FROM landed" for c in _FLAG_COLUMNS)})
     AS flags
WHERE raw_value <> '' AND raw_value NOT IN {_BOOLEAN_WORDS} GROUP BY 1, 2"""
QUERIES["profile_category_coverage"] = """
SELECT region_code, count(*) AS category_ids_seen, count(*) FILTER (NOT known) AS category_ids_no_match,
       string_agg(region_code || ':' || category_id, ', ' ORDER BY category_id)
           FILTER (NOT known AND rank <= 25) AS no_match_sample
FROM (SELECT s.region_code, s.category_id, c.category_id IS NOT NULL AS known,
             row_number() OVER (PARTITION BY s.region_code, c.category_id IS NULL ORDER BY s.category_id) AS rank
      FROM (SELECT DISTINCT region_code, category_id FROM source WHERE category_id <> '') s
           LEFT JOIN cat c ON s.region_code = c.region_code AND s.category_id = c.category_id) AS seen
GROUP BY region_code"""
QUERIES["profile_publish_after"] = f"""
SELECT _source_region AS region_code,
       count(*) FILTER ({_PROFILE_STAMP} > CAST({_LANDED_DATE} AS TIMESTAMP)) AS publish_after_trending
FROM landed GROUP BY 1"""
QUERIES["profile_publish_after_examples"] = f"""
SELECT _source_region AS region_code, video_id, publish_time, trending_date,
       row_number() OVER (PARTITION BY _source_region ORDER BY video_id, trending_date, publish_time) AS example
FROM landed WHERE {_PROFILE_STAMP} > CAST({_LANDED_DATE} AS TIMESTAMP) QUALIFY example <= 5"""
QUERIES["profile_flags"] = "\nUNION ALL ".join(
    f"SELECT _source_region AS region_code, '{c}' AS flag, count(*) FILTER ({c} IN ('True', 'true', 'TRUE')) AS n_true, "
    f"count(*) - count(*) FILTER ({c} IN ('True', 'true', 'TRUE')) AS n_not_true FROM landed GROUP BY 1"
    for c in _FLAG_COLUMNS
)
QUERIES["profile_title_changes"] = """
SELECT region_code, count(*) FILTER (n > 1) AS videos_with_multiple_titles,
       CAST(sum(n - 1) AS BIGINT) AS title_change_count
FROM (SELECT region_code, video_id, count(DISTINCT coalesce(title, '')) AS n FROM source GROUP BY 1, 2) AS v
GROUP BY 1"""
QUERIES["profile_channel_changes"] = """
SELECT region_code, count(*) FILTER (n > 1) AS videos_with_multiple_channels
FROM (SELECT region_code, video_id, count(DISTINCT nullif(channel_title, '')) AS n FROM source GROUP BY 1, 2) AS v
GROUP BY 1"""
QUERIES["profile_tag_samples"] = """
SELECT region_code, tag_sample, row_number() OVER (PARTITION BY region_code ORDER BY tag_sample) AS example
FROM (SELECT DISTINCT region_code, substr(tags_raw, 1, 60) AS tag_sample FROM source WHERE tags_raw <> '') AS t
QUALIFY example <= 8"""
QUERIES["profile_category_docs"] = """
SELECT a.*, i.duplicate_ids, t.duplicate_titles, s.ids_sample
FROM (SELECT _source_region AS region_code, count(*) AS item_count,
             count(*) FILTER (title IS NULL OR title = '') AS null_titles,
             count(*) FILTER (assignable) AS assignable_true, count(*) FILTER (NOT assignable) AS assignable_false,
             count(*) FILTER (assignable IS NULL) AS assignable_null FROM part_item GROUP BY 1) a
     JOIN (SELECT _source_region, count(*) FILTER (n > 1) AS duplicate_ids
           FROM (SELECT _source_region, id, count(*) AS n FROM part_item GROUP BY 1, 2) AS x GROUP BY 1) i
       ON a.region_code = i._source_region
     JOIN (SELECT _source_region, count(*) FILTER (n > 1) AS duplicate_titles
           FROM (SELECT _source_region, title, count(*) AS n FROM part_item GROUP BY 1, 2) AS x GROUP BY 1) t
       ON a.region_code = t._source_region
     JOIN (SELECT _source_region, string_agg(id, ', ' ORDER BY _source_file, pos) AS ids_sample
           FROM (SELECT * FROM part_item
                 QUALIFY row_number() OVER (PARTITION BY _source_region ORDER BY _source_file, pos) <= 5) AS x
           GROUP BY 1) s ON a.region_code = s._source_region"""
QUERIES["profile_cross_region"] = """
SELECT count(*) FILTER (n_rows > 1) AS ids_on_many_rows, count(*) FILTER (n_regions > 1) AS ids_in_many_regions,
       first(video_id ORDER BY n_rows DESC, video_id) AS top_video_id, max(n_rows) AS top_n_rows,
       first(n_regions ORDER BY n_rows DESC, video_id) AS top_n_regions
FROM (SELECT video_id, count(*) AS n_rows, count(DISTINCT region_code) AS n_regions FROM source GROUP BY 1) AS v"""
QUERIES["profile_totals"] = f"""
SELECT count(*) AS csv_count, CAST(sum(n_rows) AS BIGINT) AS total_rows,
       CAST(sum(n_rows - duplicate_grain_keys) AS BIGINT) AS total_distinct_keys,
       CAST(sum(duplicate_grain_keys) AS BIGINT) AS total_dup_keys,
       CAST(sum(exact_duplicate_rows) AS BIGINT) AS total_exact_dup
FROM ({_DUPLICATES}) AS d"""

# --- landing: CSV records and file facts ---
QUERIES["csv_accepted_rows"] = """
SELECT _source_region, video_id, trending_date, title || ', "new" ' || dislikes AS title,
       channel_title || chr(10) || 'line two' AS channel_title, category_id, nullif(publish_time, '') AS publish_time,
       nullif(tags, '') AS tags, views, likes, dislikes, comment_count, thumbnail_link, comments_disabled,
       ratings_disabled, video_error_or_removed, description,
       CASE WHEN dislikes IN ('5', '7') THEN 'truncated' ELSE 'ok' END AS _parse_status
FROM landed WHERE dislikes <> '6'"""
QUERIES["csv_rejected_rows"] = """
SELECT _source_region, CASE dislikes WHEN '6' THEN 'short' ELSE 'truncated' END AS _parse_status, count(*) AS n_rows
FROM landed WHERE dislikes IN ('5', '6', '7') GROUP BY ALL"""
QUERIES["load_report"] = """
SELECT _source_region, _source_file, count(*) AS n_rows, count(*) FILTER (dislikes IN ('5', '7')) AS n_truncated,
       count(*) FILTER (dislikes = '6') AS n_short, CAST(0 AS BIGINT) AS n_unclosed
FROM landed GROUP BY ALL"""
QUERIES["audit_file_facts"] = """
SELECT file, size_bytes, sha256, encoding,
       CASE WHEN pairs > 0 AND 2 * pairs >= feeds THEN 'CRLF' ELSE 'LF' END AS line_ending
FROM (SELECT file, CAST(octet_length(content) AS BIGINT) AS size_bytes, sha256(content) AS sha256, encoding,
             len(list_filter(bytes, lambda b: b = '0A')) AS feeds,
             len(list_filter(list_zip(bytes, bytes[2:]), lambda p: p[1] = '0D' AND p[2] = '0A')) AS pairs
      FROM (SELECT *, regexp_extract_all(hex(content), '..') AS bytes
            FROM (SELECT 'doc' || doc_id || '.txt' AS file,
                         CASE WHEN lang = 'de' THEN 'latin-1' ELSE 'utf-8' END AS encoding,
                         CASE WHEN lang = 'de' THEN encode(text) || CAST('\\xFF' AS BLOB)
                              WHEN lang = 'fr' THEN encode(replace(text, ' ', chr(13) || chr(10)))
                              ELSE encode(text) END AS content
                  FROM documents) AS raw) AS split) AS counted"""
QUERIES["audit_json_shape"] = """
SELECT 'part' || p_partkey || '.json' AS file,
       CASE WHEN p_partkey % 11 = 0 THEN 'items: entry is no object'
            WHEN p_partkey % 13 = 0 THEN 'items: entry lacks id or snippet'
            WHEN p_size % 7 = 0 THEN 'items: no list' END AS problem
FROM part"""
_HEADER = ",".join(_SIXTEEN)
QUERIES["audit_header_drift"] = f"""
SELECT 's' || s_suppkey AS file,
       CASE s_suppkey % 5 WHEN 2 THEN 'header drift: ' || chr(65279) || '{_HEADER}'
            WHEN 3 THEN 'header drift: {_HEADER},extra'
            WHEN 4 THEN 'header drift: {_HEADER.replace("views,likes", "likes,views")}' END AS problem
FROM supplier"""
QUERIES["audit_manifest"] = """
SELECT 'o' || o_orderkey AS file,
       CASE WHEN o_orderkey % 7 = 0 THEN 'missing' WHEN o_orderkey % 11 = 0 THEN 'unlisted'
            WHEN o_orderkey % 3 = 0 THEN 'size differs' WHEN o_orderkey % 5 = 0 THEN 'not hashed'
            WHEN o_orderkey % 2 = 0 THEN 'hash differs' ELSE 'ok' END AS result
FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 11 <> 0"""
CTES["judged"] = """
SELECT 'x' || p_partkey || suffix AS file, CASE WHEN p_partkey % 4 = 0 THEN 'extra' ELSE 'ok' END AS status,
       CASE WHEN p_partkey % 4 = 0 THEN 'warn' WHEN p_size % 7 = 0 THEN 'fail' ELSE 'ok' END AS verdict, p_partkey
FROM part JOIN (VALUES ('.csv', false), ('-1.csv', true), ('-2.csv', true)) AS s(suffix, in_parts)
     ON (p_partkey % 5 = 0) = in_parts WHERE p_partkey % 3 <> 0"""
QUERIES["audit_verdicts"] = """
SELECT file, status, verdict FROM judged
UNION ALL SELECT 'x' || p_partkey || '.csv', 'missing', 'fail' FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 4 <> 0"""
QUERIES["audit_totals"] = """
SELECT 'csv' AS type, count(*) AS n_files, CAST(sum(p_partkey) AS BIGINT) AS total_bytes FROM judged"""
QUERIES["loaded_totals"] = """
SELECT 'observations' AS subject, (SELECT count(*) FROM lineitem) AS n_rows
UNION ALL SELECT 'categories', (SELECT count(DISTINCT p_brand) * 5 FROM part WHERE p_brand NOT IN ('Brand#25', 'Brand#55'))"""
QUERIES["dq_rules_report"] = f"""
SELECT 'stg_observations' AS table_name, 'orphan_categories' AS check_name, '' AS column_name, count(*) AS n_failures
FROM ({QUERIES["dq_orphan_category"]}) AS a
UNION ALL SELECT 'int_lifecycle', 'lifecycle_dates', '', count(*) FROM ({QUERIES["dq_lifecycle_dates"]}) AS b
UNION ALL SELECT 'fct_daily', 'duplicate_grain', '', 0
UNION ALL SELECT 'fct_daily', 'negative_measures', '', 0
UNION ALL SELECT 'int_enriched', 'published_after_trending', '', count(*) FROM ({QUERIES["dq_publish_before_trending"]}) AS c"""

# the declared checks, each counted over the SQL of its table
_CHECKED = {
    "bronze_observations": "landed",
    "bronze_categories": "(SELECT *, region_code AS _source_region FROM cat)",
    "region_seed": "dregion",
    "stg_observations": "stg",
    "stg_categories": "cat",
    "int_enriched": "enriched",
    "int_lifecycle": "life",
    "dim_region": "dregion",
    "dim_category": "dcat",
    "dim_video": "dvideo",
    "fct_daily": "fact",
    **{m: f"({QUERIES[m]})" for m in DECLARED if m.startswith("mart_")},
}


def _declared(table: str, checks: TableChecks) -> list[str]:
    """The failures of one table's checks: columns in one scan, keys one by one."""
    relation = f"{_CHECKED[table]} AS t"
    regions = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
    counts = [("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in checks.not_null]
    if checks.region_column:
        counts.append(("accepted_values", checks.region_column, f"count(*) FILTER ({checks.region_column} NOT IN {regions})"))
    listed = ", ".join(f"{{'check_name': '{check}', 'column_name': '{c}', 'n_failures': {n}}}" for check, c, n in counts)
    scope, by = f"'{table}'", ""
    if checks.by:
        scope, by = f"concat_ws('/', '{table}', {', '.join(checks.by)})", f" GROUP BY {', '.join(checks.by)}"
    parts = [f"SELECT table_name, unnest(found, recursive := true) FROM (SELECT {scope} AS table_name, [{listed}] AS found FROM {relation}{by}) AS counted"]
    combinations = [("unique", [c]) for c in checks.unique] + [("unique_combination", list(c)) for c in checks.unique_combinations]
    for check, columns in combinations:
        known = f"WHERE {columns[0]} IS NOT NULL " if check == "unique" else ""
        keys = ", ".join(columns)
        repeated = f"SELECT {keys} FROM {relation} {known}GROUP BY {keys} HAVING count(*) > 1"
        parts.append(f"SELECT '{table}', '{check}', '{'+'.join(columns)}', count(*) FROM ({repeated}) AS repeated")
    for own, other, key in checks.relationships:
        absent = f"SELECT DISTINCT {own} FROM {relation} WHERE {own} NOT IN (SELECT {key} FROM {_CHECKED[other]} AS r)"
        parts.append(f"SELECT '{table}', 'relationships', '{own}', count(*) FROM ({absent}) AS absent")
    return parts


QUERIES["dq_full_report"] = "\nUNION ALL ".join([p for n, c in DECLARED.items() for p in _declared(n, c)] + [QUERIES["dq_rules_report"]])

# nodes of three over the lines' digests, twice, then the root
_TREE = "(SELECT 'doc' || doc_id AS file, unnest(range(len(ls))) AS n, sha256(unnest(ls)) AS h FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"
for _ in range(2):
    _TREE = f"(SELECT file, n // 3 AS n, sha256(string_agg(h, '' ORDER BY n)) AS h FROM {_TREE} GROUP BY file, n // 3)"
QUERIES["audit_trees"] = f"SELECT file, sha256(string_agg(h, '' ORDER BY n)) AS tree_sha256 FROM {_TREE} GROUP BY file"

# --- landing files ---
_FILE_TITLE = "title || ', \"new\"' || CASE WHEN _source_region = 'EUROPE' THEN ' caf' || chr(65533) ELSE '' END"
_FILE_TEXTS = {
    "title": _FILE_TITLE,
    "description": "description || chr(10) || 'line, \"two\"' || chr(10) || chr(10) || 'end'",
    "publish_time": "nullif(publish_time, '')",
    "tags": "nullif(tags, '')",
}
QUERIES["files_landed"] = f"""
SELECT {", ".join(f"{_FILE_TEXTS.get(c, c)} AS {c}" for c in _SIXTEEN)}, left(_source_region, 2) AS _source_region,
       left(_source_region, 2) || 'videos.csv' AS _source_file, _source_region = 'EUROPE' AS _bad_bytes, 'ok' AS _parse_status, true AS loaded
FROM landed"""
QUERIES["files_load_report"] = """
SELECT left(_source_region, 2) AS _source_region, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_truncated, CAST(0 AS BIGINT) AS n_short,
       CAST(0 AS BIGINT) AS n_unclosed
FROM landed GROUP BY ALL"""
QUERIES["files_categories"] = """
SELECT left(region_code, 2) AS _source_region, category_id, category_title, category_channel_id, assignable FROM cat"""
QUERIES["files_audited"] = """
SELECT left(r, 2) AS region, 'csv' AS type, CASE r WHEN 'EUROPE' THEN 'latin-1' ELSE 'utf-8' END AS encoding,
       CASE r WHEN 'ASIA' THEN 'CRLF' ELSE 'LF' END AS line_ending, CAST(NULL AS VARCHAR) AS problem, 16 AS n_columns,
       CAST(NULL AS INTEGER) AS n_items, 64 AS hash_length
FROM (SELECT DISTINCT _source_region AS r FROM landed) AS regions
UNION ALL
SELECT left(region_code, 2), 'json', 'utf-8', 'LF', NULL, NULL, CAST(count(*) AS INTEGER), 64 FROM cat GROUP BY region_code"""
QUERIES["files_items"] = """
SELECT left(region_code, 2) AS region, category_id AS id, category_title AS title, assignable FROM cat"""
QUERIES["check_loaded"] = """
SELECT 'check_loaded_observations' AS subject, 'missing column views' AS problem
UNION ALL SELECT 'check_loaded_observations', 'missing region ' || r_name FROM region WHERE r_name = 'ASIA'
UNION ALL SELECT 'check_loaded_categories', 'missing region ' || r_name FROM region WHERE r_name = 'EUROPE'
UNION ALL SELECT 'check_loaded_categories', 'extra region ATLANTIS'"""

# --- presentation: which result columns leave as text and which are rounded ---
_STAGED_TEMPORAL = "trending_date_parsed publish_time _loaded_at"
_LIFE_TEMPORAL = "first_trending_date last_trending_date publish_time"
_RATES = "like_rate dislike_rate comment_rate engagement_rate"

# name -> (date and timestamp columns, double columns)
PRESENTED: dict[str, tuple[str, str]] = {
    "scan_project_cast": ("_loaded_at", ""),
    "star_rename": (_STAGED_TEMPORAL, ""),
    "union_regions": ("_loaded_at", ""),
    "union_categories": ("_loaded_at", ""),
    "safe_divide": ("", "ratio"),
    "trending_date_parse": ("trending_date_parsed", ""),
    "publish_time_parse": ("publish_time", ""),
    "engagement_rates": ("", _RATES),
    "dedup_latest": ("_loaded_at", ""),
    "dedup_of_table": ("_loaded_at", ""),
    "latest_row_pick": (_STAGED_TEMPORAL, ""),
    "inner_join_lifecycle": ("", "latest_engagement_rate"),
    "inner_join_bucketed": ("", "latest_engagement_rate"),
    "stg_observations": (_STAGED_TEMPORAL, ""),
    "stg_categories": ("_loaded_at", ""),
    "int_enriched": (_STAGED_TEMPORAL, _RATES),
    "int_lifecycle": (_LIFE_TEMPORAL, ""),
    "dim_video": ("publish_time", ""),
    "fct_daily": ("trending_date publish_time", _RATES),
    "mart_video_lifecycle": (_LIFE_TEMPORAL, ""),
    "mart_channel_performance": ("", "avg_latest_views avg_peak_views avg_engagement_rate"),
    "mart_category_performance": (
        "trending_date",
        "avg_engagement_rate avg_like_rate avg_dislike_rate avg_comment_rate",
    ),
    "mart_regional_trending": ("trending_date", "avg_engagement_rate avg_like_rate"),
    "dq_lifecycle_dates": ("first_trending_date last_trending_date", ""),
    "dq_duplicate_grain": ("trending_date", ""),
    "dq_nonnegative": ("trending_date", ""),
    "dq_publish_before_trending": ("trending_date_parsed publish_time", ""),
    "profile_date_range": ("min_trending_date max_trending_date", ""),
    "profile_nulls": ("", "pct_blank"),
}


def _mentions(sql: str) -> set[str]:
    return {name for name in CTES if re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "", sql))}


def _needed(sql: str) -> list[str]:
    """CTEs a statement uses, directly or through others, in definition order."""
    names, frontier = set(), _mentions(sql)
    while frontier:
        names |= frontier
        frontier = set().union(*(_mentions(CTES[n]) for n in frontier)) - names
    return [n for n in CTES if n in names]


def statement(name: str) -> str:
    """The full statement of one query, its result columns presented as in `registry.py`."""
    body = QUERIES[name]
    temporal, doubles = (columns.split() for columns in PRESENTED.get(name, ("", "")))
    shown = [f"CAST({c} AS VARCHAR) AS {c}" for c in temporal] + [f"round({c}, 6) AS {c}" for c in doubles]
    star = f"* REPLACE ({', '.join(shown)})" if shown else "*"
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in _needed(body))
    return f"{f'WITH {ctes}' if ctes else ''}\nSELECT {star}\nFROM ({body.strip()}) AS result".strip()


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
