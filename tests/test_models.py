"""Edge rows through staging, lifecycle and marts; every check finds its seeded violation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart.operators import profile, quality, relational
from snapmart.plans import dimensions, enrich, fact, items, lifecycle, marts, staging
from snapmart.schemas import OBSERVATION_HEADER

DEFAULTS = {
    "video_id": "v1", "trending_date": "18.01.01", "title": "t", "channel_title": "ch", "category_id": "10",
    "publish_time": "2018-01-01T00:00:00.000Z", "tags": "a|b", "views": "10", "likes": "1", "dislikes": "1",
    "comment_count": "1", "thumbnail_link": "l", "comments_disabled": "False", "ratings_disabled": "False",
    "video_error_or_removed": "False", "description": "d", "_source_region": "CA", "_source_file": "CAvideos.csv",
    "_loaded_at": dt.datetime(2020, 1, 1),
}
LANDED = ", ".join(f"{c} string" for c in (*OBSERVATION_HEADER, "_source_region", "_source_file"))
LANDED += ", _loaded_at timestamp_ntz"


def landed(spark, *changes):
    rows = [tuple({**DEFAULTS, **c}.values()) for c in changes]
    return spark.createDataFrame(rows, LANDED)


def categories(spark, *rows):
    rows = rows or (("CA", "10", "Music", None, True),)
    names = "region_code string, category_id string, category_title string, category_channel_id string"
    return spark.createDataFrame(list(rows), f"{names}, assignable boolean")


def seed(spark):
    return spark.createDataFrame(
        [("CA", "Canada", "en_CA", "en")], "region_code string, region_name string, locale string, language_code string"
    )


def fact_of(spark, landed_rows, cats=None):
    cats = cats or categories(spark)
    enriched = enrich.int_enriched(staging.stg_observations(landed_rows), cats)
    return fact.fct_daily(enriched, dimensions.dim_region(seed(spark)), dimensions.dim_category(cats))


def test_dedup_prefers_latest_load_then_larger_measures(spark):
    rows = landed(
        spark,
        {"views": "5"},
        {"views": "9"},
        {"video_id": "v2", "views": "99"},
        {"video_id": "v2", "views": "1", "_loaded_at": dt.datetime(2021, 1, 1)},
        {"video_id": "v3", "description": None},
        {"video_id": "v3", "description": "z"},
    )
    got = {r.video_id: (r.views, r.description) for r in staging.stg_observations(rows).collect()}
    assert got == {"v1": (9, "d"), "v2": (1, "d"), "v3": (10, "z")}


def test_dedup_is_on_the_raw_date(spark):
    rows = landed(spark, {"trending_date": "bad"}, {"trending_date": "worse"}, {"trending_date": None})
    assert staging.stg_observations(rows).count() == 3


def test_unknown_region_is_left_out(spark):
    assert staging.stg_observations(landed(spark, {"_source_region": "ZZ"}, {})).count() == 1


def test_bad_measure_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_observations(landed(spark, {"views": "many"})).collect()


def test_hot_key_is_pruned_before_the_shuffle(spark):
    """Nine in ten rows are copies of one key; each map task passes on one of them."""
    hot = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("video_id"),
        F.col("id").alias("views"),
    )
    picked = relational.latest_per_key(hot, ["video_id"], ["views"])
    assert picked.filter("video_id = 'hot'").first().views == 19999
    assert picked.count() == 2001
    plan = picked._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]


def test_lifecycle(spark):
    rows = landed(
        spark,
        {"trending_date": "18.01.01", "views": "5"},
        {"trending_date": "18.02.01", "views": None, "likes": "7"},
        {"trending_date": "18.05.01", "views": None, "likes": None, "comment_count": None},
        {"trending_date": "bad", "views": "900"},
        {"video_id": "v2", "trending_date": "bad", "publish_time": ""},
    )
    got = {r.video_id: r for r in lifecycle.int_lifecycle(staging.stg_observations(rows)).collect()}
    one, two = got["v1"], got["v2"]
    assert (one.first_trending_date, one.last_trending_date) == (dt.date(2018, 1, 1), dt.date(2018, 1, 5))
    assert (one.observed_trending_days, one.latest_views, one.peak_views, one.latest_likes) == (3, 5, 900, 7)
    assert one.days_publish_to_first_trending == 0
    assert (two.observed_trending_days, two.latest_views, two.peak_views, two.first_trending_date) == (0, None, 10, None)


def test_observed_days_equal_the_distinct_count(spark):
    dates = ["18.01.01", "18.02.01", "18.02.01", "70.01.01", "69.01.01", "bad", "18.30.02", None]
    staged = staging.stg_observations(landed(spark, *[{"trending_date": d} for d in dates]))
    distinct = staged.agg(F.countDistinct("trending_date_parsed")).first()[0]
    assert lifecycle.int_lifecycle(staged).first().observed_trending_days == distinct == 4


def test_dim_video_takes_latest_and_survives_bad_dates(spark):
    rows = landed(
        spark,
        {"trending_date": "18.01.01", "title": "old"},
        {"trending_date": "18.02.01", "title": "new", "description": None},
        {"trending_date": "bad", "title": "undated"},
        {"video_id": "v2", "trending_date": "bad", "title": "only"},
    )
    got = {r.video_id: (r.title, r.description) for r in dimensions.dim_video(staging.stg_observations(rows)).collect()}
    assert got == {"v1": ("new", None), "v2": ("only", "d")}


def test_orphan_categories(spark):
    rows = landed(
        spark, *[{"video_id": f"v{c}", "category_id": c} for c in ("10", "29", "99", None)]
    )
    keys = {r.video_id: r.category_key for r in fact_of(spark, rows).collect()}
    assert keys.pop("v10") is not None and set(keys.values()) == {None}
    orphans = quality.orphan_categories(staging.stg_observations(rows), categories(spark)).collect()
    assert [r.category_id for r in orphans] == ["99"]


def test_channel_mart_groups_under_the_latest_label(spark):
    rows = landed(
        spark,
        {"trending_date": "18.01.01", "channel_title": "A", "views": "100"},
        {"trending_date": "18.02.01", "channel_title": "B", "views": "50"},
        {"trending_date": "18.03.01", "channel_title": None, "views": "20", "ratings_disabled": "True"},
        {"video_id": "v2", "trending_date": "bad", "channel_title": "B", "views": "40"},
    )
    staged = staging.stg_observations(rows)
    mart = marts.mart_channel_performance(items.item_aggregate(staged)).collect()
    assert [(r.channel_title, r.distinct_videos, r.total_trending_days) for r in mart] == [("B", 2, 3)]
    # the dated item's latest views are 20; the undated one has none. The rate is the best valid one.
    assert (mart[0].avg_latest_views, mart[0].avg_peak_views) == (20, 70)
    assert round(mart[0].avg_engagement_rate, 6) == round((3 / 50 + 3 / 40) / 2, 6)


def test_invalid_rows_leave_the_averages_alone(spark):
    rows = landed(spark, {"ratings_disabled": "True"}, {"video_id": "v2", "views": "20"}, {"video_id": "v3", "views": "0"})
    row = marts.mart_regional_trending(fact_of(spark, rows)).first()
    assert (row.observations, row.distinct_videos, row.avg_like_rate) == (3, 3, 0.05)


# --- checks find exactly the seeded row ---


def test_publish_tolerance(spark):
    rows = landed(
        spark,
        {"publish_time": "2018-01-02T23:00:00.000Z"},
        {"video_id": "v2", "publish_time": "2018-01-03T00:00:00.000Z"},
        {"video_id": "v3", "publish_time": ""},
    )
    enriched = enrich.int_enriched(staging.stg_observations(rows), categories(spark))
    assert [r.video_id for r in quality.published_after_trending(enriched).collect()] == ["v2"]


def test_negative_measures(spark):
    rows = landed(spark, {}, {"video_id": "v2", "dislikes": "-1"}, {"video_id": "v3", "views": None})
    assert [r.video_id for r in quality.negative_measures(fact_of(spark, rows)).collect()] == ["v2"]


def test_duplicate_grain(spark):
    cats = categories(spark, ("CA", "10", "Music", None, True), ("CA", "10", "Musik", None, True))
    assert quality.duplicate_grain(fact_of(spark, landed(spark, {}))).count() == 0
    # a repeated category row multiplies the fact, through both joins to it
    assert [r.c for r in quality.duplicate_grain(fact_of(spark, landed(spark, {}), cats)).collect()] == [4]


def test_lifecycle_dates(spark):
    rows = spark.createDataFrame(
        [("CA", "a", dt.date(2018, 1, 2), dt.date(2018, 1, 1), 1), ("CA", "b", None, None, 0),
         ("CA", "c", dt.date(2018, 1, 1), dt.date(2018, 1, 1), 1)],
        "region_code string, video_id string, first_trending_date date, last_trending_date date, "
        "observed_trending_days bigint",
    )
    assert sorted(r.video_id for r in quality.lifecycle_dates(rows).collect()) == ["a", "b"]


def test_generic_checks(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 3), (None, 3), ("q", 9)], "k string, n int")
    assert [(r.k, r.n_rows) for r in quality.unique(df, "k").collect()] == [("x", 2)]
    assert [(r.k, r.n_rows) for r in quality.accepted_values(df, "k", ["x"]).collect()] == [("q", 1)]
    assert {r.column_name: r.n_failures for r in quality.not_null(df, ["k", "n"]).collect()} == {"k": 2, "n": 1}
    assert [(r.n, r.n_rows) for r in quality.unique_combination(df, ["k", "n"]).collect()] == [(3, 2)]
    dim = spark.createDataFrame([(1,), (3,)], "id int")
    assert [(r.n, r.n_rows) for r in quality.relationships(df, "n", dim, "id").collect()] == [(9, 1)]


def test_set_difference(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "name string")
    b = spark.createDataFrame([("y",), ("z",)], "name string")
    got = {r["name"]: r.status for r in relational.set_difference(a, b, "name").collect()}
    assert got == {"x": "missing", "y": "ok", "z": "extra"}


def test_broadcast_only_within_the_bound(spark):
    small, large = spark.range(5), spark.range(50)
    assert "broadcast" in relational.broadcast_if_small(small, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in relational.broadcast_if_small(large, 10)._jdf.queryExecution().logical().toString()


# --- profile ---


def test_profile_on_messy_rows(spark):
    rows = landed(
        spark,
        {},
        {},
        {"title": "other", "channel_title": "", "views": "-4"},
        {"video_id": "", "trending_date": "18.31.02", "views": "x", "comments_disabled": "true", "tags": ""},
        {"_source_region": "US", "publish_time": "2018-01-01T00:00:01Z", "ratings_disabled": "yes", "category_id": "77"},
    )
    one = lambda df, region="CA": df.filter(F.col("region_code") == region).first()
    counts = one(profile.counts(rows))
    assert (counts.n_rows, counts.distinct_video_id, counts.distinct_trending_date_raw) == (4, 1, 2)
    assert counts.distinct_trending_date_parsed == 1
    duplicates = one(profile.duplicates(rows))
    assert (duplicates.duplicate_grain_keys, duplicates.exact_duplicate_rows) == (2, 1)
    blanks = {r.column_name: (r.n_blank, r.pct_blank) for r in profile.blanks(rows).filter("region_code = 'CA'").collect()}
    assert blanks["video_id"] == (1, 25.0) and blanks["channel_title"] == (1, 25.0) and blanks["title"] == (0, 0.0)
    failures = {(r.region_code, r.column_name): r.n_failures for r in profile.parse_failures(rows).collect()}
    assert failures["CA", "trending_date"] == 1 and failures["CA", "views"] == 1
    assert failures["US", "ratings_disabled"] == 1 and failures["US", "publish_time"] == 0
    ranges = {(r.region_code, r.measure): r for r in profile.numeric_ranges(rows).collect()}
    assert (ranges["CA", "views"].min_value, ranges["CA", "views"].n_negative) == (-4, 1)
    assert ranges[None, "views"].max_value == 10 and len(ranges) == 12
    assert [(r.region_code, r.raw_value) for r in profile.unexpected_booleans(rows).collect()] == [("US", "yes")]
    coverage = one(profile.category_coverage(rows, categories(spark)), "US")
    assert (coverage.category_ids_seen, coverage.category_ids_no_match, coverage.no_match_sample) == (1, 1, "US:77")
    assert one(profile.publish_after_trending(rows), "US").publish_after_trending == 1
    assert [r.video_id for r in profile.publish_after_examples(rows).collect()] == ["v1"]
    flags = {(r.region_code, r.flag): (r.n_true, r.n_not_true) for r in profile.flag_totals(rows).collect()}
    assert flags["CA", "comments_disabled"] == (1, 3) and flags["US", "ratings_disabled"] == (0, 1)
    titles = one(profile.title_changes(rows))
    assert (titles.videos_with_multiple_titles, titles.title_change_count) == (1, 1)
    assert one(profile.channel_changes(rows)).videos_with_multiple_channels == 0
    assert [r.tag_sample for r in profile.tag_samples(rows).collect()] == ["a|b", "a|b"]
    spread = profile.cross_region(rows).first()
    assert (spread.ids_on_many_rows, spread.ids_in_many_regions, spread.top_video_id) == (1, 1, "v1")
    assert (spread.top_n_rows, spread.top_n_regions) == (4, 2)
    total = profile.totals(rows).first()
    assert tuple(total) == (2, 5, 3, 2, 1)


def test_missing_category_sample_is_bounded_but_the_count_is_not(spark):
    rows = landed(spark, *[{"video_id": f"v{i}", "category_id": f"{i:03}"} for i in range(40)])
    row = profile.category_coverage(rows, categories(spark)).first()
    assert row.category_ids_no_match == 40
    assert row.no_match_sample.split(", ") == [f"CA:{i:03}" for i in range(25)]


def test_every_profile_table_runs(spark):
    documents = spark.sql(
        "select 'CA' _source_region, 'CA_category_id.json' _source_file, "
        "array(named_struct('id', '1', 'snippet', named_struct('channelId', 'c', 'title', 'T', 'assignable', true))) items"
    )
    tables = profile.full_profile(landed(spark, {}), categories(spark), documents)
    assert len(tables) == 17 and all(t.count() >= 0 for t in tables.values())
    docs = tables["category_documents"].first()
    assert (docs.item_count, docs.duplicate_ids, docs.assignable_true, docs.ids_sample) == (1, 0, 1, "1")


def test_counts_taken_while_writing_are_those_of_a_scan(spark, tmp_path):
    schema = "region_code string, trending_date date, observations long"
    for k, rows in enumerate(([("US", None, 1), ("XX", None, None), (None, None, 3)], [])):
        df = spark.createDataFrame(rows, schema)
        observed = quality.Observed("mart_regional_trending", ("US",))
        observed.watch(df).write.parquet(str(tmp_path / str(k)))
        counts = observed.counts()
        assert counts["n_rows"] == len(rows)
        checks = quality.DECLARED["mart_regional_trending"]
        tables = {"mart_regional_trending": spark.read.parquet(str(tmp_path / str(k)))}
        report = [quality.check_table("mart_regional_trending", tables, checks, ("US",), o).collect() for o in (None, counts)]
        assert sorted(map(tuple, report[0])) == sorted(map(tuple, report[1]))
    assert not quality.Observed("bronze_observations").complete and not quality.Observed("int_items").complete
