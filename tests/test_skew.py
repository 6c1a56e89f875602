"""One region, item, label or value on most of the rows: results stay whole and no task takes the group."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators import profile, quality, relational
from snapmart.plans import enrich, fact, items, lifecycle, marts, staging
from snapmart.plans.dimensions import dim_category, dim_region
from snapmart.schemas import REGION_SEED_ROWS
from snapmart.sources import sinks
from test_models import LANDED, categories

ROWS, COPIES = 30000, 20000


@pytest.fixture(scope="module")
def landed(spark):
    """Two thirds of the rows are copies of one item and day, under one label and category."""
    hot = F.col("id") < COPIES
    number = F.col("id").cast("string")
    day = F.concat(F.lit("18."), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(".01"))
    values = {
        "video_id": F.when(hot, "hot").otherwise(F.concat(F.lit("v"), number)),
        "trending_date": F.when(hot, "18.01.01").otherwise(day),
        "title": F.lit("t"),
        "channel_title": F.when(hot, "big").otherwise(F.concat(F.lit("c"), number)),
        "category_id": F.when(F.col("id") % 3 == 0, "10").otherwise("11"),
        "publish_time": F.lit("2018-01-01T00:00:00.000Z"),
        "views": F.when(hot, number).otherwise("100"),
        "_source_region": F.when(F.col("id") % 10 > 0, "CA").otherwise("US"),
        "_loaded_at": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"),
    }
    names = [part.split()[0] for part in LANDED.split(", ")]
    columns = [values.get(n, F.lit("1")).alias(n) for n in names]
    return spark.range(0, ROWS, 1, 8).select(*columns)


def test_dedup_shuffles_one_row_per_task_and_key(spark, landed):
    deduplicated = staging.deduplicate(staging.source_observations(landed))
    assert deduplicated.count() == ROWS - COPIES + 2
    kept = {r.region_code: r.views for r in deduplicated.filter("video_id = 'hot'").collect()}
    # the largest views win in each region
    numbers = collections.defaultdict(int)
    for i in range(COPIES):
        region = "CA" if i % 10 > 0 else "US"
        numbers[region] = max(numbers[region], i)
    assert kept == dict(numbers)
    plan = deduplicated._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning") :]


def test_marts_stay_whole(spark, landed):
    cats = categories(spark)
    staged = staging.stg_observations(landed)
    names = "region_code string, region_name string, locale string, language_code string"
    regions = dim_region(spark.createDataFrame(list(REGION_SEED_ROWS), names))
    rows = fact.fct_daily(enrich.int_enriched(staged, cats), regions, dim_category(cats))
    assert marts.mart_regional_trending(rows).agg(F.sum("observations")).first()[0] == ROWS - COPIES + 2
    channel = marts.mart_channel_performance(items.item_aggregate(staged))
    assert channel.agg(F.sum("distinct_videos")).first()[0] == ROWS - COPIES + 2
    assert quality.duplicate_grain(rows).count() == 0


def test_profile_counts_every_copy(landed):
    duplicates = {r.region_code: r for r in profile.duplicates(landed).collect()}
    assert duplicates["CA"].duplicate_grain_keys + duplicates["US"].duplicate_grain_keys == COPIES - 2
    overlap = profile.cross_region(landed).first()
    assert (overlap.top_video_id, overlap.top_n_rows, overlap.top_n_regions) == ("hot", COPIES, 2)


@pytest.mark.parametrize("name", ["duplicates", "cross_region", "counts", "title_changes"])
def test_rows_are_reduced_before_each_shuffle(landed, name):
    plan = getattr(profile, name)(landed)._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert exchanges
    for i in exchanges:
        below = next(line for line in plan[i + 1 :] if "Project" not in line)
        assert "Aggregate" in below


def test_only_rows_of_repeated_keys_are_shuffled(spark):
    rng = random.Random(2)
    rows = [(i, "x" * 20, 1) for i in range(4000)] + [(rng.randrange(300), "y" * rng.randrange(9), v) for v in range(900)] + [(7, "z", v) for v in range(500)]
    df = spark.createDataFrame([*rows, (None, "n", 1), (None, "n", 2)], "k long, t string, v long")
    want = sorted(map(tuple, relational.latest_per_key(df, ("k",), ("v", "t")).collect()), key=repr)
    for bits in (1 << 26, 1 << 9, 1):  # from no chance hits to a filter that every row hits
        got = relational.latest_of_repeated(df, ("k",), ("v", "t"), bits)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    plan = relational.latest_of_repeated(df, ("k",), ("v", "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "Union" in plan
    assert relational.latest_of_repeated(df.limit(0), ("k",), ("v", "t")).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, landed, tmp_path):
    keys = ("region_code", "video_id")
    cats, staged = categories(spark), staging.stg_observations(landed)
    names = "region_code string, region_name string, locale string, language_code string"
    regions = dim_region(spark.createDataFrame(list(REGION_SEED_ROWS), names))
    rows = fact.fct_daily(enrich.int_enriched(staged, cats), regions, dim_category(cats))
    life = sinks.write_bucketed(lifecycle.int_lifecycle(staged), "bucketed_life", keys, 3, f"{tmp_path}/life")
    facts = sinks.write_bucketed(rows, "bucketed_fact", keys, 3, f"{tmp_path}/fact")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = marts.joined_items(life, facts)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, joined.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Inner" in plan and "Exchange" not in plan
    want = marts.items_with_lifecycle(items.item_aggregate(staged)).select(*joined.columns)
    assert got == sorted(map(tuple, want.collect()), key=repr)
