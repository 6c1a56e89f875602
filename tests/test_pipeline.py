"""The whole build on the 20-row sample."""

import pytest
from pyspark.sql import functions as F

from fixtures import EXPECTED, csv_text, sample_rows, write_landing
from snapmart.operators import audit, profile, quality
from snapmart.plans import build as pipeline
from snapmart.plans.dimensions import dim_video
from snapmart.plans.fact import fct_daily
from snapmart.sources import categories, sinks, versions


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return str(write_landing(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def tables(spark, raw):
    return pipeline.build(spark, raw)


def test_sizes(tables):
    sizes = {n: tables[n].count() for n in tables}
    assert {n: sizes[n] for n in sizes if n not in ("check_report", "int_items", "load_report", "check_loaded")} == {
        "bronze_observations": 20, "rejects": 0, "bronze_categories": 311, "region_seed": 10, "stg_observations": 20,
        "stg_categories": 311, "dim_region": 10, "dim_category": 311, "dim_video": 20, "int_lifecycle": 20,
        "int_enriched": 20, "fct_daily": 20, "mart_video_lifecycle": 20, "mart_channel_performance": 10,
        "mart_category_performance": 20, "mart_regional_trending": 20, "table_rows": 12,
    }


def test_enriched_rows(tables):
    rows = tables["int_enriched"].collect()
    got = {
        r.video_id: (
            str(r.trending_date_parsed), r.days_since_publish, round(r.engagement_rate, 6), r.has_valid_engagement,
            r.category_title, r.tag_count,
        )
        for r in rows
    }
    assert got == EXPECTED


def test_empty_description_is_null(tables):
    rows = tables["stg_observations"].filter(F.col("description").isNull()).select("video_id").collect()
    assert [r.video_id for r in rows] == ["vCA00002"]


def test_marts(tables):
    channel = {r.region_code: r for r in tables["mart_channel_performance"].collect()}
    assert channel["MX"].avg_latest_views == 47500 and channel["MX"].total_trending_days == 2
    assert round(channel["FR"].avg_engagement_rate, 6) == 0.066
    gb = tables["mart_regional_trending"].filter("region_code = 'GB' and trending_date = date'2018-05-04'").first()
    assert gb.avg_engagement_rate is None and gb.observations == 1


def test_fact_keys(tables):
    fact = tables["fct_daily"]
    assert fact.filter("region_key is null or video_key is null or category_key is null").count() == 0


def test_checks_pass(tables):
    report = tables["check_report"]
    assert report.filter("n_failures > 0").count() == 0
    # column checks repeat per region on the landed tables
    counts = {r.check_name: r["count"] for r in report.groupBy("check_name").count().collect()}
    assert counts == {
        "not_null": 151, "unique": 10, "accepted_values": 22, "relationships": 3, "unique_combination": 1,
        "orphan_categories": 1, "lifecycle_dates": 1, "duplicate_grain": 1, "negative_measures": 1,
        "published_after_trending": 1,
    }


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_fact_needs_no_shuffle(tables):
    fact = fct_daily(tables["int_enriched"], tables["dim_region"], tables["dim_category"])
    assert exchanges(fact) == 0


def test_fact_keys_equal_joined_keys(tables):
    args = (tables["int_enriched"], tables["dim_region"], tables["dim_category"])
    joined = fct_daily(*args, videos=tables["dim_video"])
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, fct_daily(*args).collect()))


def test_unused_dimension_join_is_dropped(tables):
    fact = fct_daily(tables["int_enriched"], tables["dim_region"], tables["dim_category"], dim_video(tables["stg_observations"]))
    plan = fact.select("region_code", "views")._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan


def test_profile_reports(spark, tables, tmp_path, raw):
    documents = categories.read_category_documents(spark, raw)
    reports = profile.full_profile(spark.table(pipeline.LANDED), tables["stg_categories"], documents)
    sinks.write_json_reports(reports, str(tmp_path))
    totals = spark.read.json(f"{tmp_path}/totals").first()
    assert (totals.csv_count, totals.total_rows, totals.total_distinct_keys, totals.total_dup_keys) == (10, 20, 20, 0)
    documents = {r.region_code: r for r in spark.read.json(f"{tmp_path}/category_documents").collect()}
    assert documents["US"].item_count == 32 and documents["CA"].item_count == 31
    assert (documents["CA"].duplicate_titles, documents["CA"].duplicate_ids) == (1, 0)
    assert (documents["CA"].assignable_true, documents["US"].assignable_true) == (14, 15)
    assert documents["CA"].ids_sample == "1, 2, 10, 15, 17"


def test_loaded_totals(spark, tables):
    totals = quality.loaded_totals(tables["bronze_observations"], tables["bronze_categories"])
    assert {r.subject: r.n_rows for r in totals.collect()} == {"observations": 20, "categories": 311}


def test_loaded_check(spark, tables):
    assert quality.check_loaded(spark, pipeline.LANDED, pipeline.CATEGORIES).count() == 0
    problems = quality.check_loaded(spark, pipeline.LANDED, "nowhere", ["CA", "XX"]).collect()
    found = {(r.subject, r.problem) for r in problems}
    assert ("nowhere", "missing table") in found
    assert (pipeline.LANDED, "missing region XX") in found and (pipeline.LANDED, "extra region US") in found


def test_reload_replaces_only_its_region(spark, tables, tmp_path):
    def per_region(name, column):
        return {r[0]: r.n for r in spark.table(name).groupBy(column).agg(F.count("*").alias("n")).collect()}

    before = per_region(pipeline.LANDED, "_source_region")
    write_landing(tmp_path, ["CA"])
    (tmp_path / "CAvideos.csv").write_text(csv_text(sample_rows("CA")[:1]))
    pipeline.reload(spark, str(tmp_path))
    assert per_region(pipeline.LANDED, "_source_region") == {**before, "CA": 1}
    assert per_region("fct_daily", "region_code") == {**before, "CA": 1}  # and all that is built on it
    assert spark.table(pipeline.CATEGORIES).count() == 311


def test_reload_wants_sound_and_complete_regions(spark, tables, tmp_path):
    rows = csv_text(sample_rows("CA"))
    write_landing(tmp_path, ["CA"])
    (tmp_path / "CAvideos.csv").rename(tmp_path / "CAvideos-0001.csv")
    with pytest.raises(audit.LandingError, match="CAvideos.csv is not there"):
        pipeline.reload(spark, str(tmp_path))
    (tmp_path / "CAvideos.csv").write_text(rows.replace("views,likes", "likes,views"))
    with pytest.raises(audit.LandingError, match="header drift"):
        pipeline.reload(spark, str(tmp_path))


def test_a_failing_check_stops_the_build(spark, tables, tmp_path):
    raw = write_landing(tmp_path / "raw")
    lines = (raw / "CAvideos.csv").read_text().splitlines()
    lines[1] = "," + lines[1].split(",", 1)[1]  # a row without its item id
    (raw / "CAvideos.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(quality.CheckError, match="video_id"):
        pipeline.build(spark, str(raw), warehouse=str(tmp_path / "house"))
    assert list((tmp_path / "house").glob("versions/*/check_report_bronze")) and not list((tmp_path / "house").glob("versions/*/own_fct_daily"))
    assert versions.published(spark) is None
    spark.catalog.setCurrentDatabase("default")


LAYERS = (
    "stg_observations", "stg_categories", "dim_region", "dim_category", "dim_video", "int_items", "int_lifecycle", "fct_daily",
    "mart_video_lifecycle", "mart_channel_performance", "mart_category_performance", "mart_regional_trending",
)


def contents(spark, name):
    """The rows of a table without load times."""
    df = spark.table(name)
    rows = df.drop("_loaded_at").select(F.to_json(F.struct(*[c for c in df.columns if c != "_loaded_at"]))).collect()
    return sorted(r[0] for r in rows)


def test_a_build_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    raw, house = write_landing(tmp_path / "raw"), str(tmp_path / "house")
    spark.sql("DROP DATABASE IF EXISTS snapmart CASCADE")
    pipeline.build(spark, str(raw), warehouse=house)
    first, before = versions.published(spark), {n: contents(spark, n) for n in LAYERS}
    (raw / "CAvideos.csv").write_text(csv_text(sample_rows("CA")[:1]))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(pipeline.marts, "mart_category_performance", dies)
        pipeline.build(spark, str(raw), warehouse=house)
    spark.catalog.setCurrentDatabase("snapmart")  # as a new session finds it
    versions.use_published(spark)
    assert versions.published(spark) == first == spark.catalog.currentDatabase()
    assert {n: contents(spark, n) for n in LAYERS} == before
    died = [d.name for d in spark.catalog.listDatabases() if d.name > first and d.name.startswith("snapmart__v")]
    assert len(died) == 1 and spark.catalog.tableExists(f"{died[0]}.own_fct_daily")
    pipeline.build(spark, str(raw), warehouse=house)
    assert spark.table("fct_daily").count() == len(before["fct_daily"]) - 1
    assert {first, died[0]} <= set(versions.drop_versions(spark, keep=1))
    assert spark.table("fct_daily").count() == len(before["fct_daily"]) - 1
    spark.catalog.setCurrentDatabase("default")


def test_reload_builds_only_its_regions_and_equals_a_full_build(spark, tmp_path):
    raw, house = write_landing(tmp_path / "raw"), str(tmp_path / "house")
    spark.sql("DROP DATABASE IF EXISTS snapmart CASCADE")
    pipeline.build(spark, str(raw), warehouse=house)
    first, made = versions.published(spark), []
    for k, region in enumerate(["CA", "GB", "CA"]):  # the second reload of CA takes the place of the first
        late = tmp_path / f"late-{k}"
        write_landing(late, [region])
        text = csv_text(sample_rows(region)[: 1 + (k == 2)])
        (late / f"{region}videos.csv").write_text(text)
        (raw / f"{region}videos.csv").write_text(text)
        pipeline.reload(spark, str(late), warehouse=house)
        made.append(versions.published(spark))
        for name in ("stg_observations", "int_items", "fct_daily", "mart_regional_trending"):
            assert {r[0] for r in spark.table(f"own_{name}").select("region_code").distinct().collect()} == {region}
    owners = {r.version: r.regions for r in spark.table("owners").filter("table_name = 'fct_daily'").collect()}
    assert owners[first] is None and owners[versions.published(spark)] == ["CA"] and len(owners) == 3  # not one a reload
    # a region's rows come from the folders of the version that holds them
    files = spark.table("fct_daily").filter("region_code = 'CA'").select(F.input_file_name()).distinct().collect()
    assert all(versions.published(spark) in f[0] and "region_code=CA" in f[0] for f in files)
    dropped = versions.drop_versions(spark, keep=1)
    assert made[0] in dropped and not {first, *made[1:]} & set(dropped)  # nothing reads the first reload of CA any more
    got = {n: contents(spark, n) for n in LAYERS}
    pipeline.build(spark, str(raw), warehouse=house)
    assert {n: contents(spark, n) for n in LAYERS} == got
    spark.catalog.setCurrentDatabase("default")


def test_reload_wants_a_build(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS snapmart CASCADE")
    with pytest.raises(audit.LandingError, match="nothing has been built"):
        pipeline.reload(spark, str(write_landing(tmp_path / "raw", ["CA"])), warehouse=str(tmp_path / "house"))
    spark.catalog.setCurrentDatabase("default")
