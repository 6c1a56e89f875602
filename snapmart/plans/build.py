"""The whole pipeline: landing files to marts, each layer a table that later layers read back.

A build or reload is a version of the tables (`sources/versions.py`), published when all its checks have passed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators import audit, quality
from snapmart.operators.relational import broadcast_if_small, union_by_name
from snapmart.plans import marts
from snapmart.plans.dimensions import dim_category, dim_region, video_of
from snapmart.plans.enrich import int_enriched
from snapmart.plans.fact import fct_daily
from snapmart.plans.items import item_aggregate
from snapmart.plans.lifecycle import lifecycle_of
from snapmart.plans.staging import stg_categories, stg_observations
from snapmart.schemas import REGIONS
from snapmart.session import size_shuffles
from snapmart.sources import categories as category_files
from snapmart.sources import observations as observation_files
from snapmart.sources import versions
from snapmart.sources.seeds import read_region_seed
from snapmart.sources.sinks import create_view, load_report, use_warehouse, write_table

LANDED = "landed_observations"
CATEGORIES = "bronze_categories"
_REGION = "_source_region"


def load(spark: SparkSession, raw_dir: str, version: versions.Version, some: bool = False) -> list[str] | None:
    """Land the files: one pass over the CSVs writes every row once, with its class, partitioned by region.

    Accepted rows and rejects are both filters on that table, so the files are parsed once. With `some`, regions without files
    keep the rows of the version before. Returns the regions that have new rows of either kind (None: all).
    """
    documents = category_files.read_category_documents(spark, raw_dir)
    landings = {LANDED: observation_files.read_landing(spark, raw_dir), CATEGORIES: category_files.flatten_documents(documents)}
    changed: set[str] = set()
    for name, rows in landings.items():
        own = version.write(rows, name, (_REGION,))
        regions = [r[0] for r in own.select(_REGION).distinct().collect()] if some else None
        version.view(name, _REGION, regions)
        changed.update(regions or ())
    return sorted(changed) if some else None


def reload(
    spark: SparkSession,
    raw_dir: str,
    seed_path: str | None = None,
    regions: Sequence[str] = REGIONS,
    warehouse: str | None = None,
) -> dict[str, DataFrame]:
    """Load again only the regions whose files are in `raw_dir`, and build only their rows of every layer anew.

    All keys contain the region, so rows of other regions stay as the version before holds them. They are neither read
    nor copied: the new version's views add them. The files are audited first. A region in several
    files is replaced as a whole, so all its files must be there.
    """
    use_warehouse(spark, warehouse)
    versions.use_published(spark)
    if versions.published(spark) is None:
        raise audit.LandingError("nothing has been built here yet")
    files = audit.audit_files(spark, raw_dir)
    audit.require_sound(files.withColumns({"status": F.lit("ok"), "verdict": F.when(F.col("problem").isNotNull(), "fail").otherwise("ok")}))
    found = files.filter("type = 'csv'").select("file", F.substring("file", 1, 2).alias(_REGION))
    landed = spark.table(LANDED).select(F.col("_source_file").alias("file"), _REGION).distinct()
    absent = landed.join(found.select(_REGION).distinct(), _REGION).join(found, "file", "left_anti")
    if not absent.isEmpty():
        raise audit.LandingError(f"{absent.first().file} is not there, but other files of its region are")
    with versions.new_version(spark) as version:
        changed = load(spark, raw_dir, version, some=True)
        return _publish(spark, version, read_region_seed(spark, seed_path), regions, changed)


def _bronze(spark: SparkSession, changed: Sequence[str] | None = None) -> dict[str, DataFrame]:
    landed, categories = spark.table(LANDED), spark.table(CATEGORIES)
    if changed is not None:
        landed, categories = (df.filter(F.col(_REGION).isin(*changed)) for df in (landed, categories))
    return {
        "bronze_observations": observation_files.accepted(landed),
        "rejects": observation_files.rejects(landed),
        "bronze_categories": categories,
    }


def _publish(
    spark: SparkSession, version: versions.Version, seed: DataFrame, regions: Sequence[str], changed: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Bronze to marts; each layer is computed once, read back as a table, and checked before the next is built.

    Rows, not-null and accepted-value checks of a layer are counted
    while it is written. Dedup is the one shuffle of whole rows, and only of those whose key may repeat. The fact is a scan of staging with broadcast lookups; the
    items and marts aggregate on the map side before they shuffle. The report of all checks is table `check_report`. With
    `changed`, layers, checks and counts are of these regions' rows, and views make the tables whole.
    """
    bronze = _bronze(spark, changed)
    t: dict[str, DataFrame] = {**bronze, "region_seed": seed}
    reports: list[DataFrame] = []

    counted: dict[str, dict[str, int]] = {}
    known: dict[str, dict[str, int]] = {}

    def table(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        observed = quality.Observed(name, regions)
        t[name] = version.write(observed.watch(df), name, partition_by)
        counted[name] = observed.counts()
        if observed.complete:
            known[name] = counted[name]

    def passed(layer: str, *names: str) -> None:
        reports.append(write_table(quality.check_all(t, regions, names, known), f"check_report_{layer}"))
        quality.require_passed(reports[-1])

    loaded = quality.check_loaded(spark, LANDED, CATEGORIES, regions)
    t["check_loaded"] = write_table(loaded, "check_loaded")
    if not t["check_loaded"].isEmpty():
        problem = t["check_loaded"].first()
        raise quality.CheckError(f"{problem.subject}: {problem.problem}, see check_loaded")
    t["load_report"] = write_table(load_report(spark.table(LANDED)), "load_report")
    passed("bronze", *bronze, "region_seed")
    table("stg_observations", stg_observations(bronze["bronze_observations"], regions, table=True), ("region_code",))
    table("stg_categories", stg_categories(bronze["bronze_categories"], regions))
    passed("staging", "stg_observations", "stg_categories")
    table("dim_region", dim_region(seed))
    table("dim_category", dim_category(t["stg_categories"]))
    for reference in ("stg_categories", "dim_region", "dim_category"):
        t[reference] = broadcast_if_small(t[reference])
    table("int_items", item_aggregate(t["stg_observations"]))
    table("dim_video", video_of(t["int_items"]))
    table("int_lifecycle", lifecycle_of(t["int_items"]))
    t["int_enriched"] = create_view(int_enriched(t["stg_observations"], t["stg_categories"]), "int_enriched")
    table("fct_daily", fct_daily(t["int_enriched"], t["dim_region"], t["dim_category"]), ("region_code",))
    passed("core", "dim_region", "dim_category", "dim_video", "int_lifecycle", "int_enriched", "fct_daily")
    table("mart_video_lifecycle", marts.mart_video_lifecycle(t["int_lifecycle"]))
    table("mart_channel_performance", marts.mart_channel_performance(t["int_items"]))
    table("mart_category_performance", marts.mart_category_performance(t["fct_daily"], t["dim_category"]))
    table("mart_regional_trending", marts.mart_regional_trending(t["fct_daily"]))
    passed("marts", *[n for n in t if n.startswith("mart_")])
    t["check_report"] = write_table(union_by_name(reports), "check_report")
    rows = spark.createDataFrame([(n, c[quality.ROWS]) for n, c in counted.items()], "table_name string, n_rows long")
    t["table_rows"] = write_table(rows, "table_rows")
    for name in counted:  # the seed's regions are all there each time
        t[name] = version.view(name, "region_code", None if name == "dim_region" else changed)
    t["int_enriched"] = create_view(int_enriched(t["stg_observations"], broadcast_if_small(t["stg_categories"])), "int_enriched")
    return {**t, **_bronze(spark)}


def build(
    spark: SparkSession,
    raw_dir: str,
    seed_path: str | None = None,
    regions: Sequence[str] = REGIONS,
    strict: bool = False,
    warehouse: str | None = None,
) -> dict[str, DataFrame]:
    """Audit, load, transform and check, into tables below `warehouse` (default: the session's).

    A failing audit stops before the load, a failing check before the layers above.
    """
    use_warehouse(spark, warehouse)
    audit.require_sound(audit.audit_report(spark, raw_dir, regions, strict))
    size_shuffles(spark, audit.found_files(spark, raw_dir).agg(F.sum("size_bytes")).first()[0])
    with versions.new_version(spark) as version:
        load(spark, raw_dir, version)
        return _publish(spark, version, read_region_seed(spark, seed_path), regions)
